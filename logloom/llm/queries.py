"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import additive_ann, bpe, chat_preference, exact_dedup, filter_audit, importance, line_dedup, near_dedup, packing, pii, quality_lm, secret_scan
from logloom.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(read(spark, sf_dir, "documents", "doc_id", "text"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pii(read(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return out.select(
        "doc_id",
        *(f"n_{k}" for k in pii.BASE),
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op3_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.karmarkar_karp(read(spark, sf_dir, "documents", "doc_id", "text"), with_ids=False).drop("ids")


def op5_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "text")
    return quality_lm.quality(docs, read(spark, sf_dir, "labels"), carry=("doc_id", "lang"))


def op10_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat_preference.reply_pairs(read(spark, sf_dir, "conversations"))
    out = chat_preference.preference_format(pairs)
    return out.withColumn("prompt_sha256", F.sha2("prompt", 256)).drop("prompt")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.secret_scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE))
    return out.select(
        "doc_id",
        *(f"n_{k}" for k in secret_scan.BASE),
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.masks(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return filter_audit.audit(rows, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


#: In DuckDB's dialect; chr(9) to chr(13) and the space are the blanks of a line's ends.
OP1_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines
), repeated AS (
  SELECT line_key, max(doc_id) AS keep_id FROM keyed WHERE length(line_key) >= 20
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, r.keep_id IS NOT NULL AND r.keep_id <> k.doc_id AS lost
  FROM keyed k LEFT JOIN repeated r ON k.line_key = r.line_key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE lost)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""

OP10_SQL = """
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, role, text FROM conversations
), ends AS (
  SELECT conv_id, max(pos) FILTER (WHERE role = 'assistant') AS last FROM own GROUP BY conv_id
), replies AS (
  SELECT o.conv_id, o.text FROM own o JOIN ends e ON o.conv_id = e.conv_id AND o.pos = e.last
), turns AS (
  SELECT o.conv_id, o.pos, o.role, o.text AS chosen_text,
         CASE WHEN o.pos = e.last THEN coalesce(r.text, '') ELSE o.text END AS rejected_text
  FROM own o JOIN ends e ON o.conv_id = e.conv_id
  LEFT JOIN replies r ON r.conv_id = xor(o.conv_id, 1)
), shared AS (
  SELECT conv_id, coalesce(min(pos) FILTER (WHERE chosen_text <> rejected_text) - 1, max(pos)) AS n FROM turns GROUP BY conv_id
), rendered AS (
  SELECT t.conv_id, t.pos, s.n, (t.role = 'assistant')::INT AS train,
         '<|' || t.role || '|>' || chr(10) AS head,
         t.chosen_text || '<|end|>' || chr(10) AS c, t.rejected_text || '<|end|>' || chr(10) AS r
  FROM turns t JOIN shared s ON t.conv_id = s.conv_id
)
SELECT conv_id, n::BIGINT AS n_prompt_turns,
  sha256(coalesce(string_agg(head || c, '' ORDER BY pos) FILTER (WHERE pos <= n), '')) AS prompt_sha256,
  coalesce(string_agg(head || c, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS chosen,
  coalesce(string_agg(head || r, '' ORDER BY pos) FILTER (WHERE pos > n), '') AS rejected,
  coalesce(string_agg(length(head) || ':0,' || length(c) || ':' || train, ',' ORDER BY pos) FILTER (WHERE pos > n), '') AS chosen_mask,
  coalesce(string_agg(length(head) || ':0,' || length(r) || ':' || train, ',' ORDER BY pos) FILTER (WHERE pos > n), '') AS rejected_mask,
  count(*) FILTER (WHERE pos > n) > 0 AS trainable
FROM rendered GROUP BY conv_id, n
"""

OP12_SQL = """
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), failing AS (
  SELECT doc_id, part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)::INT AS mask
  FROM words
), said AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing LEFT JOIN said USING (doc_id) GROUP BY part, mask
), letters(name, own) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.own, b.own, c.own, d.own, e.own] AS owns
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.own + b.own + c.own + d.own + e.own = 31 AND a.own | b.own | c.own | d.own | e.own = 31
), steps AS (
  SELECT filter_order, s.step::INT AS step, owns[s.step] AS own, coalesce(list_sum(owns[1:s.step - 1]), 0)::INT AS gone
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
), found AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (gone | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & gone <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & gone = 0 AND mask & own <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM found
"""

#: CRC-32 by halves of bytes; the sixteen entries come from the rule of the polynomial.
OP13_SQL = """
WITH halves AS (
  SELECT list_transform(range(16), lambda i: list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0]),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS table16
), texts AS (
  SELECT 0 AS tab, row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), words AS (
  SELECT tab, row, doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), features AS (
  SELECT tab, row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
), counted AS (SELECT tab, row, f, count(*) AS n FROM features GROUP BY tab, row, f),
hashed AS (
  SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(1, length(hex(f)) + 1), lambda i: ('0x' || substr(hex(f), (i + (i % 2) * 2 - 1)::BIGINT, 1))::BIGINT)),
           lambda c, h: xor(c >> 4, table16[(xor(c, h) & 15) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted), halves
), held AS (SELECT tab, row, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (f) GROUP BY tab, row, bucket),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE tab = 0), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE tab = 1), 0)::BIGINT AS t FROM held GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (SELECT sum(s) + 10000 FROM totals)::DOUBLE
                                 / ((s + 1)::DOUBLE * (SELECT sum(t) + 10000 FROM totals)::DOUBLE)))::BIGINT AS g FROM totals
), weights AS (
  SELECT row, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM held JOIN gain USING (bucket) WHERE tab = 0 GROUP BY row
), scored AS (
  SELECT d.row, d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words d LEFT JOIN weights USING (row) WHERE d.tab = 0
), places AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN places USING (row)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_best_fit": op3_best_fit,
    "op4_karmarkar_karp": op4_karmarkar_karp,
    "op5_additive_ann": op5_additive_ann,
    "op6_prob_minhash": op6_prob_minhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_lm": op9_quality_lm,
    "op10_chat_preference": op10_chat_preference,
    "op11_secret_scan": op11_secret_scan,
    "op12_filter_audit": op12_filter_audit,
    "op13_importance": op13_importance,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op10_chat_preference": OP10_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_importance": OP13_SQL,
}
