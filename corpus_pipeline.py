"""From raw documents to packed training sequences.

Five stages, each on all that the one before kept: the quality model's rejects
go, exact copies go, one document of each near-duplicate class stays, personal
data is replaced, and what is left is packed. All but the last return the
columns of documents.

Rows without a doc_id can't be told apart by later joins and are never dropped
as near duplicates; an empty table passes through every stage. Of repeated rows
one goes on, the one of the least hash. Further columns of documents may have any
names and types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import compacted, lower_ascii, read, unused, written
from logloom.llm.exact_dedup import exact_dedup
from logloom.llm.near_dedup import content, near_classes, words_of
from logloom.llm.packing import karmarkar_karp
from logloom.llm.pii import pii
from logloom.llm.quality_lm import quality

#: Rows of a list of dropped documents that are sent to the tasks (64 MB at most);
#: a longer list is joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _sent(rows: DataFrame) -> DataFrame:
    """A list of rows of documents, to be sent to the tasks where it is short."""
    rows = compacted(rows)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _all(docs: DataFrame, of: str = "") -> list[Column]:
    """The columns of docs, or of a struct that holds them, whatever their names."""
    return [F.col(f"{of}`{c.replace('`', '``')}`").alias(c) for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within their language's perplexity threshold."""
    told = quality(docs.select(F.struct(*_all(docs)).alias("own"), "doc_id", "lang", "text"), read(spark, sf_dir, "labels"), carry=("own",))
    return told.filter("kept").select(*_all(docs, "own."))


def keep_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last of equal texts; of repeated rows a single one."""
    marked = exact_dedup(docs).filter("group_size > 1").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_sha"), "kept")
    # Rows of one id and one text can't be told apart: all of them go, or one of them stays.
    told = compacted(marked.groupBy("_id", "_sha").agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("n")))
    gone, again = _sent(told.filter("NOT stays").select("_id", "_sha")), _sent(told.filter("stays AND n > 1").select("_id", "_sha"))
    digest = unused(docs, "_own")[0]
    own = docs.withColumn(digest, F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256)))
    same = lambda d, g: d["doc_id"].eqNullSafe(g["_id"]) & (d[digest] == g["_sha"])
    out = own.join(gone, same(own, gone), "left_anti")
    if again.isEmpty():
        return out.select(*_all(docs))
    row = F.struct(*_all(docs))
    once = out.join(again, same(out, again), "left_semi").groupBy("doc_id", digest).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
    return out.join(again, same(out, again), "left_anti").select(*_all(docs)).unionByName(once.select(*_all(docs, "row.")))


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each near-duplicate class; rows that share an id are told apart by their words."""
    gone = _sent(near_classes(docs, with_content=True).filter("doc_id <> class_id").select(F.col("doc_id").alias("_id"), F.col("content").alias("_sha")).distinct())
    digest = unused(docs, "_own")[0]
    own = docs.withColumn(digest, content(words_of(F.coalesce("text", F.lit("")))))
    return own.join(gone, (own["doc_id"] == gone["_id"]) & (own[digest] == gone["_sha"]), "left_anti").select(*_all(docs))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    out = pii(docs.select(F.struct(*_all(docs)).alias("own"), "text"), redacted=True)
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}
    return out.select(*(new.get(name, own).alias(name) for name, own in zip(docs.columns, _all(docs, "own."), strict=True)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of near-equal windows, with their ids."""
    return karmarkar_karp(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("exact_dedup", keep_exact),
    ("near_dedup", keep_one_of_near),
    ("pii", redact_pii),
    ("packing", pack),
]

#: SQL can't express the quality model, signatures, anchor parsers or differencing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
