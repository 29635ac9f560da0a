"""op3, op4, op5 and the pipeline."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import prose, rows
from tokenizers import Tokenizer

import corpus_pipeline
from logloom.llm import additive_ann, packing

PATH = public_tokenizers.path(packing.DEFAULT_FILE)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_ids_equal_the_tokenizers_library(library):
    texts = ["", "a", "<|endoftext|> x", "<|endoftext|>", "a <|endoftext|><|endoftext|>b <|endoftext", "🙂 日本\n\n  ünï", " " * 300, prose(1, 200), "x" * 5000]
    assert all(packing.token_ids(t, PATH).tolist() == library(t) for t in texts)


def check_pieces(got, library, data):
    by_window, by_doc = {}, {}
    for r in got:
        by_window.setdefault(r["sequence_id"], []).append(r)
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for window in by_window.values():
        at = 0
        for r in sorted(window, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= packing.CAPACITY
    for doc, text, *_ in data:
        ids = library(text or "")
        pieces = sorted(by_doc[doc, len(ids)], key=lambda r: r["start"])
        copies = sum(1 for d, t, *_ in data if d == doc and (t or "") == (text or ""))
        assert sum(r["length"] for r in pieces) == copies * len(ids)
        for r in pieces:
            own = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
            assert (r["ids_crc32"], bytes(r["ids"])) == (zlib.crc32(own), own)


def test_karmarkar_karp(docs, no_docs, library):
    check_pieces(packing.karmarkar_karp(docs.withColumn("length", F.lit("x"))).collect(), library, rows())
    assert packing.karmarkar_karp(no_docs).count() == 0


def test_differencing_deals_everything_and_levels():
    random.seed(3)
    for n, k in ((1, 1), (2, 5), (40, 4), (200, 16), (7, 7)):
        sizes = [random.randint(1, 100) for _ in range(n)]
        dealt = packing.differencing(sizes, k)
        assert sorted(i for w in dealt for i in w) == list(range(n)) and len(dealt) <= k
        if n >= 10 * k:
            sums = [sum(sizes[i] for i in w) for w in dealt]
            assert max(sums) - min(sums) <= 5
    assert packing.differencing([8, 7, 6, 5, 4], 2) and sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.differencing([8, 7, 6, 5, 4], 2)) == [14, 16]


def test_window_count_rises_when_capacity_is_exceeded():
    dealt = packing.balanced_windows([6, 6, 6], 10)
    assert len(dealt) == 3
    assert packing.balanced_windows([], 10) == []


def test_little_padding_and_few_cuts():
    random.seed(1)
    blocks, windows = packing._Blocks(2048, 128), []
    sizes = [int(random.lognormvariate(6.4, 1)) + 1 for _ in range(3000)]
    for d, n in enumerate(sizes):
        windows += blocks.add(d, np.zeros(n, "<u4"))
    windows += blocks.flush()
    assert all(sum(len(p[2]) for p in w) <= 2048 for w in windows)
    assert sum(len(p[2]) for w in windows for p in w) == sum(sizes)
    assert 1 - sum(sizes) / (len(windows) * 2048) < 0.04
    # Only documents longer than a window are cut, and only by it.
    assert sum(len(w) for w in windows) == sum(-(-n // 2048) for n in sizes)


def test_count_rises_in_the_operator(spark):
    """Five documents of 1,100 ids would fill three windows, but no two of them share one."""
    docs = spark.createDataFrame([(i, "a " * 1099 + "b") for i in range(5)], "doc_id bigint, text string").coalesce(1).withColumn("sequence_id", F.lit("mine"))
    got = packing.karmarkar_karp(docs).collect()
    assert {r["length"] for r in got} == {r["doc_tokens"] for r in got} and 1024 < got[0]["length"] < 2048
    assert len(got) == len({r["sequence_id"] for r in got}) == 5


def brute_best_fit(sizes, capacity):
    left, bins = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, k) for k, room in enumerate(left) if room >= sizes[i]]
        if not fits:
            left.append(capacity)
            bins.append([])
            fits = [(capacity, len(left) - 1)]
        k = min(fits)[1]
        left[k] -= sizes[i]
        bins[k].append(i)
    return sorted(left)


def test_best_fit_decreasing_equals_brute_force():
    random.seed(4)
    for capacity in (1, 10, 64, 100, 2048):
        sizes = [random.randint(1, capacity) for _ in range(300)]
        bins = packing.best_fit_decreasing(sizes, capacity)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert sorted(capacity - sum(sizes[i] for i in b) for b in bins) == brute_best_fit(sizes, capacity)


def test_best_fit_is_lossless(docs, no_docs, library):
    pieces = {}
    clashing = docs.withColumns({c: F.lit("mine") for c in ("sequence_id", "input_ids", "n_tokens", "starts")})
    for r in packing.best_fit(clashing).collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        assert len(ids) == packing.CAPACITY and r["cu_lengths"][0] == 0 and r["cu_lengths"][-1] == r["n_tokens"] <= packing.CAPACITY
        assert (ids[r["n_tokens"] :] == 0).all()
        position = packing.position_ids(r["cu_lengths"])
        assert np.flatnonzero(position == 0).tolist() == r["position_resets"]
        for doc, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_lengths"], r["cu_lengths"][1:], strict=False):
            pieces.setdefault(doc, []).append((start, ids[a:b].tolist()))
    # Documents of one id, and those without, are told apart by their pieces.
    want = {}
    for doc, text, *_ in rows():
        ids = library(text or "")
        want.setdefault(doc, []).extend((at, ids[at : at + packing.CAPACITY]) for at in range(0, len(ids), packing.CAPACITY))
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in want.items()}
    assert packing.best_fit(no_docs).count() == 0


def test_written_matrices(docs, library, tmp_path):
    packing.write_matrices(packing.best_fit(docs), str(tmp_path / "m"))
    table = pq.read_table(str(tmp_path / "m"))
    ids, found = packing.matrix(table), []
    assert ids.shape == (table.num_rows, packing.CAPACITY)
    for i, r in enumerate(table.to_pylist()):
        position = packing.position_ids(r["cu_lengths"])
        assert np.flatnonzero(position == 0).tolist() == r["position_resets"] and (ids[i, r["n_tokens"] :] == 0).all()
        found += [ids[i, a:b].tolist() for a, b in zip(r["cu_lengths"], r["cu_lengths"][1:], strict=False)]
    want = [library(t or "") for _, t, *_ in rows()]
    assert sorted(found) == sorted(x[at : at + packing.CAPACITY] for x in want for at in range(0, len(x), packing.CAPACITY))


def brute_nearest(ids, x, k):
    out = {}
    for i, q in zip(ids, x, strict=True):
        if i % 20 == 0:
            scores = (x * q).sum(1)
            out[i] = [int(ids[j]) for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
    return out


def test_nearest_neighbours(spark, monkeypatch):
    monkeypatch.setattr(additive_ann, "DATA_BLOCK", 700)
    monkeypatch.setattr(additive_ann, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24))
    x[1000:1800] = x[1000] + 0.05 * rng.normal(size=(800, 24))  # a dense group
    x[2000:2300] = x[2000]  # copies: ties
    x = x.astype(np.float32).astype(float)
    ids = np.arange(3000)
    data = [(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] + [1.0] * 23), (None, [1.0] * 24), (5080, [1.0] * 7)]
    df = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<double>")
    df = df.withColumns({c: F.lit("mine") for c in ("score", "row", "block", "vector", "rank")})
    got = {}
    for r in additive_ann.search(df, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(ids, x, 20)
    assert set(got) == set(want)
    hits = 0
    for q, rows_ in got.items():
        ranked = sorted(rows_)
        assert [r[0] for r in ranked] == list(range(1, 21))
        assert all(abs(s - float((x[v] * x[q]).sum())) < 1e-9 for _, v, s in ranked)
        assert [(-s, v) for _, v, s in ranked] == sorted((-s, v) for _, v, s in ranked)
        hits += len({r[1] for r in ranked} & set(want[q]))
    assert hits / (20 * len(want)) >= 0.95
    assert [r[1] for r in sorted(got[2020])] == [i for i in range(2000, 2300) if i != 2020][:20]


def test_columns_begin_with_those_of_the_answer(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    for df in (few, few.limit(0)):
        assert additive_ann.search(df, k=2).columns == ["query_id", "rank", "vec_id", "score", "query_row"]


def test_exact_bound_misses_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 12)) * rng.exponential(size=(1500, 1))
    ids, own = np.arange(1500), np.arange(0, 1500, 20)
    # With so coarse codes and no allowance for their errors, neighbours are missed.
    books = additive_ann.fit_codebooks(x, levels=1, words=8)
    codes, errors = additive_ann.encode(x, books)
    monkeypatch.setattr(additive_ann, "SIGMAS", 0.0)
    monkeypatch.setattr(additive_ann, "FIRST", 4)
    missed = {}
    for exact in (False, True):
        found = additive_ann.search_block(own, x[own], ids, ids, x, codes, errors, books, 5, exact)
        missed[exact] = 0
        for q, (places, _) in zip(own, found, strict=True):
            score = (x * x[q]).sum(1)
            score[q] = -np.inf
            missed[exact] += len(set(np.lexsort((ids, -score))[:5].tolist()) - set(places.tolist()))
    assert missed[True] == 0 < missed[False]
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in additive_ann.search(df, k=5, exact=True).collect()}
    for q in own.tolist():
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        assert [got[q, r] for r in range(1, 6)] == np.lexsort((ids, -score))[:5].tolist()


def test_more_neighbours_than_first_candidates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    books = additive_ann.fit_codebooks(x, words=16)
    codes, errors = additive_ann.encode(x, books)
    ids = np.arange(300)
    for of, (found, scores) in enumerate(additive_ann.search_block(ids[:5], x[:5], ids, ids, x, codes, errors, books, 100)):
        assert len(set(found) - {of}) == len(found) == 100
        assert scores[0] == max(additive_ann.exact_scores(np.delete(x, of, 0), x[of]))


def test_rows_that_repeat_an_id(spark):
    """Each is a query and a candidate, and only a query's own row is left out."""
    data = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (0, [1.0, 0.0])]
    got = {}
    for r in additive_ann.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), k=20).orderBy("query_row", "rank").collect():
        got.setdefault(r["query_row"], []).append((r["query_id"], r["rank"], r["vec_id"], r["score"]))
    a = [(0, 1, 0, 1.0), (0, 2, 1, 0.5), (0, 3, 1, 0.5), (0, 4, 0, 0.0)]
    b = [(0, 1, 1, 0.25), (0, 2, 1, 0.25), (0, 3, 0, 0.0), (0, 4, 0, 0.0)]
    assert sorted(got.values()) == sorted([a, a, b])


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in additive_ann.search(few, k=20).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert additive_ann.search(few.limit(0), k=20).count() == 0


def test_beam_search_is_no_worse_than_greedy():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    books = additive_ann.fit_codebooks(x, levels=4, words=32)
    codes, errors = additive_ann.encode(x, books, beam=8)
    rebuilt = sum(books[m][codes[:, m]] for m in range(4))
    assert np.allclose(np.linalg.norm(x - rebuilt, axis=1), errors, atol=1e-3)
    assert errors.mean() <= additive_ann.encode(x, books, beam=1)[1].mean() + 1e-6


def test_pipeline(spark, docs, tmp_path):
    docs = docs.withColumns({c: F.lit("mine") for c in ("_own", "spans", "redacted", "n_email", "own", "_id", "_sha", "a.b", "kept", "perplexity", "threshold", "row", "te`xt")})
    docs = docs.withColumn("a_map", F.create_map(F.lit("k"), F.lit(1)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1, 0) for i in (1, 2, 3, 6, 9, 10, 13, 19)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = corpus_pipeline.written(stage(spark, at, str(tmp_path)))
        assert at.columns == docs.columns and {(r["spans"], r["a.b"], r["kept"], r["perplexity"], r["te`xt"], r["a_map"]["k"]) for r in at.collect()} == {(*["mine"] * 5, 1)}
        kept[name] = {r["doc_id"]: r["text"] for r in at.collect()}
    assert {1, 2, 3, 6, 9, 10, 13, 19} <= set(kept["quality"])
    # 20 repeats the text of 1 and 2; of 6, 7 and 8 the near-duplicate class keeps one.
    assert not {1, 2} & set(kept["exact_dedup"]) and 20 in kept["exact_dedup"]
    assert not ({6, 7, 8} & set(kept["near_dedup"])) - {min({6, 7, 8} & set(kept["exact_dedup"]))}
    assert "example.com" not in kept["pii"][13] and "[EMAIL]" in kept["pii"][13]
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(kept["pii"])


def test_pipeline_tells_rows_of_one_id_apart(spark):
    other = prose(40, 60)
    rows = [(1, prose(1, 60), "en", "s", 0), (7, prose(1, 59) + " changed", "en", "s", 0), (7, other, "en", "s", 0), (9, prose(9, 50), "en", "s", 0), (9, prose(9, 50), "en", "s", 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    exact = corpus_pipeline.written(corpus_pipeline.keep_exact(spark, table, ""))
    assert sorted(r["doc_id"] for r in exact.collect()) == [1, 7, 7, 9]
    near = corpus_pipeline.keep_one_of_near(spark, exact, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in near) == [(1, rows[0][1]), (7, other), (9, rows[3][1])]


def test_pipeline_of_nothing(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
