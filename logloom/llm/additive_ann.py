"""Nearest neighbours by additive quantisation.

Full-dimensional codebooks are fitted level by level on the residuals of a
bounded sample. Every vector is encoded by beam search over them, with the norm
of what the code leaves out. Searching is done on a grid of query blocks and
data blocks: lookup tables score all codes of a block, the best are scored
exactly, and the exact score of the k-th of them together with the stored norms
decides which others are still worth an exact look. No number of candidates is
fixed beforehand. By default an error is taken to lie in any direction alike, so
SIGMAS of its share along the query count as possible; exact=True takes the
whole norm, a bound that no vector can exceed, and so misses no neighbour.

Nearness is the inner product in double precision, ties go to the smaller id.
Vectors that are null or zero, hold null or non-finite components or have a null
id take no part; nor do those that have no inner product with the table's, being
not of the most common length (the smaller of equally common ones). Each row is a
query or a candidate of its own: rows that repeat an id are found and asked for
like any other, and query_row, the last column, tells their answers apart (its
numbers depend on how the table is laid out, and mean nothing else). Extra columns are left
out. An empty table has an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed

LEVELS = 8  # codebooks
WORDS = 256  # of a codebook
BEAM = 4
SAMPLE = 8192  # rows that codebooks are fitted on: those of the smallest id hash
ROUNDS = 8  # of k-means
DATA_BLOCK = 8192
QUERY_BLOCK = 512
FIRST = 64  # candidates that are scored exactly first, or k where that is more
SIGMAS = 2.5  # of a code's error that count as possible


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row (a number), vec_id, vector array<double> of the rows that take part."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), x.alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    rows = rows.filter(sound)
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (length["n"] if length else 0))


def fit_codebooks(sample: np.ndarray, levels: int = LEVELS, words: int = WORDS, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """levels x words x dimensions: k-means on what the levels before leave."""
    rng = np.random.default_rng(seed)
    rest = sample.astype(np.float32)
    books = np.zeros((levels, words, sample.shape[1]), np.float32)
    for level in range(levels):
        book = rest[rng.choice(len(rest), words, replace=len(rest) < words)].copy()
        for _ in range(rounds):
            nearest = (rest @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
            filled = np.bincount(nearest, minlength=words)
            order = np.argsort(nearest, kind="stable")
            starts = np.searchsorted(nearest[order], np.flatnonzero(filled))
            book[filled > 0] = np.add.reduceat(rest[order], starts) / filled[filled > 0, None]
            # Empty words move to the rows that are worst served.
            if empty := int((filled == 0).sum()):
                far = np.argsort(-((rest - book[nearest]) ** 2).sum(1), kind="stable")[:empty]
                book[np.flatnonzero(filled == 0)[: len(far)]] = rest[far]
        nearest = (rest @ book.T - 0.5 * (book * book).sum(1)).argmax(1)
        rest = rest - book[nearest]
        books[level] = book
    return books


def encode(vectors: np.ndarray, books: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x levels) and norms of the errors, by beam search."""
    n, levels = len(vectors), len(books)
    rest = vectors.astype(np.float32)[:, None, :]
    codes = np.zeros((n, 1, 0), np.uint8)
    rows = np.arange(n)[:, None]
    for book in books:
        cost = (rest * rest).sum(2)[:, :, None] - 2 * (rest @ book.T) + (book * book).sum(1)
        flat = cost.reshape(n, -1)
        width = min(beam, flat.shape[1])
        best = np.argpartition(flat, width - 1, axis=1)[:, :width]
        from_beam, word = best // len(book), best % len(book)
        rest = rest[rows, from_beam] - book[word]
        codes = np.concatenate([codes[rows, from_beam], word[:, :, None].astype(np.uint8)], axis=2)
    last = (rest * rest).sum(2)
    first = last.argmin(1)
    return codes[np.arange(n), first], np.sqrt(last[np.arange(n), first])


_BLOCK = "block int, n int, rows binary, ids binary, vectors binary, codes binary, errors binary"


def _blocks(vectors: DataFrame, number: int, books=None) -> DataFrame:
    """One row for each block of vectors, ids in order; with codes if books is a broadcast."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        flat = np.asarray(table.column("vector").combine_chunks().flatten())
        own, ids = (table.column(c).to_numpy() for c in ("row", "vec_id"))
        order = np.lexsort((own, ids))
        own, ids, x = own[order], ids[order], flat.reshape(len(ids), -1)[order]
        codes = errors = None
        if books is not None:
            parts = [encode(x[i : i + 1024], books.value) for i in range(0, len(x), 1024)]
            codes, errors = (np.concatenate(p) for p in zip(*parts, strict=True))
        values = [key[0].as_py(), len(ids), own.tobytes(), ids.tobytes(), x.tobytes(), codes.tobytes() if codes is not None else None, errors.tobytes() if errors is not None else None]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table({name: pa.array([v], t) for name, v, t in zip(("block", "n", "rows", "ids", "vectors", "codes", "errors"), values, types, strict=True)})

    hashed = vectors.withColumn("block", F.pmod(F.xxhash64("row", F.lit(11)), F.lit(number)).cast("int"))
    return hashed.groupBy("block").applyInArrow(pack, _BLOCK)


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed alike for every row."""
    return (vectors * query).sum(1)


def search_block(query_rows, queries, rows, ids, vectors, codes, errors, books, k: int, exact_bound: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query of a block: places and exact scores of the block's k nearest found."""
    tables = queries.astype(np.float32) @ books.reshape(-1, books.shape[2]).T
    tables = tables.reshape(len(queries), len(books), -1)
    approx = np.zeros((len(queries), len(ids)), np.float32)
    for level in range(len(books)):
        approx += np.take(tables[:, level], codes[:, level], axis=1)
    least = max(FIRST, k)  # so that the exact score of a k-th is always known
    spread = errors * (SIGMAS / np.sqrt(vectors.shape[1]))
    if exact_bound:  # by Cauchy and Schwarz; the second term is what single precision may lose
        spread = errors + 2.0**-16 * (np.sqrt((vectors * vectors).sum(1)).astype(np.float32) + errors)
    for i, query in enumerate(queries):
        score, own = approx[i], rows == query_rows[i]
        score[own] = -np.inf
        first = np.arange(len(ids))
        if len(ids) > least + 1:
            cut = np.partition(score, len(ids) - least)[len(ids) - least]
            first = np.flatnonzero(score >= cut)[: 2 * least]
        first = first[~own[first]]
        exact = exact_scores(vectors[first], query)
        if len(first) >= k:
            floor = np.partition(exact, len(exact) - k)[len(exact) - k]
            more = score + spread * np.float32(np.sqrt(query @ query)) >= floor
            more[first] = False
            more &= ~own
            also = np.flatnonzero(more)
            first = np.append(first, also)
            exact = np.append(exact, exact_scores(vectors[also], query))
        order = np.lexsort((rows[first], ids[first], -exact))[:k]
        yield first[order], exact[order]


_FOUND = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search(vectors: DataFrame, is_query=None, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score, query_row: the k nearest found of each query row, itself apart.

    is_query: condition on the id column; every 20th id unless given. exact: see above.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, query_row bigint")
    rows = checkpointed(valid_vectors(vectors, id_col, vector_col))
    condition = is_query if is_query is not None else F.pmod(F.col("vec_id"), F.lit(20)) == 0
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("q")).first()
    if not counted["q"]:
        return empty
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    books = fit_codebooks(np.asarray(sample.flatten()).reshape(len(sample), -1))
    sent = spark.sparkContext.broadcast(books)  # LEVELS * WORDS vectors

    data_blocks, query_blocks = -(-counted["n"] // DATA_BLOCK), -(-counted["q"] // QUERY_BLOCK)
    data = _blocks(rows, data_blocks, sent)
    queries = _blocks(rows.filter(condition), query_blocks).select(F.col("block").alias("query_block"), F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"))
    # Query blocks, the smaller side, are dealt to every data block: the grid is Q x N by nature.
    # Where data blocks are few, each is given out several times, to different query blocks.
    times = min(query_blocks, -(-2 * spark.sparkContext.defaultParallelism // data_blocks))
    data = data.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(data_blocks - 1)))).withColumn("turn", F.col("query_block") % times)
    grid = queries.join(data, ["block", "turn"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        for batch in batches:
            for row in batch.to_pylist():
                own, ids, query_rows, query_ids = (np.frombuffer(row[c], np.int64) for c in ("rows", "ids", "query_rows", "query_ids"))
                x, q = (np.frombuffer(row[c], np.float64).reshape(m, -1) for c, m in (("vectors", len(ids)), ("queries", len(query_ids))))
                codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
                found = list(search_block(query_rows, q, own, ids, x, codes, np.frombuffer(row["errors"], np.float32), books, k, exact))
                of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                place = np.concatenate([f[0] for f in found])
                columns = query_rows[of], query_ids[of], own[place], ids[place], np.concatenate([f[1] for f in found])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_FOUND)

    found = grid.mapInArrow(run, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double")
    rank = "CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, row) AS INT) AS rank"
    return found.selectExpr("query_id", rank, "vec_id", "score", "query_row").filter(F.col("rank") <= k)
