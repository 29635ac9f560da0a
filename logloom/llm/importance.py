"""Importance resampling towards a target distribution.

A text is lower-cased in A-Z, split into words by an untrained Regex Split of the
tokenizers library, which gives words with offsets; every word and every pair of
neighbouring offsets is a feature, hashed by CRC-32 into one of BUCKETS. Texts are
split once: each document's buckets are written as 16-bit numbers, from which the
histogram is counted and the gains are summed. The two histograms and the gains have
BUCKETS entries whatever the input.

The draw adds Gumbel noise from the id's digest to the mean gain and takes the
highest scores. Scores are whole numbers in a range that doubles bound (under
120,000 values), so positions come from counts by score and an order inside each.

Null and empty texts have no features and weight 0. A null id is hashed as the word
"null" and comes before other ids of its score. Each row is a document of its own, also
if it repeats an id; such rows are ordered by their features and weight. With no
benchmark all target counts are 0; an empty table gives no rows. Further columns are
not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from logloom.functions.ranking import running
from logloom.llm.common import UPPER, lower_ascii, text_of, written

#: The words, the number of buckets, the words of a document that may be
#: drawn, the share that is drawn in per cent, the seed of the noise.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

_LOWER = str.maketrans(UPPER, UPPER.lower())
#: Bytes of buckets that a record batch holds before it is handed on.
_BATCH_BYTES = 8 << 20
_ROWS = "doc_id bigint, n_words bigint, buckets binary"


@lru_cache(maxsize=1)
def _split() -> Split:
    return Split(Regex(WORD), behavior="removed", invert=True)


def words_of(text: str) -> list[tuple[str, tuple[int, int]]]:
    """The words of a lower-cased text, with their offsets in code points."""
    return _split().pre_tokenize_str(text)


def buckets_of(text: str) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each feature: single words, then pairs."""
    found = words_of(text)
    words = [word.encode() for word, _ in found]
    ones = list(map(crc32, words))
    # A pair is its first word's checksum carried on over a space and the second word,
    # whatever stands between the two offsets.
    twos = list(map(crc32, [b" " + word for word in words[1:]], ones))
    return len(words), (np.array(ones + twos, np.uint32) % BUCKETS).astype("<u2")


def bucketed(rows: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """doc_id, n_words and buckets (16-bit, little-endian) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, held, size, start = batch.column(0), [], [], 0, 0
            for i, text in enumerate(batch.column(1)):
                n, found = buckets_of(text.as_py())
                words.append(n)
                held.append(found.tobytes())
                size += len(held[-1])
                if size >= _BATCH_BYTES or i + 1 == len(batch):
                    yield pa.RecordBatch.from_arrays([ids.slice(start, len(held)), pa.array(words, pa.int64()), pa.array(held, pa.binary())], names=["doc_id", "n_words", "buckets"])
                    words, held, size, start = [], [], 0, i + 1

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), lower_ascii(text_of(text_col)).alias("_text")).mapInArrow(run, _ROWS)


def histogram(coded: DataFrame) -> np.ndarray:
    """Features in each bucket; a task hands on at most BUCKETS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.bincount(np.frombuffer(one.as_py(), "<u2"), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    counted = coded.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to source share, each count with one added."""
    s_all, t_all = int(source.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None) -> int:
    """Thousandths of a Gumbel variate out of the id's digest."""
    h = int(sha256(f"{SEED}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(coded: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, weights = batch.column(0).to_pylist(), [], []
            for one in batch.column(2):
                found = np.frombuffer(one.as_py(), "<u2")
                sizes.append(len(found))
                weights.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            scores = [w + noise(i) for w, i in zip(weights, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, weights, scores))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return coded.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def drawn(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Add rank: 1, 2, 3 ... by falling score, ties by smaller id; null where undrawn."""
    counts = rows.filter(F.col("n_words") >= LEAST_WORDS).groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.floor(F.sum("_n") * percent / 100).alias("_most"))
    # A row a score, of which there are under 120,000; ordered within bands of scores.
    placed = running(counts, -F.floor(F.col("score") / 64), [F.desc("score")], {"_upto": F.col("_n")}).crossJoin(F.broadcast(total))  # one row
    places = F.broadcast(placed.select(F.col("score").alias("_score"), (F.col("_upto") - F.col("_n")).alias("_before"), "_most").filter("_before < _most"))
    fits = (rows["score"] == places["_score"]) & (rows["n_words"] >= LEAST_WORDS)
    near = rows.join(places, fits, "left")
    order = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")
    ranked = near.filter("_before IS NOT NULL").withColumn("rank", F.col("_before") + F.row_number().over(order))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= F.col("_most"), F.col("rank")).cast("long"))
    rest = near.filter("_before IS NULL").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("_score", "_before", "_most")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of docs, drawn towards the texts of target."""
    coded = written(bucketed(docs, "doc_id"))
    gain = gains(histogram(coded), histogram(bucketed(target, "item_id")))
    return drawn(written(scored(coded, gain)), percent).select("doc_id", "n_features", "weight", "score", "rank")
