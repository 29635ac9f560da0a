"""Packing of token ids into sequences of a fixed capacity.

Documents become ids inside tasks, and each task packs what it reads in blocks
of bounded size; nothing is shuffled and no block depends on another, so a lost
task is simply run again. Sequence ids hold the partition's number in their
upper bits, so they are unique without coordination.

karmarkar_karp (op4) balances windows by multiway differencing and cuts only
documents that fill a whole window; best_fit (op3) places pieces by best fit
decreasing.

Null text is an empty document, which still has its end id. Rows are packed as
they come: repeated rows, null ids and ties each get pieces of their own, and
extra columns are left out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import batched
from logloom.llm.pretokenize import encoder

CAPACITY = 2048
END_ID = 1
DEFAULT_FILE = "byte_bpe_50k.json"


def token_ids(text: str, path: str, end_id: int = END_ID) -> np.ndarray:
    """uint32 ids of the text and the end id. The encoder reads ranks and added tokens out
    of the tokenizer's file and gives the same ids as the file's own library, which
    takes the added tokens' strings in a text for these tokens."""
    ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    return np.append(ids, np.uint32(end_id)).astype("<u4", copy=False)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: indices of sizes, dealt to `windows` near-equal sums.

    A partial partition lists its used windows as (sum, indices), largest first.
    The two of widest spread are merged, the largest windows of one with the
    smallest of the other, until one partition is left.
    """
    order = count()
    heap = [(-size, next(order), [(size, (i, None, None))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heapq.heappop(heap)[2]
        # Unused windows are empty ones: as many of b's windows fall on them as there is room.
        room = windows - len(a)
        alone, meet = b[: max(0, room)], b[max(0, room) :]
        merged = a + alone
        for k, (size, tree) in enumerate(meet):
            # b's rest, from its largest on, meets a's windows from the smallest on.
            place = len(a) - 1 - k
            other, tree_a = merged[place]
            merged[place] = (other + size, (None, tree_a, tree))
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, next(order), merged))
    return [_leaves(tree) for _, tree in heap[0][2]] if heap else []


def _leaves(tree: tuple) -> list[int]:
    out, stack = [], [tree]
    while stack:
        index, left, right = stack.pop()
        if index is None:
            stack += [right, left]
        else:
            out.append(index)
    return out


def balanced_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most `capacity`; their number rises until all of them fit."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differencing(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return dealt
        windows += 1


class _Blocks:
    """Gathers the rests of documents until they fill a block of windows."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.goal = capacity, windows * capacity
        self.held: list[tuple] = []
        self.total = 0

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[list[tuple]]:
        """Windows of pieces (doc, start, ids, doc_tokens): whole ones at once, others as a block fills."""
        whole = len(ids) - len(ids) % self.capacity
        for at in range(0, whole, self.capacity):
            yield [(doc, at, ids[at : at + self.capacity], len(ids))]
        if whole < len(ids):
            self.held.append((doc, whole, ids[whole:], len(ids)))
            self.total += len(ids) - whole
            if self.total >= self.goal:
                yield from self.flush()

    def flush(self) -> list[list[tuple]]:
        held, self.held, self.total = self.held, [], 0
        return [[held[i] for i in window] for window in balanced_windows([len(p[2]) for p in held], self.capacity)]


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
_ARROW_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


def karmarkar_karp(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    windows: int = 128,
    with_ids: bool = True,
) -> DataFrame:
    """doc_id, start, length, ids (little-endian uint32, or null without with_ids),
    ids_crc32, doc_tokens, sequence_id and offset of each piece.

    A document of at least `capacity` ids fills whole windows first. What is left,
    and any shorter document, is one piece; pieces are gathered until they would
    fill `windows` windows and are dealt to as few windows as differencing keeps
    within capacity, starting from the least number that could hold them.
    """
    path = path or public_tokenizers.path(DEFAULT_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        sequence = count((task.partitionId() if task else 0) << 40)

        def dealt() -> Iterator[list[tuple]]:
            blocks = _Blocks(capacity, windows)
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield from blocks.add(doc, token_ids(text or "", path))
            yield from blocks.flush()

        def rows() -> Iterator[tuple]:
            for window in dealt():
                own, offset = next(sequence), 0
                for doc, start, ids, total in window:
                    data = ids.tobytes()
                    yield doc, start, len(ids), data if with_ids else None, zlib.crc32(data), total, own, offset
                    offset += len(ids)

        yield from batched(rows(), _ARROW_PIECES)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


class CapacityTree:
    """Segment tree over remaining capacities: which of them some bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, left: int, number: int) -> None:
        self.bins[left].append(number)
        node = left + self.size
        while node and not self.some[node]:
            self.some[node] = 1
            node //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """The smallest remaining capacity of at least `need`, and a bin with it."""
        some, node = self.some, need + self.size
        while not some[node]:
            # Up to the first right neighbour that has bins, then down its left side.
            while node & 1 or not some[node + 1]:
                node //= 2
                if node <= 1:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if some[2 * node] else 2 * node + 1
        left = node - self.size
        number = self.bins[left].pop()
        if not self.bins[left]:
            some[node] = 0
            node //= 2
            while node and not (some[2 * node] or some[2 * node + 1]):
                some[node] = 0
                node //= 2
        return left, number


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of sizes by bin, each piece in the fullest bin that takes it."""
    tree, bins = CapacityTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = capacity, len(bins)
            bins.append([])
        left, number = found
        bins[number].append(i)
        tree.add(left - sizes[i], number)
    return bins


SEQUENCES = T.StructType(
    [
        T.StructField("sequence_id", T.LongType()),
        T.StructField("input_ids", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("cu_lengths", T.ArrayType(T.IntegerType())),
        T.StructField("position_resets", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
    ]
)
_ARROW_SEQUENCES = pa.schema(
    [("sequence_id", pa.int64()), ("input_ids", pa.binary()), ("n_tokens", pa.int64()), ("cu_lengths", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64()))]
)


def best_fit(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, pad_id: int = 0, block_tokens: int = 4_000_000) -> DataFrame:
    """One row per packed sequence: a row of the id matrix and its segments.

    input_ids: `capacity` ids, unsigned 16-bit and little-endian (32-bit if the
    vocabulary needs it), padded with pad_id. cu_lengths: cumulative segment
    lengths from 0 to n_tokens. position_resets: where positions start again at
    0, the padding's start included. doc_ids, starts: each segment's document
    and the ids of it that come before.

    A document longer than capacity is cut into whole sequences and a rest. Best
    fit decreasing runs over blocks of block_tokens ids of a task.
    """
    path = path or public_tokenizers.path(DEFAULT_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        sequence = count((task.partitionId() if task else 0) << 40)
        kind = "<u2" if encoder(path).n_vocab <= 1 << 16 else "<u4"

        def packed(held: list[tuple]) -> Iterator[tuple]:
            for window in best_fit_decreasing([len(p[2]) for p in held], capacity):
                row = np.full(capacity, pad_id, kind)
                cuts = [0]
                for i in window:
                    ids = held[i][2]
                    row[cuts[-1] : cuts[-1] + len(ids)] = ids
                    cuts.append(cuts[-1] + len(ids))
                resets = cuts if cuts[-1] < capacity else cuts[:-1]
                yield next(sequence), row.tobytes(), cuts[-1], cuts, resets, [held[i][0] for i in window], [held[i][1] for i in window]

        def rows() -> Iterator[tuple]:
            held: list[tuple] = []
            total = 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    ids = token_ids(text or "", path)
                    for at in range(0, len(ids), capacity):
                        piece = ids[at : at + capacity].astype(kind)
                        held.append((doc, at, piece))
                        total += len(piece)
                    if total >= block_tokens:
                        yield from packed(held)
                        held, total = [], 0
            yield from packed(held)

        yield from batched(rows(), _ARROW_SEQUENCES, 1024)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEQUENCES)


def position_ids(cu_lengths: list[int], capacity: int = CAPACITY) -> np.ndarray:
    """Positions of a sequence's ids: each segment, and the padding, counts from 0."""
    out = np.arange(capacity, dtype=np.int32)
    for start, end in zip(cu_lengths, [*cu_lengths[1:], capacity], strict=True):
        out[start:end] -= start
    return out


def write_matrices(sequences: DataFrame, path: str) -> None:
    """Write packed sequences as Parquet, a matrix row and its segments per row.

    Rows are stored in the order of sequence_id inside each file and without
    compression, so that a loader maps whole column chunks of ids.
    """
    sequences.sortWithinPartitions("sequence_id").write.mode("overwrite").option("compression", "none").parquet(path)


def matrix(rows: pa.Table, capacity: int = CAPACITY) -> np.ndarray:
    """The id matrix of written sequences that were read into memory, one row each."""
    ids = b"".join(rows.column("input_ids").to_pylist())
    kind = "<u2" if len(ids) == 2 * capacity * len(rows) else "<u4"
    return np.frombuffer(ids, kind).reshape(len(rows), capacity)
