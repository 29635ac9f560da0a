"""Byte-level BPE by backtracking over longest matches.

A piece's bytes, read as Latin-1, go through an Aho-Corasick automaton of the
vocabulary, which gives the longest token at each place. Tokens are taken left
to right; one is accepted if it is compatible with the one before it, that is
if merging both tokens' bytes anew gives back just these two. Otherwise the
next shorter token is tried, and where there is none the token before is given
up. No place is entered twice, so the work is linear in the piece, and the
result is the one that merging by rank gives.

Null text is empty (no ids). Rows are encoded one by one, so repeated rows,
null ids and extra columns (kept; ids, n_tokens and decoded replace columns of
these names) need no care.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import unused
from logloom.llm.pretokenize import pieces_of, ranks_of

MEMO_ENTRIES = 400_000  # pieces and pairs remembered in a worker, each
MEMO_CHARS = 48  # longer pieces aren't remembered


def merge_by_rank(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: join the adjacent pair of lowest rank until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class _Memo(dict):
    """Piece to the bytes of its ids (unsigned 32-bit, little-endian), computed on demand."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


class BytePairs:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        self.ranks = ranks_of(path)
        self.rank_of = {token.decode("latin-1"): rank for token, rank in self.ranks.items()}
        self.id_bytes = {token: rank.to_bytes(4, "little") for token, rank in self.rank_of.items()}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
            # A token that merging can't produce stands only for a whole piece.
            if len(token) <= 2 or merge_by_rank(token, self.ranks) == [token]:
                self.automaton.add_word(token.decode("latin-1"), len(token))
        self.automaton.make_automaton()
        self.shorter: dict[str, str] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo = _Memo(self._piece)

    def _compatible(self, a: str, b: str) -> bool:
        if a + b in self.automaton:
            known = False
        else:
            first, second = a.encode("latin-1"), b.encode("latin-1")
            known = merge_by_rank(first + second, self.ranks) == [first, second]
        if len(self.pairs) >= MEMO_ENTRIES:
            self.pairs.clear()
        self.pairs[a, b] = known
        return known

    def _next_shorter(self, token: str) -> str:
        """The longest proper prefix that is a token, or ''."""
        found = self.shorter.get(token)
        if found is None:
            found = next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.automaton), "")
            self.shorter[token] = found
        return found

    def split(self, data: str) -> list[str]:
        """Tokens of one piece, all as Latin-1 text."""
        if data in self.rank_of:
            return [data]
        size = len(data)
        longest = [1] * size
        for end, length in self.automaton.iter(data):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        dead = bytearray(size + 1)  # places from which no encoding goes on
        found: list[str] = []
        pairs, at, token = self.pairs, 0, data[: longest[0]]
        while True:
            to = at + len(token)
            if not dead[to]:
                fits = True
                if found:
                    fits = pairs.get((found[-1], token))
                    if fits is None:
                        fits = self._compatible(found[-1], token)
                if fits:
                    found.append(token)
                    if to == size:
                        return found
                    at = to
                    token = data[at : at + longest[at]]
                    continue
            token = self._next_shorter(token)
            while not token:
                dead[at] = 1
                last = found.pop()
                at -= len(last)
                token = self._next_shorter(last)

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.id_bytes.__getitem__, self.split(piece.encode("utf-8").decode("latin-1"))))

    def encode(self, text: str) -> bytes:
        """The ids, unsigned 32-bit and little-endian."""
        return b"".join(map(self.memo.__getitem__, pieces_of(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """One encoder per worker and file; its memory is bounded by MEMO_ENTRIES."""
    return BytePairs(path)


DEFAULT_FILE = "byte_bpe_multi_50k.tiktoken"


def encode(docs: DataFrame, path: str | None = None, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Add ids array<int> and, if asked for, decoded binary: what the ids stand for.

    path: the vocabulary file, which every executor must have.
    """
    path = path or public_tokenizers.path(DEFAULT_FILE)
    rest = [c for c in docs.columns if c not in ("ids", "decoded")]
    fields = [docs.schema[c] for c in rest]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.BinaryType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_pairs(path)
        for batch in batches:
            coded = [bpe.encode(x or "") for x in batch.columns[-1].to_pylist()]
            offsets = np.zeros(len(coded) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(coded), np.int32), pa.int32())
            columns = [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), values)]
            if decoded:
                columns.append(pa.array([bpe.decode(np.frombuffer(x, np.uint32).tolist()) for x in coded], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text_col).alias(unused(docs, "_text")[0])).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """Add decoded binary to rows with ids; null ids count as none."""
    path = path or public_tokenizers.path(DEFAULT_FILE)
    rest = [c for c in coded.columns if c != "decoded"]
    schema = T.StructType([coded.schema[c] for c in rest] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_pairs(path)
        for batch in batches:
            out = pa.array([bpe.decode(x or []) for x in batch.column(ids_col).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=schema.names)

    return coded.select(*rest).mapInArrow(run, schema)
