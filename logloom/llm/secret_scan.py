"""Secrets: patterns, and a character network over every other candidate.

Base spans are the patterns' leftmost matches per kind (assign, access, hex). Every
other run of at least LEAST_RUN token characters is a candidate, with CONTEXT
characters around it, and gets a span of kind net where a convolutional network finds
it likely enough.

The network learns from labelled findings: values of base spans are secrets; words,
numbers and parts of addresses are not; other candidates carry no label. All distinct
findings are learned from, whatever their number and length: they are dealt by their hash into
shards of about SHARD findings, each pass takes every shard through the network in a task of its own, and
the next pass starts from the mean of what the shards made of it. So that it learns what a
secret looks like and not the patterns' cues alone, each secret also comes with the surroundings of a harmless
finding, and with a random value in its place; harmless ones also come joined with a
number or another word. A quarter of the findings (by the value's hash) is held out:
on all of it, counted by thousandths of a logit, scores are calibrated, and each shape's threshold is the highest that keeps
RECALL of the secrets held out, those with exchanged surroundings and values included.

The texts are read once, for base spans and candidates; learning and scoring read
the written candidates. Candidates of any length are scored whole.

Null text is empty; rows are scanned one by one, whatever their order, length or
repetition, and null ids are kept. With fewer than LEAST_FINDINGS findings of a class, or
an empty table, there is no network and base spans come alone. Columns named in carry
are returned, whatever their names; spans and n_<kind> replace columns of these names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.char_cnn import Example, Network, State, calibrated, passed
from logloom.llm.common import checkpointed, written

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "net")
LEAST_RUN = 12
CONTEXT = 24
#: Findings and characters of a shard, about; and of each class at least so many, repeated where there are too few.
SHARD, SHARD_CHARS, SHARD_LEAST = 8_192, 16 << 20, 8
#: Passes over all findings: PASSES over the shards, MOST_PASSES at most, LEAST_PASSES at least.
PASSES, MOST_PASSES, LEAST_PASSES = 16, 8, 2
LEAST_FINDINGS = 10
RECALL = 0.97

#: The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: A text without any of these, lower-cased, has no assignment.
_CUES = ("passw", "secret", "token", "api")
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
_HARMLESS = re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*|[0-9]+(?:[-/][0-9]+)*|[-_=+/]+")
_ALL_HEX = re.compile(r"[0-9a-fA-F]+")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())]))
_CANDIDATES = T.ArrayType(T.StructType([*(T.StructField(c, T.IntegerType()) for c in ("start", "end", "label", "lead")), T.StructField("around", T.StringType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
_ARROW_CANDIDATES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.int32()), ("lead", pa.int32()), ("around", pa.string())]))

Span = tuple[int, int, int]  # start, number of the kind, end


def base_spans(text: str, runs: Sequence[tuple[int, int]] | None = None) -> tuple[list[Span], list[tuple[int, int]]]:
    """The patterns' spans, and the place of each one's value."""
    spans, values = [], []
    low = text.lower()
    if any(c in low for c in _CUES):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                spans.append((m.start(), 0, m.end()))
                values.append(m.span(2))
    # Matches of the other kinds that are long enough lie inside of runs, whole.
    for start, end in runs_of(text) if runs is None else runs:
        if end - start < min(LEAST["access"], LEAST["hex"]):
            continue
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            for m in pattern.finditer(text, start, end):
                if len(m[0]) >= LEAST[KINDS[kind]]:
                    spans.append((m.start(), kind, m.end()))
                    values.append(m.span())
    return sorted(spans), values


def runs_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _RUN.finditer(text)]


def candidates(text: str) -> tuple[list[Span], list[tuple[int, int, int | None]]]:
    """Base spans; and (start, end, label) of their values and of all runs that touch none of them."""
    runs = runs_of(text)
    spans, values = base_spans(text, runs)
    found: list[tuple[int, int, int | None]] = [(a, b, 1) for a, b in dict.fromkeys(values)]
    starts, reach = [s for s, _, _ in spans], []
    for _, _, end in spans:
        reach.append(max(end, reach[-1] if reach else 0))
    for a, b in runs:
        i = bisect_right(starts, b - 1)
        if i and reach[i - 1] > a:
            continue
        address = text[b : b + 1] == "@" or text[max(a - 1, 0) : a] == "@" or text[max(a - 3, 0) : a] == "://"
        found.append((a, b, 0 if address or _HARMLESS.fullmatch(text, a, b) else None))
    return spans, found


def scanned(docs: DataFrame, carry: Sequence[str], text_col: str = "text") -> DataFrame:
    """own (a struct of the carried columns), spans and candidates of each row."""
    own = T.StructType([docs.schema[c] for c in carry])
    schema = T.StructType([T.StructField("own", own), T.StructField("spans", SPANS), T.StructField("candidates", _CANDIDATES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, held = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                own, found = candidates(text)
                spans.append([{"kind": KINDS[k], "start": s, "end": e, "p": None} for s, k, e in own])
                held.append([{"start": a, "end": b, "label": y, "lead": min(a, CONTEXT), "around": text[max(a - CONTEXT, 0) : b + CONTEXT]} for a, b, y in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW_SPANS), pa.array(held, _ARROW_CANDIDATES)], names=schema.names)

    return docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("own"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Finding:
    before: str
    value: str
    after: str
    #: One that another shard holds too, or made of such a one.
    copy: bool = False

    def example(self) -> Example:
        return self.before + self.value + self.after, len(self.before), len(self.before) + len(self.value)


@dataclass(frozen=True)
class Findings:
    """All labelled findings, each once: label, lead, size, around, shard, copy; a partition holds whole shards, in order."""

    rows: DataFrame
    harmless: int
    secrets: int
    shards: int


def findings(found: DataFrame, shard: int = SHARD) -> Findings:
    """Every distinct labelled finding, dealt by hash. A class with fewer than SHARD_LEAST findings a shard is repeated
    in several (copy > 0), so that each shard knows both."""
    one = found.select(F.explode("candidates").alias("c")).select("c.*").filter("label IS NOT NULL")
    once = written(one.select("label", "lead", (F.col("end") - F.col("start")).alias("size"), "around").distinct())
    facts = {r["label"]: r for r in once.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("around")).alias("chars")).collect()}
    n = {y: facts[y]["n"] if y in facts else 0 for y in (0, 1)}
    shards = max(1, -(-sum(n.values()) // shard), -(-sum(r["chars"] for r in facts.values()) // SHARD_CHARS))
    times = {y: min(shards, -(-SHARD_LEAST * shards // max(n[y], 1))) for y in (0, 1)}
    copies = F.when(F.col("label") == 1, times[1]).otherwise(times[0])
    h = F.xxhash64("around", "lead", "size")
    dealt = once.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).withColumn("shard", F.pmod(h + F.col("copy"), F.lit(shards)).cast("int"))
    parts = min(shards, 2 * found.sparkSession.sparkContext.defaultParallelism)
    rows = dealt.repartitionById(parts, F.col("shard") % parts).sortWithinPartitions("shard", h, "around", "lead", "size", "label", "copy")
    return Findings(checkpointed(rows), n[0], n[1], shards)


#: Alphabets of the random values.
_LOW, _UP, _NUM = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALPHABETS = (_NUM + _LOW[:6], _NUM + _UP[:6], _UP + "234567", _LOW + _NUM, _LOW + _UP + _NUM, _LOW + _UP + _NUM + "+/", _LOW + _UP + _NUM + "-_")


def _digest(value: str) -> bytes:
    return sha256(value.encode("utf-8", "surrogatepass")).digest()


#: Secrets below which each gets several random values.
_FEW = 400


def held_out(value: str) -> bool:
    return _digest(value)[8] % 4 == 0


def enlarged(positive: list[Finding], negative: list[Finding], times: int) -> list[tuple[Finding, int]]:
    """(finding, label): the findings and what is made of them, of a secret so many times."""
    out = []
    for f in positive:
        d = _digest(f.value)
        rng = np.random.default_rng(int.from_bytes(d[:8], "little"))
        out.append((f, 1))
        for _ in range(times):
            other = negative[int(rng.integers(len(negative)))] if negative else f
            letters = list(_ALPHABETS[int(rng.integers(len(_ALPHABETS)))])
            random = "".join(rng.choice(letters, int(rng.integers(20, 65))))
            shapes = [Finding(other.before, random, other.after, f.copy), Finding(f.before, random, f.after, f.copy)]
            # A value that is a word is a secret by its cue alone.
            if not _HARMLESS.fullmatch(f.value):
                shapes.append(Finding(other.before, f.value, other.after, f.copy))
            out += [(x, 1) for x in shapes]
    for f in negative:
        d = _digest(f.value)
        other, number = negative[int.from_bytes(d[:8], "little") % len(negative)].value, 1 + int.from_bytes(d[9:13], "little") % 9_999
        match d[13] % 6:
            case 0: joined = f"{f.value}-{number}"
            case 1: joined = f"{f.value}_{other}"
            case 2: joined = f"{number}-{f.value}"
            case 3: joined = f"{f.value}{number}"
            case 4: joined = f"{f.value.title()}/{number}"
            case _: joined = f.value.upper()
        out += [(f, 0), (Finding(f.before, joined, f.after, f.copy), 0)]
    return out


def shape(value: str) -> int:
    """0: hexadecimal, 1: letters or digits alone, 2: other."""
    return 0 if _ALL_HEX.fullmatch(value) and len(value) >= 16 else 1 if _HARMLESS.fullmatch(value) else 2


def _probability(logits: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scale[0] * logits + scale[1], -50, 50)))


@dataclass(frozen=True)
class Scanner:
    """A network, its calibration, a threshold for each shape, and how it did on what was held out."""

    network: Network
    scale: tuple[float, float]
    thresholds: tuple[float, float, float]
    recall: float
    precision: float
    #: Distinct findings that it was fitted on, those held out included.
    findings: int = 0

    def probabilities(self, examples: Sequence[Example]) -> np.ndarray:
        return _probability(self.network.logits(examples), self.scale)


#: Logits are counted by 1 / STEPS, and held between -LARGEST and LARGEST.
STEPS, LARGEST = 1_000, 100


def _shards(batches: Iterator[pa.RecordBatch], times: int, held: bool) -> Iterator[tuple[int, int, list[tuple[Finding, int]]]]:
    """Of each shard: its number, how many findings it holds (copies not counted), and what enlarged() makes of
    those that are held out, or of the others; all that stems from one value is on one side."""

    def made(rows: list[dict]) -> tuple:
        own: dict[int, list[Finding]] = {0: [], 1: []}
        for r in rows:
            a, b, around = r["lead"], r["lead"] + r["size"], r["around"]
            if held_out(around[a:b]) is held:
                own[r["label"]].append(Finding(around[:a], around[a:b], around[b:], r["copy"] > 0))
        return rows[0]["shard"], sum(not r["copy"] for r in rows), enlarged(own[1], own[0], times)

    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["shard"] != rows[0]["shard"]:
                yield made(rows)
                rows = []
            rows.append(row)
    if rows:
        yield made(rows)


def _passed(found: Findings, state: State, times: int, seed: int) -> tuple[State, tuple[int, int, int]]:
    """The mean of what the shards make of the state by a pass over all their findings; and the findings
    read, and the harmless and secret examples learned from."""
    # Whole numbers, so that the mean is the same in whatever order shards are summed.
    shards = found.shards
    unit = 2.0 ** (56 - shards.bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for shard, n, fit in _shards(batches, times, held=False):
            labels = np.array([y for _, y in fit])
            new = passed(state, [f.example() for f, _ in fit], labels, seed=seed * shards + shard) if fit else state
            own = np.append(np.rint(new.flat() * unit).astype(np.int64), [new.step, n, (labels == 0).sum(), (labels == 1).sum()])
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "v"])

    sums = found.rows.mapInArrow(run, "at bigint, v bigint").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()  # the network's size
    values = np.array([r["v"] for r in sums])
    return state.filled(values[:-4] / unit / shards, int(values[-4]) // shards), tuple(int(v) for v in values[-3:])


def _counted(found: Findings, network: Network, times: int) -> np.ndarray:
    """label, shape, logit and number of what is held out, by rounded logit: rows of a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, made in _shards(batches, times, held=True):
            own = [(f, y) for f, y in made if not f.copy]
            logits = np.concatenate([network.logits([f.example() for f, _ in own[i : i + 1024]]) for i in range(0, len(own), 1024)] or [np.zeros(0)])
            at = np.floor(np.clip(logits, -LARGEST, LARGEST) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([y for _, y in own], pa.int32()), pa.array([shape(f.value) for f, _ in own], pa.int32()), pa.array(at)], names=["label", "shape", "at"])

    rows = found.rows.mapInArrow(run, "label int, shape int, at bigint").groupBy("label", "shape", "at").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "shape", "at").collect()
    return np.array([(r["label"], r["shape"], r["at"] / STEPS, r["n"]) for r in rows]).reshape(-1, 4)


def _fit(found: Findings, recall: float = RECALL) -> Scanner | None:
    if min(found.harmless, found.secrets) < LEAST_FINDINGS:
        return None
    times = -(-_FEW // found.secrets)
    state, read = State.new(), (0, 0, 0)
    for seed in range(min(MOST_PASSES, max(LEAST_PASSES, -(-PASSES // found.shards)))):
        state, read = _passed(found, state, times, seed)
        if not min(read[1:]):
            return None
    labels, kinds, logits, often = _counted(found, state.network, times).T
    if len(set(labels)) < 2:
        return None
    scale = calibrated(logits, labels, counts=often)
    p = _probability(logits, scale)

    def highest(own: np.ndarray) -> float:
        own = own & (labels == 1)
        order = np.argsort(p[own], kind="stable")
        upto = np.cumsum(often[own][order])
        return float(p[own][order][np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")])

    whole = highest(labels >= 0)
    # A shape with few secrets held out takes the threshold of all.
    thresholds = tuple(highest(kinds == k) if often[(kinds == k) & (labels == 1)].sum() >= LEAST_FINDINGS else whole for k in range(3))
    said = p >= np.array(thresholds)[kinds.astype(int)]
    hits = often[said & (labels == 1)].sum()
    return Scanner(state.network, scale, thresholds, float(hits / often[labels == 1].sum()), float(hits / max(often[said].sum(), 1)), read[0])


def fitted(found: DataFrame, shard: int = SHARD) -> Scanner | None:
    """A scanner out of all labelled findings of what scanned() gives."""
    return _fit(findings(found, shard))


def secret_scan(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """The carried columns, spans array<struct<kind, start, end, p>> by start, then kind (p: the
    network's probability), and n_<kind> of the base kinds. scanner: one that was fitted before."""
    carry = [c for c in carry if c not in ("spans", *(f"n_{k}" for k in BASE))]
    found = written(scanned(docs, carry, text_col))
    model = scanner or fitted(found)
    schema = T.StructType(found.schema.fields[:2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(1).to_pylist()
            rows = [(i, c) for i, cs in enumerate(batch.column(2).to_pylist()) for c in cs if c["label"] != 1]
            for at in range(0, len(rows), 1024):
                some = rows[at : at + 1024]
                ps = model.probabilities([(c["around"], c["lead"], c["lead"] + c["end"] - c["start"]) for _, c in some])
                for (i, c), p in zip(some, ps.tolist(), strict=True):
                    if p >= model.thresholds[shape(c["around"][c["lead"] : c["lead"] + c["end"] - c["start"]])]:
                        spans[i].append({"kind": "net", "start": c["start"], "end": c["end"], "p": p})
            ordered = [sorted(x, key=lambda s: (s["start"], KINDS.index(s["kind"]))) for x in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ordered, _ARROW_SPANS)], names=schema.names)

    out = found.mapInArrow(run, schema) if model else found
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return out.select(*(F.col(f"own.`{c}`") for c in carry), "spans", *counts)
