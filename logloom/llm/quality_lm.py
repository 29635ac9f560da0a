"""Quality classifier: interpolated modified Kneser-Ney over byte 4-grams.

Models are trained on all trusted text. Tasks reduce their texts to counts of
4-grams; continuation counts, discounts, back-off weights and the interpolated
probabilities of every order are joins and aggregates of the count tables,
sharded by model and gram, which grow with the trusted text.

A text is dealt to one of two folds by its hash (so equal texts share one), and
is scored by its language's model of the other fold. So no text is scored by a
model that has seen it, and the trusted texts' scores are held-out ones, of the
same distribution as those of other good texts.

The score of a document is a sum over its grams. Each gram has a full value (its
log-probability) and two additive ones: delta, what seeing it adds to its
back-off, and gamma, the weight that it leaves as a context. The most frequent
entries of the model, at most HEAD_ENTRIES, are sent to the tasks, which keeps
frequent grams out of any join; a document's other grams are counted, joined
with the sharded table and summed by document. The sum is exact whatever is sent.

The limit of a language comes from its trusted texts. A quantile q of n such
scores is supported where n * (1 - q) is at least 1, so that no single odd text
is the limit. Of the supported ones of QUANTILES a language has the one with the
greatest difference between the shares of trusted documents and of documents of
quality 0 that stay, or the largest where these don't tell. A language without a
supported quantile, and so one with few or no trusted texts, has a null threshold
and keeps all its documents.

Null text is empty; texts without bytes have null perplexity and are kept.
A null language is the language ''. Where a language has no model of the other
fold, its texts get their perplexity from the model of all languages' texts of
that fold; without that, null. Trusted is an id whose labels all say quality 1
and none toxic 1, nulls apart. Repeated rows are counted and scored each; extra columns are
kept, whatever their names (perplexity, threshold and kept replace columns of
these names).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import checkpointed, compacted, written

ORDER = 4
FOLDS = 2  # a text's model is the other one's
QUANTILES = (0.95, 0.98, 0.99, 0.995, 0.999)  # of held-out scores; a language has one of these
HEAD_ENTRIES = 100_000  # of the model that are sent to tasks, 40 bytes each; all others are joined
BROADCAST_IDS = 4_000_000  # at most 32 MB of ids; more are joined by a shuffle
BROADCAST_NAMES = 100_000  # languages and models; more are joined by a shuffle
CHUNK = 1 << 22  # grams sorted at a time
STEP = 1 << 17  # bytes scored at a time
SLICE = 1 << 22  # bytes of texts laid out at a time, or one text
BINS = 1000  # of a bit per byte, for quantiles
#: The language name of the model of all trusted text; '\0' is in no language name.
POOLED = "\0"
#: What stands before a text.
EDGE = 10
#: A gram of k bytes is k << ORDER_SHIFT | its bytes, the first one highest.
ORDER_SHIFT = 8 * ORDER


def _mask(order: int) -> int:
    return (1 << 8 * order) - 1


def _small(rows: DataFrame, most: int) -> DataFrame:
    """rows, checkpointed, and sent to the tasks where they are at most so many."""
    rows = compacted(rows)
    return F.broadcast(rows) if rows.count() <= most else rows


def _model_key(lang: Column, fold: Column) -> Column:
    return F.xxhash64(lang, fold)


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def label_ids(labels: DataFrame) -> DataFrame:
    """id, good of the trusted ids and of those of quality 0."""
    return _small(
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_q"), F.max(F.coalesce("toxic", F.lit(0))).alias("_t"))
        .filter("_q = 0 OR _q = 1 AND _t = 0")
        .selectExpr("doc_id AS id", "_q = 1 AS good"),
        BROADCAST_IDS,
    )


# Training


def _sliced(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows again, with at most SLICE bytes of text at a time, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, ORDER - 1 edge bytes before each, and where each text's bytes start (one more at the end)."""
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    pad = ORDER - 1
    starts = np.append(0, np.cumsum(np.diff(offsets) + pad)) + pad
    out = np.full(int(starts[-1]) - pad, EDGE, np.uint8)
    for to, a, b in zip(starts.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=False):
        out[to : to + b - a] = data[a:b]
    return out, starts


def _codes(data: np.ndarray) -> np.ndarray:
    """The ORDER bytes that end at each byte of data from its ORDER-th on, as one number."""
    if len(data) < ORDER:
        return np.zeros(0, np.int64)
    one = data.astype(np.int64)
    n = len(one) - ORDER + 1
    out = one[:n]
    for k in range(1, ORDER):
        out = out << 8 | one[k : k + n]
    return out


_COUNTS = pa.schema([("model", pa.int64()), ("code", pa.int64()), ("n", pa.int64())])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[np.ndarray]] = {}
    sizes: dict[int, int] = {}

    def counted(model: int) -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(held.pop(model)), return_counts=True)
        sizes.pop(model)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), model)), pa.array(codes), pa.array(n)], schema=_COUNTS)

    for batch in _sliced(batches, "text"):
        data, starts = _padded(batch.column(1))
        ends = starts[1:] - ORDER + 1
        for model, start, end in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), ends.tolist(), strict=True):
            for at in range(start, end, CHUNK):
                codes = _codes(data[at - ORDER + 1 : min(at + CHUNK, end)])
                held.setdefault(model, []).append(codes)
                sizes[model] = sizes.get(model, 0) + len(codes)
                if sizes[model] >= CHUNK:
                    yield counted(model)
        # Bounded also where models are many.
        if sum(sizes.values()) >= 2 * CHUNK:
            for model in list(held):
                yield counted(model)
    for model in list(held):
        yield counted(model)


def _discounts(counts: DataFrame) -> DataFrame:
    """model, level, d1, d2, d3 of every order."""
    of = lambda k: F.count_if(F.col("n") == k).cast("double").alias(f"n{k}")
    n1, n2, n3, n4 = (F.col(f"n{k}") for k in range(1, 5))
    y = n1 / (n1 + 2 * n2)
    # Where a count of counts is missing, the discount is the one of an even decay.
    rule = lambda k, a, b: F.coalesce(F.when((a > 0) & (b > 0), F.greatest(F.lit(0.0), F.least(F.lit(float(k)), k - (k + 1) * y * b / a))), F.lit(k - 0.25))
    found = counts.groupBy("model", "level").agg(*(of(k) for k in range(1, 5)))
    return _small(found.select("model", "level", rule(1, n1, n2).alias("d1"), rule(2, n2, n3).alias("d2"), rule(3, n3, n4).alias("d3")), BROADCAST_NAMES)


def _all_orders(counts: DataFrame) -> DataFrame:
    """model, level, code, n of every order: occurrences of the highest, continuations of the others."""
    own, out = counts, counts.select("model", F.lit(ORDER).alias("level"), "code", "n")
    for k in range(ORDER - 1, 0, -1):
        own = own.groupBy("model", F.col("code").bitwiseAND(F.lit(_mask(k))).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(own.select("model", F.lit(k).alias("level"), "code", "n"))
    return out


def train(trusted: DataFrame, pooled: bool = False) -> DataFrame:
    """The model of trusted texts (lang, fold, text): model, code, n, full, delta, gamma (log2).

    n: how often training would look the gram up. A gram that is only a context
    has null full and delta. A context has at most 256 followers, so none is a
    hot key.
    """
    parts = trusted.select(_model_key(F.col("lang"), F.col("fold")).alias("model"), "text").mapInArrow(_count, "model bigint, code bigint, n bigint")
    if pooled:
        every = trusted.select(_model_key(F.lit(POOLED), F.col("fold")).alias("model"), "text").mapInArrow(_count, "model bigint, code bigint, n bigint")
        parts = parts.unionByName(every)
    counts = written(_all_orders(written(parts.groupBy("model", "code").agg(F.sum("n").alias("n")))))
    counts = counts.withColumn("context", F.shiftright("code", 8)).join(_discounts(counts), ["model", "level"])
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    weights = written(counts.groupBy("model", "level", "context").agg(F.sum("n").alias("total"), (F.sum(d) / F.sum("n")).alias("weight")))
    share = F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")
    seen = written(counts.join(weights, ["model", "level", "context"]).select("model", "level", "code", "n", share.alias("share"), "weight"))
    tag = lambda c, level: F.col(c).bitwiseOR(F.shiftleft(level.cast("long"), ORDER_SHIFT)).alias("code")
    none = F.lit(None).cast("double")
    # The empty context is looked up wherever a first byte is unknown, and no table ranks it.
    n = F.when(F.col("level") == 1, F.lit(1 << 62)).otherwise(F.lit(0)).alias("n")
    entries = weights.select("model", tag("context", F.col("level") - 1), n, none.alias("full"), none.alias("delta"), F.log2(F.greatest("weight", F.lit(1e-12))).alias("gamma"))
    lower = None
    for k in range(1, ORDER + 1):
        grams = seen.filter(F.col("level") == k)
        if lower is None:
            grams = grams.withColumn("below", F.lit(1 / 256))
        else:
            suffix = lower.select("model", F.col("code").alias("suffix"), F.col("p").alias("below"))
            grams = grams.withColumn("suffix", F.col("code").bitwiseAND(F.lit(_mask(k - 1)))).join(suffix, ["model", "suffix"])
        backed = F.col("weight") * F.col("below")
        p = F.col("share") + backed
        lower = written(grams.select("model", "code", "n", p.alias("p"), (F.log2(p) - F.log2(backed)).alias("delta")))
        entries = entries.unionByName(lower.select("model", tag("code", F.lit(k)), "n", F.log2("p").alias("full"), "delta", none.alias("gamma")))
    return written(entries.groupBy("model", "code").agg(*(F.max(c).alias(c) for c in ("n", "full", "delta", "gamma"))))


def split_head(model: DataFrame) -> tuple[pa.Table, DataFrame]:
    """The most frequent entries, at most HEAD_ENTRIES, and the table of all others."""
    level = F.floor(F.log2(F.greatest("n", F.lit(1)).cast("double")) * 8)
    held, least = 0, None
    for row in model.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # at most 500 levels
        held += row["count"]
        if held > HEAD_ENTRIES:
            break
        least = row["level"]
    head = model.filter(level >= least) if least is not None else model.limit(0)
    tail = model.filter(level < least) if least is not None else model
    return head.select("model", "code", "full", "delta", "gamma").toArrow(), tail.select("model", "code", "delta", "gamma")


# Scoring


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Head:
    """The entries that are sent, in a table with open addressing."""

    def __init__(self, model: np.ndarray, code: np.ndarray, full: np.ndarray, gamma: np.ndarray):
        self.full, self.gamma = full, gamma  # of entries; not a number where there is none
        keys = self.keys(model, code)
        self.mask = np.uint64((1 << max(4, (2 * len(keys)).bit_length())) - 1)
        self.slots = np.full(int(self.mask) + 1, -1, np.int32)
        self.held = np.zeros(int(self.mask) + 1, np.uint64)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slot = (keys[left] + np.uint64(self.probes) & self.mask).astype(np.int64)
            # The first of those that want a free slot has it.
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.slots[slot[won]] = left[won]
            self.held[slot[won]] = keys[left[won]]
            left = np.delete(left, won)
            self.probes += 1

    @staticmethod
    def keys(model: np.ndarray, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mix(code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ model.view(np.uint64))

    def find(self, model: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Number of the entry of each gram, -1 where there is none."""
        keys = self.keys(model, code)
        out = np.full(len(keys), -1, np.int32)
        left = np.arange(len(keys))
        for probe in range(self.probes):
            slot = (keys[left] + np.uint64(probe) & self.mask).astype(np.int64)
            entry = self.slots[slot]
            hit = (entry >= 0) & (self.held[slot] == keys[left])
            out[left[hit]] = entry[hit]
            left = left[(entry >= 0) & ~hit]
            if not len(left):
                break
        return out


def score_positions(head: Head, model: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the head knows of each position's log-probability, and what it doesn't know:
    (positions, grams) whose delta and (positions, grams) whose gamma is to be added."""
    known = np.zeros(len(codes))
    left = np.arange(len(codes))
    deltas, gammas = [], []
    for k in range(ORDER, 0, -1):
        gram = (codes[left] & _mask(k)) | (k << ORDER_SHIFT)
        entry = head.find(model[left], gram)
        full = np.where(entry >= 0, head.full[entry], np.nan) if len(head.full) else np.full(len(left), np.nan)
        has = ~np.isnan(full)
        known[left[has]] += full[has]
        left, gram = left[~has], gram[~has]
        if not len(left):
            break
        deltas.append((left, gram))
        context = (codes[left] & _mask(k)) >> 8 | ((k - 1) << ORDER_SHIFT)
        entry = head.find(model[left], context)
        inside = entry >= 0
        # A context in the head without a weight has none.
        known[left[inside]] += np.nan_to_num(head.gamma[entry[inside]])
        gammas.append((left[~inside], context[~inside]))
    known[left] += np.log2(1 / 256)
    joined = lambda parts, i: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64)
    return known, joined(deltas, 0), joined(deltas, 1), joined(gammas, 0), joined(gammas, 1)


_KEY_BITS = ORDER_SHIFT + 3


def score_batch(head: Head, models: np.ndarray, valid: np.ndarray, texts: pa.Array, whole: bool) -> list[pa.Array]:
    """bits (of what the head knows), bytes, and the grams to be joined with their numbers, for each text.

    whole: the head is all of the model, so that what it lacks is unseen.
    """
    data, starts = _padded(texts)
    sizes = np.diff(starts) - (ORDER - 1)
    sums = np.zeros(len(sizes))
    keys, numbers = [], []
    # The text that a byte belongs to; edge bytes belong to none.
    owner = np.full(len(data), -1, np.int32)
    for i in np.flatnonzero(valid).tolist():
        owner[starts[i] : starts[i] + sizes[i]] = i
    for at in range(0, len(data), STEP):
        own = owner[at : at + STEP]
        ends = np.flatnonzero(own >= 0)
        if not len(ends):
            continue
        codes = _codes(data[max(at - ORDER + 1, 0) : at + STEP])[ends - (ORDER - 1 if at == 0 else 0)]
        own = own[ends]
        known, dp, dg, gp, gg = score_positions(head, models[own], codes)
        sums += np.bincount(own, known, len(sizes))
        if not whole:
            d, g = own[dp].astype(np.int64) << _KEY_BITS | dg, own[gp].astype(np.int64) << _KEY_BITS | gg
            found, place = np.unique(np.concatenate([d, g]), return_inverse=True)
            keys.append(found)
            numbers.append((np.bincount(place[: len(d)], minlength=len(found)), np.bincount(place[len(d) :], minlength=len(found))))
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    nd, ng = (np.concatenate([n[i] for n in numbers]) if numbers else np.zeros(0, np.int64) for i in (0, 1))
    order = np.argsort(key, kind="stable")
    key, nd, ng = key[order], nd[order], ng[order]
    offsets = np.searchsorted(key >> _KEY_BITS, np.arange(len(sizes) + 1)).astype(np.int32)
    listed = lambda values, kind: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
    return [pa.array(sums), pa.array(sizes), listed(key & ((1 << _KEY_BITS) - 1), pa.int64()), listed(nd, pa.int32()), listed(ng, pa.int32())]


def _scored(texts: DataFrame, model: DataFrame) -> DataFrame:
    """own, id, lang and bits per byte of texts (own, id, lang, model, text); null bits without model or bytes."""
    head, tail = split_head(model)
    whole = tail.isEmpty()
    columns = [head.column(c).to_numpy() for c in ("model", "code", "full", "gamma")]  # null is not a number
    sent = texts.sparkSession.sparkContext.broadcast(columns)  # at most HEAD_ENTRIES
    given = [texts.schema[c] for c in ("row", "own", "id", "lang", "model")]
    added = T._parse_datatype_string("sum double, bytes bigint, code array<bigint>, nd array<int>, ng array<int>")
    schema = T.StructType([*given, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = Head(*sent.value)
        for batch in _sliced(batches, "text"):
            of = batch.column("model")
            known = np.asarray(of.is_valid())
            models = np.asarray(of.fill_null(0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in given), *score_batch(head, models, known, batch.column("text"), whole)], names=schema.names)

    first = written(texts.select("row", "own", "id", "lang", "model", "text").mapInArrow(run, schema))
    sent.destroy()  # nothing reads it again: the result is a written table
    bits = lambda total: F.when(F.col("model").isNotNull() & (F.col("bytes") > 0), -total / F.col("bytes"))
    if whole:
        return first.select("own", "id", "lang", bits(F.col("sum")).alias("bits"))
    asked = first.select("row", "model", F.explode(F.arrays_zip("code", "nd", "ng")).alias("x")).select("row", "model", "x.*")
    value = F.col("nd") * F.coalesce("delta", F.lit(0.0)) + F.col("ng") * F.coalesce("gamma", F.lit(0.0))
    more = written(asked.join(tail, ["model", "code"]).groupBy("row").agg(F.sum(value).alias("more")))
    out = first.select("row", "own", "id", "lang", "model", "sum", "bytes").join(more, "row", "left")
    return out.select("own", "id", "lang", bits(F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("bits"))


# Limits


def _cuts(scored: DataFrame, wanted: tuple[float, ...]) -> DataFrame:
    """lang, q, threshold, n, good, bad: per quantile the least bin end that `q` of the
    good values don't exceed, their number, and the shares of good and bad that stay.

    Values are counted in bins of 1/BINS bit, so no task holds a language's values.
    """
    bins = scored.filter(F.col("bits").isNotNull()).groupBy("lang", F.ceil(F.col("bits") * BINS).alias("bin"))
    bins = bins.agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    total = bins.groupBy("lang").agg(F.sum("g").alias("n"), F.sum("b").alias("bad_n")).filter("n > 0")
    # At most 60 bits a byte, so a language has 60 * BINS bins at most.
    upto = "sum({0}) OVER (PARTITION BY lang ORDER BY bin) AS {0}"
    running = bins.selectExpr("lang", "bin", upto.format("g"), upto.format("b")).join(total, "lang")
    cuts = running.withColumn("q", F.explode(F.array(*(F.lit(q) for q in wanted)))).filter(F.col("g") >= F.col("q") * F.col("n"))
    first = cuts.groupBy("lang", "q").agg(F.min(F.struct("bin", "n", "g", "b", "bad_n")).alias("x")).select("lang", "q", "x.*")
    return first.selectExpr("lang", "q", f"bin / {BINS} AS threshold", "n", "g / n AS good", "coalesce(try_divide(b, bad_n), 0) AS bad")


def quantiles(scored: DataFrame, quantile: float) -> DataFrame:
    """lang, threshold: the least bin end that `quantile` of the values don't exceed."""
    return _cuts(scored.withColumn("good", F.lit(True)), (quantile,)).select("lang", "threshold")


def limits(scored: DataFrame, wanted: tuple[float, ...] = QUANTILES) -> DataFrame:
    """lang, threshold: the supported quantile that parts good from bad values best."""
    cuts = _cuts(scored, wanted).filter(F.col("n") * (1 - F.col("q")) >= 1)
    return cuts.groupBy("lang").agg(F.max_by("threshold", F.struct(F.col("good") - F.col("bad"), F.col("q"))).alias("threshold"))


def quality(docs: DataFrame, labels: DataFrame, wanted: tuple[float, ...] = QUANTILES, carry: tuple[str, ...] | None = None) -> DataFrame:
    """Add perplexity (per byte), threshold (of it) and kept to docs (doc_id, text, lang, ...).

    carry: the columns of docs to return; all unless given.
    """
    rest = [c for c in (docs.columns if carry is None else carry) if c not in ("perplexity", "threshold", "kept")]
    text = F.coalesce(F.col("text"), F.lit(""))
    # Any column may be called anything: docs' own travel inside a struct.
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("own"),
        F.col("doc_id").alias("id"), F.coalesce("lang", F.lit("")).alias("lang"), _fold(text).alias("fold"), text.alias("text"),
    )
    ids = label_ids(labels)
    trusted = texts.select("id", "lang", "fold", "text").join(ids, "id").filter("good")
    names = checkpointed(trusted.groupBy("lang", "fold").agg(F.count(F.lit(1)).alias("n")))
    folds = [r["fold"] for r in names.select("fold").distinct().collect()]  # at most FOLDS
    if not folds:
        none = F.lit(None).cast("double")
        return texts.select("own.*", none.alias("perplexity"), none.alias("threshold"), F.lit(True).alias("kept"))
    complete = names.groupBy("lang").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") == FOLDS)
    pooled = not texts.select("lang").distinct().join(complete, "lang", "left_anti").isEmpty()
    model = train(trusted, pooled)
    named = _small(names.select("lang", (FOLDS - 1 - F.col("fold")).alias("fold"), F.lit(True).alias("own_model")), BROADCAST_NAMES)
    other = F.lit(FOLDS - 1) - F.col("fold")
    key = F.when(F.col("own_model"), _model_key(F.col("lang"), other)).when(other.isin(folds) & F.lit(pooled), _model_key(F.lit(POOLED), other))
    scored = _scored(texts.join(named, ["lang", "fold"], "left").withColumn("model", key), model)
    held = scored.filter(F.col("id").isNotNull()).select("id", "lang", "bits").join(ids, "id").select("lang", "bits", "good")
    limit = _small(limits(held, wanted), BROADCAST_NAMES)
    out = scored.join(limit, "lang", "left")
    kept = F.coalesce(F.col("bits") <= F.col("threshold"), F.lit(True))
    power = lambda c: F.pow(F.lit(2.0), F.col(c))
    return out.select("own", power("bits").alias("perplexity"), power("threshold").alias("threshold"), kept.alias("kept")).select("own.*", "perplexity", "threshold", "kept")
