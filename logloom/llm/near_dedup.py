"""Near-duplicate classes by ProbMinHash signatures.

Documents are weighted sets of word shingles (weight: occurrences). Each
element's arrivals, a Poisson process of its weight's rate, fall on registers,
and a register keeps its first arrival; an element stops once it is later than
all registers. Two documents agree in a register with their probability Jaccard
similarity, which bands turn into candidates and exact verification decides.

Copies collapse first, so only different word sequences are compared. Buckets
are compared in three passes, none of which pairs up a bucket's members. Each
bucket has a centre: its member of the least draw, and the draw is a member's
own, so that the buckets of a group share few centres. First each member meets
one centre, the least drawn of its buckets', which joins most groups with one link
a member; then those that a bucket's centre isn't joined with meet that centre;
then, where a bucket still has several components, the members outside the
largest one meet all others, block by block: signatures rule out most pairs, and
the rest are verified in place. Any pair that shares a bucket is thus verified,
joined by other links, or ruled out by its signatures.

Null text is empty; texts without words form one class of equal texts. Words are
split at ASCII white space and lower-cased; texts of fewer words than a shingle
are one shingle. Rows are documents: repeated rows are copies of each other.
Null ids are ordered before all others and may be a class id only where a class
has no other. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import ASCII_BLANKS, checkpointed, compacted, written
from logloom.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 128
BANDS, BAND_ROWS = 24, 4
#: Least agreeing registers of a pair that goes on from signatures to verification: at
#: similarity 0.8 fewer have a probability of 2e-5.
AGREE = 84
BLOCK = 256  # signatures compared with as many others at a time, or fewer of long documents
BLOCK_BYTES = 16 << 20  # of words in a block, or one document
BROADCAST_IDS = 4_000_000  # at most 32 MB; more are joined by a shuffle

_GOLDEN, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.lower(text), F.lit(ASCII_BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s+", -1))


def shingles(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle; words: hashes of all documents' words,
    ends: where each document's words end."""
    starts = np.append(0, ends[:-1])
    sizes = ends - starts
    number = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(ends)), number)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number) + starts[doc]
    padded = np.append(words.astype(np.uint64) + np.uint64(1), np.zeros(SHINGLE, np.uint64))
    out = np.zeros(len(doc), np.uint64)
    for k in range(SHINGLE):
        word = np.where(first + k < ends[doc], padded[first + k], np.uint64(0))
        out = _mix(out * _GOLDEN + word)
    return doc, out


def weighted(doc: np.ndarray, hashes: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, element, weight), by document and element; elements have 48 bits and more."""
    if not len(doc):
        return doc, hashes, np.zeros(0)
    bits = max(1, int(docs - 1).bit_length())
    keys = np.sort((doc.astype(np.uint64) << np.uint64(64 - bits)) | (hashes >> np.uint64(bits)))
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    count = np.diff(np.append(new, len(keys))).astype(np.float64)
    keys = keys[new]
    # The lower 48 bits alone name an element, however many documents came together.
    return (keys >> np.uint64(64 - bits)).astype(np.int64), (keys >> np.uint64(16 - bits)) & np.uint64((1 << 48) - 1), count


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """docs x registers: the element that arrives first in each register."""
    first = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, np.uint64)
    time = np.zeros(len(doc))
    seed = _mix(element + _GOLDEN)
    turn = 0
    while len(doc):
        turn += 1
        with np.errstate(over="ignore"):
            random = _mix(seed + _GOLDEN * np.uint64(turn))
        time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        place = doc * registers + (_mix(random ^ _MIX1) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        winner[place[won]] = element[won]
        # Early termination: later than every register, an element changes nothing any more.
        latest = first.reshape(docs, registers).max(1)
        on = time < latest[doc]
        doc, element, weight, time, seed = doc[on], element[on], weight[on], time[on], seed[on]
    return winner.reshape(docs, registers)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """docs x bands, one hash for each band and its registers."""
    out = np.zeros((len(signatures), BANDS), np.uint64)
    out += np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX2
    parts = signatures[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        for k in range(BAND_ROWS):
            out = _mix(out * _GOLDEN + parts[:, :, k])
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, doc_id, content, words -> the same with their number, bands and signature."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2048):
            batch = whole.slice(at, 2048)
            lists = batch.column("words")
            offsets = np.asarray(lists.offsets)
            values = np.asarray(lists.values)[offsets[0] : offsets[-1]].astype(np.uint32)
            ends = (offsets[1:] - offsets[0]).astype(np.int64)
            n = len(ends)
            signatures = prob_minhash(*weighted(*shingles(values, ends), n), n)
            some = np.diff(np.append(0, ends)) > 0
            keys = band_keys(signatures)[some].ravel()
            data, small = values.tobytes(), signatures.astype(np.uint32).tobytes()
            cut = np.append(0, ends) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "doc_id", "content")),
                    pa.array(np.diff(np.append(0, ends)).astype(np.int32)),
                    pa.array([data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(some * BANDS)).astype(np.int32)), pa.array(keys)),
                    pa.array([small[i * REGISTERS * 4 : (i + 1) * REGISTERS * 4] for i in range(n)], pa.binary()),
                ],
                names=["row", "doc_id", "content", "n_words", "words", "bands", "signature"],
            )


def content(words):
    """Digest of a column of words."""
    return F.unhex(F.md5(F.array_join(words, " ")))


def sign(docs: DataFrame) -> DataFrame:
    """row, doc_id, content (digest of the words), n_words, words (32-bit hashes), bands, signature."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words_of(text).alias("w"))
    hashed = rows.select("row", "doc_id", content(F.col("w")).alias("content"), F.transform("w", lambda x: F.xxhash64(x).bitwiseAND(0xFFFFFFFF)).alias("words"))
    return hashed.mapInArrow(_sign, "row bigint, doc_id bigint, content binary, n_words int, words binary, bands array<bigint>, signature binary")


def probability_jaccard(a: tuple[np.ndarray, np.ndarray | None], b: tuple[np.ndarray, np.ndarray | None]) -> float:
    """Exact, of two (sorted elements, weights); weights None: all 1."""
    (ea, wa), (eb, wb) = a, b
    if not len(ea) or not len(eb):
        return float(len(ea) == len(eb))
    at = np.searchsorted(eb, ea)
    at[at == len(eb)] = 0
    shared = eb[at] == ea
    n = int(np.count_nonzero(shared))
    if not n:
        return 0.0
    if wa is None and wb is None:
        return n / (len(ea) + len(eb) - n)
    wa = np.ones(len(ea)) if wa is None else wa
    wb = np.ones(len(eb)) if wb is None else wb
    x, y = wa[shared], wb[at[shared]]
    # For an element of ratio r = x / y the others count by x where their ratio is larger, by y where not.
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    above = wa[~shared].sum() + np.append(np.cumsum(x[::-1])[::-1], 0)
    below = wb.sum() - y.sum() + np.append(0, np.cumsum(y))
    upto = np.searchsorted(ratio, ratio, side="right")
    return float((1 / (above[upto] / x + below[upto] / y)).sum())


@lru_cache(maxsize=512)
def _elements(words: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    """Sorted elements and weights of a document; documents of a bucket come again and again."""
    values = np.frombuffer(words, np.uint32)
    _, element, weight = weighted(*shingles(values, np.array([len(values)])), 1)
    return element, weight if len(weight) and weight.max() > 1 else None


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple = (None, None)
    for batch in batches:
        found = []
        for a, b, wa, wb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "wa", "wb")), strict=True):
            if last[0] != a:
                last = a, _elements(wa)
            if probability_jaccard(last[1], _elements(wb)) >= SIMILARITY:
                found.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _picked(signed: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """node and columns of the given nodes, of which alone the wide columns are shuffled."""
    nodes = compacted(nodes.select(F.col("node").alias("row")).distinct())
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    out = signed.select("row", *columns).join(nodes, "row", "left_semi")
    return compacted(out.withColumnRenamed("row", "node"), 10_000)


def verified(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity passes. pairs is read twice: give it written."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    words = _picked(signed, nodes, "words")
    # Merged: both sides grow with the input, and no texts are to pass through the driver.
    left, right = words.toDF("a", "wa").hint("merge"), words.toDF("b", "wb").hint("merge")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInArrow(_verify, "a bigint, b bigint")


class _Joined(dict):
    """Labels that links found so far have joined."""

    def find(self, label: int) -> int:
        while self.get(label, label) != label:
            label = self[label]
        return label


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between minors and other members of a bucket, for a pair of blocks a row.

    A pair is looked at in the first band that it shares, and not if the row's
    links already join its components.
    """
    for batch in batches:
        for row in batch.to_pylist():
            members, joined, links = row["members"], _Joined(), []
            sigs = np.stack([np.frombuffer(x["signature"], np.uint32) for x in members])
            labels = np.array([x["label"] for x in members])
            for x in row["minors"]:
                equal = sigs == np.frombuffer(x["signature"], np.uint32)
                shared = equal[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS).all(2)
                likely = (equal.sum(1) >= AGREE) & (shared.argmax(1) == row["band"]) & shared[:, row["band"]] & (labels != x["label"])
                own = None
                for i in np.flatnonzero(likely):
                    of, to = joined.find(x["label"]), joined.find(int(labels[i]))
                    if of == to:
                        continue
                    own = own or _elements(x["words"])
                    if probability_jaccard(own, _elements(members[i]["words"])) >= SIMILARITY:
                        joined[of] = to
                        links.append((x["node"], members[i]["node"]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """Add the component of a column of nodes; a node without links is its own."""
    named = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    joined = rows.join(named.hint("merge"), rows[node] == named["_node"], "left")
    return joined.select(*rows.columns, F.coalesce("_label", node).alias(label))


def _rest_of_buckets(buckets: DataFrame, signed: DataFrame, labels: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket that the stars left in different components."""
    placed = _labelled(buckets, labels, "node", "label")
    shares = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    # The members of a bucket's largest component needn't meet each other.
    open_ = shares.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"), F.sum("words").alias("words"))
    # With two members the star has tested their only pair.
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("words") * 4 / BLOCK_BYTES, F.lit(1.0)))
    open_ = compacted(open_.filter("parts > 1 AND size > 2").select("key", F.col("top.label").alias("top"), blocks.alias("blocks")))
    rows = compacted(placed.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")))
    wide = rows.join(_picked(signed, rows, "signature", "words").hint("merge"), "node")
    member = F.struct("node", "label", (F.col("label") != F.col("top")).alias("minor"), "signature", "words")
    blocks = checkpointed(wide.groupBy("key", "band", "block").agg(F.collect_list(member).alias("members")))
    minors = blocks.select("key", F.filter("members", lambda m: m["minor"]).alias("minors")).filter(F.size("minors") > 0)
    return minors.join(blocks.hint("merge"), "key").select("band", "minors", "members").mapInArrow(_compare, "a bigint, b bigint")


def _pair(node: str, centre: str) -> list[Column]:
    return [F.least(node, centre).alias("a"), F.greatest(node, centre).alias("b")]


def _draw(node: str) -> Column:
    return F.xxhash64(node)


def star_links(buckets: DataFrame, signed: DataFrame) -> DataFrame:
    """Links (a, b) of members with centres. buckets: key, node, centre.

    A group of members that are alike has about one link a member, in however many
    buckets its members meet. The first links, each to an earlier draw, are a forest;
    a few steps up in it tell most pairs that are joined already.
    """
    first = buckets.groupBy("node").agg(F.min_by("centre", _draw("centre")).alias("centre")).filter("node <> centre")
    first = compacted(first)
    pairs = first.select(*_pair("node", "centre"), (F.col("node") < F.col("centre")).alias("up"))
    links = compacted(verified(pairs.drop("up"), signed))
    above = links.join(pairs, ["a", "b"]).select(F.when(F.col("up"), F.col("a")).otherwise(F.col("b")).alias("node"), F.when(F.col("up"), F.col("b")).otherwise(F.col("a")).alias("label"))
    for _ in range(2):
        above = above.select("node", F.col("label").alias("over")).transform(lambda df, up=above: _labelled(df, up, "over", "label")).select("node", "label")
    above = checkpointed(above)
    apart = _labelled(_labelled(buckets.filter("node <> centre").select("node", "centre").distinct(), above, "node", "of"), above, "centre", "to")
    others = apart.filter("of <> to").select(*_pair("node", "centre")).distinct()
    others = compacted(others.join(pairs, ["a", "b"], "left_anti"))
    return links if others.isEmpty() else compacted(links.unionByName(verified(others, signed)))


def near_classes(docs: DataFrame, with_content: bool = False) -> DataFrame:
    """doc_id, class_id (least id of the class), class_size and on request content of each row."""
    signed = written(sign(docs))
    copies = checkpointed(signed.groupBy("content").agg(F.min("row").alias("node")))
    unique = signed.select("row", "n_words", "bands").join(copies.select(F.col("node").alias("row")), "row", "left_semi")
    spread = unique.select(F.posexplode("bands").alias("band", "key"), F.col("row").alias("node"), "n_words")
    centres = spread.groupBy("key").agg(F.min_by("node", _draw("node")).alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = checkpointed(spread.join(centres.filter("n > 1").select("key", "centre"), "key"))
    links = star_links(buckets, signed)
    labels = components(links)
    more = compacted(_rest_of_buckets(buckets.select("key", "band", "node", "n_words"), signed, labels))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    shown = ["content"] if with_content else []
    rows = signed.select("doc_id", "content").join(copies, "content").select("doc_id", "node", *shown)
    rows = rows.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("label"), *shown)
    rows = checkpointed(rows)
    # Written apart, so that the join deals both sides anew and can split a hot class.
    classes = checkpointed(rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return rows.join(classes, "label").select("doc_id", "class_id", "class_size", *shown)
