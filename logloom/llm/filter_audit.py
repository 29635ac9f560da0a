"""Filter interaction audit by the potential of removal games.

A part's game: the worth of a coalition of filters is the number of documents
that at least one of them fails. The Hart-Mas-Colell potential follows from it by
recursion over the 32 coalitions, smaller ones first,

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,   P(empty) = 0,

a filter's Shapley value is P(all) - P(all without it), and what a filter removes
at any place of any order is a difference of two coalitions.

A document is reduced to a mask of the filters that it fails; the texts are read
once and never shuffled. Exact copies are found by digest: the join that marks a
digest's first document has the id in its key too, so a digest that holds a third of
all rows is dealt out like any other. A part ends as at most 32 counted masks.

Null text is empty and a null part is the empty string. A null id is smaller than
none and has none that is smaller, so it fails no E, and it has no labels; rows that
repeat an id and a text are not each other's copies. An id with several labels is good
or toxic if any of them says so. An empty table has no parts. Other columns of both
tables are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import UPPER, text_of, written

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
#: Orders in which the filters may be applied: 120.
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BLANKS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"


def bit(name: str) -> int:
    return 1 << FILTERS.index(name)


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, BLANKS, -1), "")

    def of(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
        fails = {"A": n < 200, "B": 100 * distinct.cast("long") < 50 * n.cast("long"), "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"), "D": text.rlike(MARKS)}
        return sum((F.when(c, bit(k)).otherwise(0) for k, c in fails.items()), F.lit(0))

    # In a lambda the words are split once for all that is asked of them.
    return F.transform(F.array(words), of)[0]


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """doc_id, part and mask (of the filters that it fails) of each row."""
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        text_failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = written(rows)  # two readers, and the texts are read for neither
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    own = rows.withColumnRenamed("digest", "_digest")
    out = own.join(first, (own["_digest"] == first["digest"]) & (own["doc_id"] == first["first"]), "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return out.select("doc_id", "part", (F.col("mask") + F.when(copy, bit("E")).otherwise(0)).alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add good and toxic: false where the id has no such label."""
    yes = lambda c: F.coalesce(F.bool_or(F.col(c) == 1), F.lit(False)).alias(f"_{c}")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(yes("quality"), yes("toxic"))
    named, nameless = rows.filter("doc_id IS NOT NULL"), rows.filter("doc_id IS NULL")
    said = named.join(known, named["doc_id"] == known["_id"], "left")
    said = said.select(*rows.columns, *(F.coalesce(c, F.lit(False)).alias(n) for c, n in (("_quality", "good"), ("_toxic", "toxic"))))
    return said.unionByName(nameless.withColumns({"good": F.lit(False), "toxic": F.lit(False)}))


def coalitions(rows: DataFrame) -> DataFrame:
    """part, and for each coalition (a mask) what passes all of its filters: kept, good, toxic."""
    counted = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("kept"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    held = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "kept", "good", "toxic")).alias("_held"))  # 32 at most
    zero = F.lit(0).cast("long")

    def passing(name: str) -> Column:
        inside = lambda s: F.filter("_held", lambda x: x["mask"].bitwiseAND(s) == 0)
        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.aggregate(inside(s), zero, lambda a, x: a + x[name])).alias(name)

    return held.select("part", passing("kept"), passing("good"), passing("toxic"))


def potentials(kept: Column) -> Column:
    """120 P(S) for each coalition S of the removal game, which are whole numbers."""

    def step(found: Column, s: Column) -> Column:
        worth = (kept[0] - F.get(kept, s)) * len(ORDERS)
        without = [F.when(s.bitwiseAND(bit(f)) != 0, F.get(found, s.bitwiseXOR(F.lit(bit(f))))).otherwise(0) for f in FILTERS]
        return F.array_append(found, F.call_function("div", worth + sum(without, F.lit(0)), F.bit_count(s)))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), step)


def audit(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley, which is the filter's removals summed over all orders."""
    games = coalitions(labelled(rows, labels)).withColumn("potential", potentials(F.col("kept")))
    orders = games.select("*", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = orders.select("*", F.posexplode(F.split("filter_order", "")).alias("_at", "_name"))
    bits = F.create_map(*(F.lit(x) for f in FILTERS for x in (f, bit(f))))
    before = F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("_at")), F.lit(0), lambda a, n: a + F.element_at(bits, n))
    steps = steps.select("*", F.element_at(bits, F.col("_name")).alias("_own"), before.alias("_before"))
    at = lambda c, mask: F.get(c, mask)
    after = F.col("_before") + F.col("_own")
    lost = lambda c: at(c, F.col("_before")) - at(c, after)
    rest = F.lit(ALL) - F.col("_own")
    return steps.select(
        "part",
        "filter_order",
        (F.col("_at") + 1).alias("step"),
        at("kept", after).alias("kept"),
        lost("kept").alias("removed"),
        (F.col("kept")[0] - at("kept", F.col("_own")) - lost("kept")).alias("redundant"),
        (at("kept", rest) - F.col("kept")[ALL]).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        (F.col("potential")[ALL] - at("potential", rest)).alias("shapley"),
    )
