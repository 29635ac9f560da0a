"""Exact dedup by content-defined chunk recipes.

A text is cut where its own content says so (a line or sentence end after a
least length), chunks are reduced to verified identifiers, and documents are
compared by their ordered identifier lists. Past the scan only identifiers and
digests move, never texts.

Null text is empty. Each row is a document; rows that repeat an id are each
returned and share keep_id. One row of each group is kept: of rows that repeat the
kept id, any one. Null ids come before all others. Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed, lower_ascii, written


def chunks_of(text: Column, least: int = 256, most: int = 2048) -> Column:
    """Array of chunks that together are the text; empty text has one empty chunk.

    A chunk ends after the first line or sentence end past `least` characters,
    at `most` characters where there is none, and at the text's end.
    """
    pattern = rf"(?s).{{{least},{most - 1}}}?[\n.]|.{{1,{most}}}"
    return F.when(text == "", F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def verified_ids(chunks: DataFrame) -> DataFrame:
    """_h, _sha, _rank of chunks whose 64-bit hash stands for several contents.

    The pair (hash, rank) identifies a chunk; any other chunk has rank 0. Digests are
    gathered only for hashes that stand for more than one.
    """
    distinct = chunks.select("_h", "_sha").distinct()
    several = distinct.groupBy("_h").agg(F.sort_array(F.collect_list("_sha")).alias("_all")).filter(F.size("_all") > 1)
    return several.select("_h", F.posexplode("_all").alias("_rank", "_sha"))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (a number), doc_id, text_sha256 and recipe (ordered chunk identifiers) of each row."""
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), text.alias("_text"))
    chunks = rows.select(
        "_row", "_id", F.sha2("_text", 256).alias("_digest"), F.posexplode(chunks_of(F.col("_text"))).alias("_pos", "_chunk")
    ).select(
        "_row",
        "_pos",
        # What the row has once goes with its first chunk alone.
        F.when(F.col("_pos") == 0, F.struct("_id", "_digest")).alias("_own"),
        F.xxhash64("_chunk").alias("_h"),
        F.unhex(F.sha2("_chunk", 256)).alias("_sha"),
    )
    chunks = written(chunks)  # read for the identifiers and for the recipes
    known = chunks.join(verified_ids(chunks), ["_h", "_sha"], "left")
    one = F.struct(F.col("_pos"), F.col("_h"), F.coalesce("_rank", F.lit(0)).alias("_rank"))
    gathered = known.groupBy("_row").agg(F.max("_own").alias("_own"), F.sort_array(F.collect_list(one)).alias("_list"))
    return gathered.select(
        F.col("_row").alias("row"),
        F.col("_own._id").alias("doc_id"),
        F.col("_own._digest").alias("text_sha256"),
        F.transform("_list", lambda x: F.struct(x["_h"].alias("h"), x["_rank"].alias("rank"))).alias("recipe"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each row.

    Texts are equal when identical after lower-casing A-Z; the largest id stays.
    """
    listed = checkpointed(recipes(docs, id_col, text_col))
    # Partial aggregation leaves one row per recipe and task, however hot the recipe.
    groups = listed.groupBy("recipe").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
    # Written apart, so that the join deals both sides anew and can split a hot recipe.
    groups = checkpointed(groups)
    return listed.join(groups, "recipe").select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256"
    )
