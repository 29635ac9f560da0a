"""Line dedup: repeated lines are kept only in the last document that holds them.

Lines are exploded, normalised and hashed (128 bits) once, into a written table;
only hashes and positions are shuffled for the counts. The texts move once, as
arrays of lines, to meet the positions that their document loses.

Null text is an empty document of one empty line. Rows with the same id are one
document for the counts (a null id is a document of its own, before all others)
and each of them is returned. Extra columns are kept, whatever their names; the
result's own columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import ASCII_BLANKS, checkpointed, lower_ascii, unused, written

#: Added to every row.
RESULT = ("kept_text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(ASCII_BLANKS)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Add kept_text, n_lines (before dropping) and n_dropped to each row of docs.

    Keys of at least min_chars code points that occur in at least min_docs
    documents lose all their lines except in the largest id that holds them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A document is its id; its text's hash tells apart rows that repeat an id.
    own = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_t"), text.alias("_text"))
    lines = (
        own.select("_id", "_t", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
        .withColumn("_key", line_key(F.col("_line")))
        .filter(F.length("_key") >= min_chars)
        .select("_id", "_t", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    lines = written(lines)  # read by the counts and by the join
    repeated = (
        lines.select("_h1", "_h2", "_id")
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_keep"))
        .filter(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", "_keep")
    )
    # Written apart, so that the join deals both sides anew: a hot key then skews the left
    # side only, which adaptive execution splits.
    repeated = checkpointed(repeated)
    rest = [c for c in docs.columns if c not in RESULT]
    t, all_lines, lost_id, lost_t, gone = unused(docs, "_t", "_lines", "_lost_id", "_lost_t", "_lost")
    lost = (
        lines.join(repeated, ["_h1", "_h2"])
        .filter(~F.col("_id").eqNullSafe(F.col("_keep")))
        .groupBy(F.col("_id").alias(lost_id), F.col("_t").alias(lost_t))
        .agg(F.collect_set("_pos").alias(gone))
    )
    # The split stands below the join: above it, the array is a plain column to look lines up in.
    whole = docs.select(*(F.col(f"`{c}`") for c in rest), F.xxhash64(text).alias(t), F.split(text, "\n", -1).alias(all_lines))
    joined = whole.join(lost, whole[id_col].eqNullSafe(F.col(lost_id)) & (whole[t] == F.col(lost_t)), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(gone))
    kept = F.when(F.col(gone).isNull(), F.col(all_lines)).otherwise(F.transform(stay, lambda i: F.get(all_lines, i)))
    return joined.select(
        *(F.col(f"`{c}`") for c in rest),
        F.array_join(kept, "\n").alias("kept_text"),
        F.size(all_lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )
