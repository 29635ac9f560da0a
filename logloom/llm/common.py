"""What the operators share: table access, checkpoints, hashed keys."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.sources.tables import read_table

#: ASCII white space that is stripped from line ends (fixed values).
ASCII_BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, *columns)


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with further underscores where df has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; one of our own only where it
    is unset in local mode (tests). Elsewhere a local folder would not be shared."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def compacted(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Checkpoint, and in one partition for every so many rows: later shuffles of a
    small table then leave few files, whatever the number of shuffle partitions."""
    out = checkpointed(df)
    return out.coalesce(-(-out.count() // rows) or 1)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage through a Parquet table in the shared folder, for wide
    tables of which later steps read some columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows out of a stream of tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
