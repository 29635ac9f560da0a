"""The shared folder for what a job leaves behind on its way."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
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
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
