"""Ends the lineage of iterative operators in the cluster's shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df, checkpointed in spark.checkpoint.dir; only a local master may go without the setting and gets a temporary folder."""
    session = df.sparkSession
    context = session.sparkContext
    if not context.getCheckpointDir():
        folder = session.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint()
