"""Helpers shared by the training-data operators: words, lineage cuts, folders and joins on keys that may be hot."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters outside U+0020 and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
#: Tables of at most so many short rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only a local master may go without: it gets a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder in whatever store it lies; one that is not there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoints to the shared folder: what follows survives the loss of any executor and does not compute df again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most so many rows, else as it is; df should be cut, as it is counted."""
    return F.broadcast(df) if df.count() <= rows else df


def words(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def dealt_anew(key: Column) -> Column:
    """The same bigint as a computed expression.

    A table that was aggregated by key is already dealt out by it, so a join would shuffle only the other side and
    adaptive execution could not split a hot key. Joining on the computed key shuffles both sides, and it can.
    """
    return key.bitwiseXOR(F.lit(0).cast("long"))


def dealt_anew_text(key: Column) -> Column:
    """dealt_anew for strings."""
    return F.concat(key, F.lit(""))
