"""New cell files as a stream: an extension for runs that only process what has arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def new_cells(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def process_new(cells: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Applies transform to the files that came since the last call and returns the ended query.

    Each batch has a folder of its own under out, batch=<id>, which a repeated batch overwrites.
    """
    query = cells.writeStream.foreachBatch(lambda batch, k: transform(batch).write.mode("overwrite").parquet(f"{out}/batch={k}")).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
