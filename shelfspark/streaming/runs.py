"""Bounded runs over a stream (ST2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, folder: str, glob: str, schema: StructType, max_files: int = 1000) -> DataFrame:
    """Parquet files of a folder as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all rows available now to Parquet files, then stop."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(path))
    query.awaitTermination()


def drain_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Hand every micro-batch available now to ``write(batch, batch_id)``, then stop."""
    query = (stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
