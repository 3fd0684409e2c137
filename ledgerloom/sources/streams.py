"""Event files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_event_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None, time: str = "ts"
) -> DataFrame:
    """New Parquet files of a folder as an unbounded table.

    Watermarks need a timestamp with zone, so the event time is cast. ``max_files`` bounds
    a micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    events = reader.parquet(path)
    return events.withColumn(time, F.col(time).cast("timestamp")) if time in events.columns else events
