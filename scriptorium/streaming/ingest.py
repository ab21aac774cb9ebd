"""Incremental ingest: new JSON-lines files become rows of a table, each file once."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def json_lines(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str) -> StreamingQuery:
    """Append what has come since the last call to a Parquet table, then stop."""
    rows = spark.readStream.schema(schema).json(folder)
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
