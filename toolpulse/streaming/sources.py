"""Streaming reads of the readings log."""

from pyspark.sql import DataFrame, SparkSession

from toolpulse import schemas as S


def readings_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.READINGS_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def trigger(seconds: int | None) -> dict:
    """Every so many seconds, or with None: everything there now, then stop."""
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
