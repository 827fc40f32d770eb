"""Scans with explicit schemas. Column pruning and filter pushdown are left to Spark."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features, to_clean_names
from toolpulse.operators.ranking import newest_rows


def training_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet training table in raw layout, with clean names."""
    return to_clean_names(spark.read.schema(S.RAW_TRAINING_SCHEMA).parquet(path))


def training_udis(spark: SparkSession, path: str) -> DataFrame:
    """Just the ids: the file scan reads one column."""
    return training_table(spark, path).select("udi")


def baseline_csv(spark: SparkSession, path: str) -> DataFrame:
    """The frozen reference file, raw layout, with header."""
    return to_clean_names(spark.read.schema(S.RAW_TRAINING_SCHEMA).option("header", True).csv(path))


def baseline_csv_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return baseline_csv(spark, path).select(*columns)


def reference_features(baseline: DataFrame) -> DataFrame:
    """Feature columns of the reference, rows with any null left out."""
    return engineer_features(complete_rows(to_clean_names(baseline), S.MEASURED)).select(*S.FEATURES)


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a null in ``columns``; one test per column, so the file scan can use them."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def readings_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.READINGS_SCHEMA).parquet(path)


def since_filter(since: str | None) -> Column:
    """Strictly later than ``since``, compared as timestamps."""
    if since is None:
        return F.lit(True)
    return F.col("timestamp") > F.lit(since).cast("timestamp")


def readings_since(readings: DataFrame, since: str | None = None) -> DataFrame:
    return readings.where(since_filter(since))


def current_features(readings: DataFrame) -> DataFrame:
    """The nine stored features, with the machine type under its training name."""
    return readings.select(F.col("machine_type").alias("type"), *S.NUMERIC_FEATURES)


def current_sample(
    readings: DataFrame, since: str | None = None, limit: int | None = S.CURRENT_ROW_LIMIT
) -> DataFrame:
    """Newest ``limit`` readings after ``since``; null rows are dropped after the limit.

    ``limit=None`` compares everything, which the drift statistics can do at
    any size.
    """
    rows = readings_since(readings, since)
    if limit is not None:
        rows = newest_rows(rows, limit, "timestamp", "id")
    return complete_rows(current_features(rows), S.FEATURES)


def parse_requests(requests: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """JSON requests to ``(readings, rejected)``.

    A request is ``{"readings": [...]}``. Readings keep their place in the list
    as ``position``. Requests without at least one reading are rejected.
    """
    body = T.StructType([T.StructField("readings", T.ArrayType(S.REQUEST_READING))])
    parsed = requests.withColumn("readings", F.from_json(payload, body)["readings"])
    filled = F.coalesce(F.size("readings"), F.lit(0)) > 0
    keep = [c for c in requests.columns if c != payload]
    readings = parsed.where(filled).select(*keep, F.posexplode("readings").alias("position", "reading"))
    return readings.select(*keep, "position", "reading.*"), parsed.where(~filled).select(*keep)


def training_window(training: DataFrame, rows: int | None = S.TRAINING_WINDOW) -> DataFrame:
    """The last ``rows`` of the training table by id; ``None`` takes all of it."""
    return training if rows is None else newest_rows(training, rows, "udi")
