"""Append-only sinks, logs and triggers."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse import schemas as S
from toolpulse.functions.text import iso_utc, metrics_report

TRIGGER_SCHEMA = T.StructType([T.StructField("line", T.StringType(), False)])


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one data file."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(jpath))


def checked_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; a null where none is allowed fails the job."""
    columns = []
    for field in schema:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            problem = F.raise_error(F.lit(f"null in required column {field.name}")).cast(field.dataType)
            value = F.when(value.isNotNull(), value).otherwise(problem)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def create_readings_log(spark: SparkSession, path: str) -> None:
    """An empty log with the fixed schema, unless one is there."""
    if not table_exists(spark, path):
        spark.createDataFrame([], S.READINGS_SCHEMA).write.mode("append").parquet(path)


def append_readings(readings: DataFrame, path: str) -> None:
    checked_not_null(readings, S.READINGS_SCHEMA).write.mode("append").parquet(path)


def clear_readings(spark: SparkSession, path: str) -> None:
    """Remove all rows; the table keeps its schema."""
    spark.createDataFrame([], S.READINGS_SCHEMA).write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Adds files; the rows already there are not read."""
    df.write.mode("append").parquet(path)


def append_check_log(spark: SparkSession, path: str, drift_detected: bool, retrain_triggered: bool) -> None:
    entry = spark.range(1).select(
        iso_utc(F.current_timestamp()).alias("timestamp"),
        F.lit(drift_detected).alias("drift_detected"),
        F.lit(retrain_triggered).alias("retrain_triggered"),
    )
    entry.write.mode("append").json(path)


def read_check_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CHECK_LOG_SCHEMA).json(path)


def trigger_line(ts: Column) -> Column:
    return F.concat(F.lit("drift detected: "), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def append_retrain_trigger(spark: SparkSession, path: str) -> None:
    spark.range(1).select(trigger_line(F.current_timestamp()).alias("line")).write.mode("append").text(path)


def write_metrics_report(metrics: DataFrame, path: str) -> None:
    """The report as one small text file, lines in order."""
    metrics_report(metrics).orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)
