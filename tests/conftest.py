import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("toolpulse-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# How many rows of each derived label the small training table has.
LABEL_ROWS = {"none": 34, "hdf": 12, "pwf": 12, "osf": 9, "twf": 8}


@pytest.fixture(scope="session")
def training(spark):
    """The first rows of each failure label among generated sensor rows, numbered from 1."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from toolpulse import schemas as S
    from toolpulse.functions.labels import failure_label
    from toolpulse.plans import adapters

    rows = adapters._with_failures(spark.range(40_000).selectExpr("id AS k", *adapters.sensors("id")))
    place = F.row_number().over(Window.partitionBy("label").orderBy("k"))
    wanted = F.create_map(*[F.lit(v) for pair in LABEL_ROWS.items() for v in pair])[F.col("label")]
    chosen = rows.withColumn("label", failure_label()).withColumn("place", place).where(F.col("place") <= wanted)
    numbered = chosen.withColumn("udi", F.row_number().over(Window.orderBy("k")).cast("long"))
    named = numbered.withColumn("product_id", F.concat("type", F.col("udi").cast("string")))
    kinds = [F.col(f.name).cast(f.dataType) for f in S.TRAINING_SCHEMA]
    return spark.createDataFrame(named.select(*kinds).collect(), S.TRAINING_SCHEMA).cache()


@pytest.fixture(scope="session")
def readings(spark):
    """Two hundred readings of three machines; one machine sends most of them."""
    from toolpulse.plans.adapters import readings_from_events
    from pyspark.sql import functions as F

    events = spark.range(200).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"),
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 3).alias("user_id"),
        F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type"),
    )
    return readings_from_events(events, F.lit(200)).cache()
