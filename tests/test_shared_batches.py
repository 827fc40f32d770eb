"""The steps below the daily trend: batches shared by all cores, the reference without row numbers, bins counted by place."""

from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators import drift as D
from toolpulse.plans import adapters
from toolpulse.plans.catalogue.drift import reference
from toolpulse.sources import durable
from toolpulse.sources.readers import reference_features

SF = "/root/testdata/sf0.001"


def test_one_large_file_of_the_log_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    events = spark.range(400_000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"),
        (F.col("id") % 1500).alias("user_id"),
        F.when(F.col("id") % 5 == 0, "error").otherwise("view").alias("event_type"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(adapters, "file_count", lambda spark, rows: 1)
    log = adapters.readings(spark, str(tmp_path))
    assert len(log.inputFiles()) == 1
    tasks = log.select("id").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 400_000


def test_reference_is_that_of_the_training_table_without_writing_it(spark):
    sf = f"{SF}/."  # a name of its own, which no other query has prepared
    found = reference(spark, sf)
    assert (spark.sparkContext.applicationId, f"training:{sf}") not in durable._shared
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    wanted = reference_features(adapters.training(spark, SF))
    assert found.dtypes == wanted.dtypes and found.count() == wanted.count()
    assert found.exceptAll(wanted).count() == 0


def test_bins_are_counted_by_place(spark, training):
    baseline = reference_features(training)
    ranges = D.feature_ranges(baseline)
    odd = baseline.withColumn("torque_nm", F.when(F.col("torque_nm") < 40, F.col("torque_nm") * 100))  # nulls and values above
    found = D.binned_rows(odd, ranges, 10, "n")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [f#" in plan and "(f#" in plan.split("Join ")[1].splitlines()[0]
    limits = {r["feature"]: (r["low"], r["high"]) for r in ranges.collect()}
    wanted = {}
    for row in odd.collect():
        for name in S.NUMERIC_FEATURES:
            value, (low, high) = row[name], limits[name]
            if value is not None:
                inside = min(10, int((value - low) * 10 / (high - low)) + 1)
                key = name, 0 if value < low else 11 if value > high else inside
                wanted[key] = wanted.get(key, 0) + 1
    assert {(r["feature"], r["bin"]): r["n"] for r in found.collect()} == wanted
