"""Counts by day and batch against the operators that read the log."""

import pytest
from pyspark.sql import functions as F

from toolpulse.operators import drift
from toolpulse.operators.daily_counts import DailyCounts
from toolpulse.sources.readers import current_sample, reference_features


@pytest.fixture
def days(readings):
    """The two hundred readings over ten days, one without a complete row."""
    day = F.floor((F.col("id") - 1) / 20).cast("int")
    spread = readings.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(day))
    return spread.withColumn("torque_nm", F.when(F.col("id") != 77, F.col("torque_nm"))).cache()


@pytest.fixture
def counts(spark, days, tmp_path):
    found = DailyCounts(spark, f"{tmp_path}/counts")
    for batch in range(4):
        part = days.where(F.col("id") % 4 == batch)
        found.add(part, batch)
    found.add(days.where(F.col("id") % 4 == 2), 2)  # a batch once more
    return found


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_batches_add_up(counts, days):
    per_day = counts.rows().where("feature = 'type'").groupBy("day").agg(F.sum("n")).collect()
    wanted = days.where("torque_nm IS NOT NULL").groupBy(F.to_date("timestamp")).count().collect()
    assert sorted(map(tuple, per_day)) == sorted(map(tuple, wanted)) and len(per_day) == 10


def test_report_of_a_window_equals_that_of_its_readings(counts, days, training):
    reference = reference_features(training)
    baseline = drift.baseline_counts(reference)
    for first, last in ((None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None)):
        inside = F.to_date("timestamp").between(first or "2000-01-01", last or "2100-01-01")
        wanted = drift.drift_features(reference, current_sample(days.where(inside), limit=None))
        assert rows(counts.report(baseline, first, last).drop("big_r", "big_c")) == rows(wanted.drop("big_r", "big_c"))


def test_trend_by_day_and_by_week(counts, days, training):
    reference = reference_features(training)
    kept = days.where("torque_nm IS NOT NULL")
    by_day = drift.drift_trend(reference, kept).select(F.to_date("window_start"), "feature", "row_count", "distance", "drifted")
    assert rows(counts.trend(reference)) == rows(by_day)
    week = counts.trend(reference, days=7).where("day = '2024-01-08'")
    inside = kept.where(F.to_date("timestamp").between("2024-01-02", "2024-01-08"))
    whole = drift.drift_trend(reference, inside.withColumn("timestamp", F.lit("2024-01-08").cast("timestamp")))
    assert rows(week) == rows(whole.select(F.to_date("window_start"), "feature", "row_count", "distance", "drifted"))
    assert counts.trend(reference, days=7).select("day").distinct().count() == 10
