"""Value counts per day and feature, kept up to date batch by batch.

All drift statistics work on counts per distinct value, and counts add up. So
a window of any days, the daily trend and the full report come from these
counts; the log is not read again. A batch's counts are the folder of its
number: taking a batch in twice changes nothing.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators import drift as D
from toolpulse.sources.readers import complete_rows

SCHEMA = "day date, feature string, category string, value double, n long"


@dataclass
class DailyCounts:
    spark: SparkSession
    path: str

    def add(self, readings: DataFrame, batch: int) -> None:
        """Take in complete readings; counts combine on the map side, whatever the machine or the value."""
        rows = readings.select(F.to_date("timestamp").alias("day"), F.col("machine_type").alias("type"), *S.NUMERIC_FEATURES)
        long = D.unpivot_features(complete_rows(rows, S.FEATURES), "day")
        counts = D.name_features(long.groupBy("day", "f", "category", "value").agg(F.count("*").alias("n")))
        counts.select("day", "feature", "category", "value", "n").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def rows(self) -> DataFrame:
        """day, feature, category, value, n of all batches together."""
        parts = self.spark.read.schema(SCHEMA + ", batch long").parquet(self.path)
        return parts.groupBy("day", "feature", "category", "value").agg(F.sum("n").alias("n"))

    def value_counts(self, baseline: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
        """Kept baseline counts beside those of the days ``first`` to ``last``, both included."""
        days = self.rows()
        if first is not None:
            days = days.where(F.col("day") >= F.lit(first).cast("date"))
        if last is not None:
            days = days.where(F.col("day") <= F.lit(last).cast("date"))
        none = F.lit(0).cast("long")
        keys = ["feature", "category", "value"]
        own = days.select(*keys, none.alias("n_ref"), F.col("n").alias("n_cur"))
        held = baseline.select(*keys, "n_ref", none.alias("n_cur"))
        return own.unionByName(held).groupBy(*keys).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))

    def report(self, baseline: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
        """Test, value and verdict per feature over a window of days."""
        return D.feature_drift(D.feature_statistics(D.materialise(self.value_counts(baseline, first, last), "value-counts")))

    def trend(self, reference: DataFrame, days: int = 1, bins: int = 10) -> DataFrame:
        """Binned distance per numeric feature over the ``days`` up to every day that has readings."""
        ranges = D.feature_ranges(reference)  # one row per feature
        number = D.bin_number(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin")
        each = self.rows().join(F.broadcast(ranges), "feature").groupBy("day", "feature", number).agg(F.sum("n").alias("n"))
        if days > 1:  # a few bins per day and feature, each part of as many windows as a window has days
            ends = each.select(F.col("day").alias("end")).distinct()
            spread = each.withColumn("end", F.explode(F.sequence("day", F.date_add("day", days - 1))))
            each = spread.join(ends, "end").groupBy(F.col("end").alias("day"), "feature", "bin").agg(F.sum("n").alias("n"))
        return D.binned_distances(D.binned_rows(reference, ranges, bins, "n"), each, "day", bins)
