"""Failure-rate schedules, tool cycles and resampling of baseline rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from toolpulse import schemas as S
from toolpulse.operators.ranking import ROWS_PER_RANGE, in_ranges


def expected_and_observed(readings: DataFrame, n_readings: Column) -> DataFrame:
    """Planned and observed failure share by mode and tenth of the run."""
    tenth = F.least(F.lit(9), F.floor((F.col("reading_number") - 1) * 10 / n_readings))
    return readings.groupBy("mode", tenth.cast("int").alias("tenth")).agg(
        F.count("*").alias("readings"),
        F.round(F.avg("effective_failure_rate"), 6).alias("expected_rate"),
        F.round(F.avg("injected_failure"), 6).alias("observed_rate"),
    )


def tool_cycles(readings: DataFrame, order: str = "id", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per machine and tool: readings, highest wear and failures.

    A tool is replaced where wear falls. The log is cut into ranges of the
    order column, so a machine with most of the log is spread over tasks;
    what a range has to know of the earlier ones is their last wear and their
    number of replacements, one small row per machine and range.
    """
    wear = F.col("tool_wear_minutes")
    needed = readings.select("machine_id", order, "tool_wear_minutes", "injected_failure")

    inside = Window.partitionBy("machine_id", "__range").orderBy(order)
    rows = in_ranges(needed, order, rows_per_range=rows_per_range)
    rows = rows.withColumn("__reset", F.coalesce((wear < F.lag(wear).over(inside)).cast("int"), F.lit(0)))
    rows = rows.withColumn(
        "__local", F.sum("__reset").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    pieces = rows.groupBy("machine_id", "__range", "__local").agg(
        F.count("*").alias("readings"),
        F.max("tool_wear_minutes").alias("max_wear"),
        F.sum("injected_failure").alias("failures"),
        F.min_by("tool_wear_minutes", order).alias("__first"),
        F.max_by("tool_wear_minutes", order).alias("__last"),
    )
    spans = pieces.groupBy("machine_id", "__range").agg(
        F.max("__local").alias("__resets"),
        F.min_by("__first", "__local").alias("__first"),
        F.max_by("__last", "__local").alias("__last"),
    )
    by_range = Window.partitionBy("machine_id").orderBy("__range")
    spans = spans.withColumn("__broken", F.coalesce((F.col("__first") < F.lag("__last").over(by_range)).cast("int"), F.lit(0)))
    # Replacements before a range, counting one at its own start.
    earlier = F.coalesce(F.sum("__resets").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.sum("__broken").over(by_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = spans.select("machine_id", "__range", (earlier + starts).alias("__before"))
    return (
        pieces.join(spans, ["machine_id", "__range"])
        .groupBy("machine_id", (F.col("__local") + F.col("__before")).alias("cycle"))
        .agg(
            F.sum("readings").alias("readings"),
            F.max("max_wear").alias("max_wear"),
            F.sum("failures").alias("failures"),
        )
    )


def wear_now(readings_per_machine: DataFrame) -> DataFrame:
    """Wear and tools used from the number of readings per machine (``readings``).

    Every reading adds a fixed step, and the tool is new again at the limit, so
    the count alone gives the state; no order within a machine is needed.
    """
    per_tool = S.TOOL_WEAR_RESET // S.TOOL_WEAR_STEP
    n = F.col("readings")
    return readings_per_machine.select(
        "machine_id",
        "readings",
        ((n % per_tool) * S.TOOL_WEAR_STEP).alias("wear"),
        F.floor(n / per_tool).alias("tools_replaced"),
    )


def draw_index(key: Column, population: Column, seed: int = S.SPLIT_SEED) -> Column:
    """A repeatable index 1..population from a key."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % population + 1


def resample(draws: DataFrame, key: str, baseline: DataFrame, columns: list[str]) -> DataFrame:
    """Whole baseline rows drawn with replacement, one per row of ``draws``.

    ``baseline`` is numbered 1..n by ``udi``. Rows are drawn whole, so the
    correlations between sensors stay. An equi-join on the drawn number.
    """
    population = baseline.agg(F.max("udi")).scalar()
    drawn = draws.select(F.col(key), draw_index(F.col(key), population).alias("udi"))
    return drawn.join(baseline.select("udi", *columns), "udi").select(key, "udi", *columns)
