"""Recurring drift checks and machine state on the arriving readings."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from toolpulse import schemas as S
from toolpulse.operators.daily_counts import DailyCounts
from toolpulse.operators.drift import baseline_counts
from toolpulse.operators.lifecycle import wear_now
from toolpulse.plans.jobs import CheckResult, Workspace, check_drift
from toolpulse.sources import writers
from toolpulse.sources.durable import materialise
from toolpulse.streaming.sources import trigger


def watch_drift(
    readings: DataFrame,
    space: Workspace,
    reference: DataFrame,
    checkpoint: str,
    every: int | None = 30,
    limit: int | None = S.CURRENT_ROW_LIMIT,
    purge: bool = True,
    report: Callable[[int, CheckResult], None] | None = None,
    counts: DailyCounts | None = None,
) -> StreamingQuery:
    """Add each batch to the readings log, then check the newest readings of the log.

    The check reads the log, not the batch, so "newest" spans batches. A batch
    has its own folder in the log, and an export skips readings it has taken
    before, so a repeated batch changes nothing. The frozen reference is counted
    once, when the stream starts. ``counts`` takes in every batch as well.
    """
    baseline = materialise(baseline_counts(reference), "baseline-counts")

    def process(batch: DataFrame, batch_id: int) -> None:
        arrived = writers.checked_not_null(batch, S.READINGS_SCHEMA)
        arrived.write.mode("overwrite").parquet(f"{space.readings.path}/batch={batch_id}")
        if counts is not None:
            counts.add(arrived, batch_id)
        result = check_drift(space, reference, limit=limit, purge=purge, baseline=baseline)
        if report is not None:
            report(batch_id, result)

    writer = readings.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(every)).start()


def track_wear(readings: DataFrame, table: str, checkpoint: str, every: int | None = None) -> StreamingQuery:
    """Keep a table of wear and tools used per machine.

    The state is one count per machine. Counts combine before the shuffle, so
    a machine that sends most readings does not load one task.
    """
    counts = readings.groupBy("machine_id").agg(F.count("*").alias("readings"))

    def replace(state: DataFrame, batch_id: int) -> None:
        wear_now(state).write.mode("overwrite").parquet(table)

    writer = counts.writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(every)).start()


def deduplicated(readings: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a reading that arrive within ``delay`` of it."""
    return readings.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["id"])
