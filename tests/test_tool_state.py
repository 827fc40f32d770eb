"""Tool cycles on a stream against the batch operator on the same readings."""

import pytest
from pyspark.sql import functions as F

from toolpulse.operators.lifecycle import tool_cycles
from toolpulse.sources import writers
from toolpulse.streaming import tool_state
from toolpulse.streaming.sources import readings_stream


def rows_of(df):
    return sorted(tuple(r) for r in df.select("machine_id", "cycle", "readings", "max_wear", "failures").collect())


def run(spark, root, delay):
    arriving = readings_stream(spark, f"{root}/log", 1)
    tool_state.track_tools(arriving, f"{root}/cycles", f"{root}/checkpoint", delay).awaitTermination()
    return tool_state.tracked_tools(spark, f"{root}/cycles")


@pytest.fixture
def log(readings):
    """Minutes apart; wear by hash, so tools change often."""
    wear = (F.pmod(F.xxhash64("id"), F.lit(50)) + F.col("id") % 40).cast("double")
    return readings.withColumn("tool_wear_minutes", wear).cache()


def test_many_batches_and_restarts_equal_the_batch_operator(spark, log, tmp_path):
    for start in range(0, 200, 35):  # every append is a batch of a new run from the checkpoint
        writers.append_readings(log.where(F.col("id").between(start + 1, start + 35)).coalesce(1), f"{tmp_path}/log")
        got = run(spark, tmp_path, 60)
        assert rows_of(got) == rows_of(tool_cycles(log.where(F.col("id") <= start + 35)))
    assert got.agg(F.max("late_readings")).first()[0] == 0
    assert spark.read.parquet(f"{tmp_path}/cycles").select("batch").distinct().count() >= 6
    assert spark.conf.get(tool_state.STORE) != tool_state.ROCKSDB


def test_readings_out_of_order_within_the_delay(spark, log, tmp_path):
    for part in (1, 0, 2):  # blocks of ten swap places
        chosen = F.floor((F.col("id") - 1) / 10) % 3 == part
        writers.append_readings(log.where(chosen).coalesce(1), f"{tmp_path}/log")
    got = run(spark, tmp_path, 100_000)
    assert rows_of(got) == rows_of(tool_cycles(log))


def test_late_readings_are_counted_and_left_out(spark, log, tmp_path):
    late = F.col("id").isin(3, 4, 50)
    writers.append_readings(log.where(~late).coalesce(1), f"{tmp_path}/log")
    run(spark, tmp_path, 60)
    writers.append_readings(log.where(late).coalesce(1), f"{tmp_path}/log")
    got = run(spark, tmp_path, 60)
    assert rows_of(got) == rows_of(tool_cycles(log.where(~late)))
    per_machine = {r[0]: r[1] for r in got.groupBy("machine_id").agg(F.max("late_readings")).collect()}
    assert sum(per_machine.values()) == 3


def test_repeated_readings_count_once(spark, log, tmp_path):
    for _ in range(2):
        writers.append_readings(log.where("id <= 20").coalesce(1), f"{tmp_path}/log")
    got = run(spark, tmp_path, 100_000)
    assert rows_of(got) == rows_of(tool_cycles(log.where("id <= 20")))
