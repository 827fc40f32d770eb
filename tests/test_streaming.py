import pytest
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.plans import adapters, jobs
from toolpulse.sources import writers
from toolpulse.sources.readers import reference_features
from toolpulse.streaming import monitor, scoring
from toolpulse.streaming.sources import readings_stream


@pytest.fixture
def log(readings, tmp_path):
    path = f"{tmp_path}/log"
    readings.repartition(4, "id").write.parquet(path)
    return path


def rule(df):
    return df.select("id", "power_kw", (adapters.rule_percent() / 100).alias("score"))


def test_scored_stream_equals_batch(spark, log, readings, tmp_path):
    arriving = readings_stream(spark, log, files_per_batch=1)
    query = scoring.append_scored(arriving, rule, f"{tmp_path}/sink", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/sink")
    assert got.count() == 200
    assert got.exceptAll(rule(scoring.with_model_features(readings))).isEmpty()
    again = scoring.append_scored(readings_stream(spark, log), rule, f"{tmp_path}/sink", f"{tmp_path}/checkpoint")
    again.awaitTermination()  # nothing new
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 200


def test_wear_stream(spark, log, tmp_path):
    monitor.track_wear(readings_stream(spark, log, 1), f"{tmp_path}/wear", f"{tmp_path}/checkpoint").awaitTermination()
    rows = {r["machine_id"]: r for r in spark.read.parquet(f"{tmp_path}/wear").collect()}
    assert sum(r["readings"] for r in rows.values()) == 200
    hot = rows["machine_01"]
    assert hot["readings"] > 108
    assert hot["wear"] == (hot["readings"] % 108) * 2 and hot["tools_replaced"] == hot["readings"] // 108


def test_drift_watch_over_batches(spark, log, training, tmp_path):
    space = jobs.Workspace(spark, f"{tmp_path}/space")
    space.training.seed(training)
    seen = []
    monitor.watch_drift(
        readings_stream(spark, log, files_per_batch=2), space, reference_features(training), f"{tmp_path}/checkpoint",
        every=None, report=lambda batch, result: seen.append((batch, result.drifted, result.exported)),
    ).awaitTermination()
    assert len(seen) == 2 and all(drifted for _, drifted, _ in seen)
    assert sum(n for *_, n in seen) == 200
    assert space.training.training().count() == 275
    assert space.readings.rows().isEmpty()
    assert writers.read_check_log(spark, space.check_log).count() == 2


class Models:
    """A production model holder that answers with a version."""

    def __init__(self):
        self.refreshed = 0

    def refresh(self):
        self.refreshed += 1

    def score(self, df):
        return df.withColumn("machine_failure", F.lit(0)).withColumn("model_version", F.lit(str(self.refreshed)))


def test_bad_readings_are_quarantined_and_batches_replace_themselves(spark, readings, tmp_path):
    bad = readings.withColumn("torque_nm", F.when(F.col("id") % 10 == 0, -1.0).otherwise(F.col("torque_nm")))
    bad.coalesce(1).write.parquet(f"{tmp_path}/log")
    models = Models()
    for checkpoint in ("a", "b"):  # a fresh checkpoint repeats batch 0
        scoring.score_with_production(
            readings_stream(spark, f"{tmp_path}/log"), models, f"{tmp_path}/scored", f"{tmp_path}/bad", f"{tmp_path}/{checkpoint}"
        ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/scored").count() == 180
    quarantined = spark.read.parquet(f"{tmp_path}/bad")
    assert quarantined.count() == 20
    assert quarantined.where("array_contains(reject_reasons, 'torque_nm:out_of_range')").count() == 20


class FakeRegistry:
    def __init__(self, version):
        self.version = version

    def resolve(self, name):
        return {"version": self.version, "path": "p", "f1_test": 0.9} if self.version else None


def test_reload_keeps_last_good_model(monkeypatch):
    registry = FakeRegistry("1")
    monkeypatch.setattr(scoring, "load_production", lambda reg, name: (f"model-{reg.version}", reg.version, 0.9))
    models = scoring.ProductionModels(registry, "gate", "detail")
    assert models.refresh()["gate"] == {"status": "loaded", "version": "1"}
    registry.version = "2"

    def broken(reg, name):
        raise OSError("unreadable")

    monkeypatch.setattr(scoring, "load_production", broken)
    outcome = models.refresh()
    assert outcome["gate"]["status"] == "failed" and models.loaded["gate"][1] == "1"
    monkeypatch.setattr(scoring, "load_production", lambda reg, name: (f"model-{reg.version}", reg.version, 0.9))
    assert models.refresh()["gate"]["version"] == "2"


def test_missing_gate_is_an_error():
    with pytest.raises(RuntimeError):
        scoring.ProductionModels(FakeRegistry(None), "gate", "detail").refresh()


def test_repeats_within_the_delay_are_dropped(spark, readings, tmp_path):
    readings.union(readings.where("id <= 20")).coalesce(1).write.parquet(f"{tmp_path}/log")
    stream = monitor.deduplicated(readings_stream(spark, f"{tmp_path}/log"))
    writer = stream.writeStream.format("parquet").option("path", f"{tmp_path}/sink")
    writer.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/sink").count() == 200
    assert S.READINGS_COLUMNS == stream.columns
