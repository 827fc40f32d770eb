import pytest
from pyspark.sql import functions as F

from toolpulse.operators import registry as R
from toolpulse.plans import jobs
from toolpulse.sources import durable, readers, writers
from toolpulse.sources.readers import reference_features


@pytest.fixture
def space(spark, training, readings, tmp_path):
    space = jobs.Workspace(spark, str(tmp_path))
    writers.append_readings(readings, space.readings.path)
    space.training.seed(training)
    return space


# --- sources and sinks --------------------------------------------------------------


def test_log_lifecycle(spark, readings, tmp_path):
    path = f"{tmp_path}/log"
    writers.create_readings_log(spark, path)
    assert readers.readings_log(spark, path).count() == 0
    writers.append_readings(readings, path)
    writers.create_readings_log(spark, path)
    assert readers.readings_log(spark, path).count() == 200
    writers.clear_readings(spark, path)
    assert readers.readings_log(spark, path).count() == 0


def test_null_in_required_column_fails(readings, tmp_path):
    bad = readings.withColumn("torque_nm", F.when(F.col("id") != 7, F.col("torque_nm")))
    with pytest.raises(Exception, match="torque_nm"):
        writers.append_readings(bad, f"{tmp_path}/log")


def test_scan_reads_only_needed_columns(spark, space):
    plan = space.training.training().select("udi").where("udi > 10")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<UDI:bigint>" in plan and "GreaterThan(UDI,10)" in plan


def test_current_sample_limits_before_dropping_nulls(spark, readings):
    holed = readings.withColumn("torque_nm", F.when(F.col("id") < 196, F.col("torque_nm")))
    assert readers.current_sample(holed, limit=10).count() == 5
    assert readers.current_sample(holed, limit=None).count() == 195


def test_requests_keep_order_and_reject_empty(spark):
    one = '{"machine_type":"M","torque_nm":%d}'
    payloads = [("a", '{"readings":[%s,%s]}' % (one % 1, one % 2)), ("b", '{"readings":[]}'), ("c", "not json"), ("d", "{}")]
    df = spark.createDataFrame(payloads, "request_id string, payload string")
    rows, rejected = readers.parse_requests(df)
    assert [(r["position"], r["torque_nm"]) for r in rows.orderBy("position").collect()] == [(0, 1.0), (1, 2.0)]
    assert {r[0] for r in rejected.collect()} == {"b", "c", "d"}


def test_durable_tables_use_the_session_folder(spark):
    df = durable.materialise(spark.range(5), "numbers")
    assert df.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in df.inputFiles())


# --- export -------------------------------------------------------------------------


def test_export_is_idempotent_and_purges_exactly(space, readings):
    exported = jobs.export_readings(space.readings, space.training)
    assert exported.count() == 200
    assert [r[0] for r in exported.orderBy("udi").select("udi").collect()] == list(range(76, 276))
    assert exported.orderBy("udi").first()["product_id"][1:] == "20001"
    assert jobs.export_readings(space.readings, space.training).count() == 0
    assert space.training.training().count() == 275
    before = space.readings.rows()
    late = readings.where("id <= 3").withColumn("id", F.col("id") + 1000)
    writers.append_readings(late, space.readings.path)
    assert space.readings.purge(before.select("id")) == 200
    # A writer that knows the log's folder goes on after the purge.
    writers.append_readings(late.withColumn("id", F.col("id") + 1000), space.readings.path)
    assert {r["id"] for r in space.readings.rows().collect()} == {1001, 1002, 1003, 2001, 2002, 2003}
    assert jobs.export_readings(space.readings, space.training, purge=True).count() == 6
    assert space.readings.rows().isEmpty()


def test_retried_export_purges(spark, space):
    """An export that ended before its purge is made up for; the log opens again in another session."""
    assert jobs.export_readings(space.readings, space.training).count() == 200
    assert jobs.export_readings(space.readings, space.training, purge=True).count() == 0
    assert space.readings.purge(space.training.exported_ids()) == 0
    again = jobs.Workspace(spark.newSession(), space.root)
    assert again.readings.rows().isEmpty() and again.training.training().count() == 275


def test_dry_run_writes_nothing(space):
    assert jobs.export_readings(space.readings, space.training, dry_run=True).count() == 200
    assert space.training.training().count() == 75


def test_first_export_starts_at_one(spark, readings, tmp_path):
    space = jobs.Workspace(spark, str(tmp_path))
    writers.append_readings(readings, space.readings.path)
    assert jobs.export_readings(space.readings, space.training, since="2024-01-01 01:00:00").agg(F.min("udi")).first()[0] == 1
    assert space.training.training().count() == 139


# --- drift check --------------------------------------------------------------------


def test_check_without_data_is_logged(spark, training, tmp_path):
    space = jobs.Workspace(spark, str(tmp_path))
    writers.create_readings_log(spark, space.readings.path)
    assert jobs.check_drift(space, reference_features(training)).status == "NO_DATA"
    log = writers.read_check_log(spark, space.check_log).collect()
    assert [(r["drift_detected"], r["retrain_triggered"]) for r in log] == [(False, False)]


def test_drift_exports_and_triggers(spark, space, training):
    result = jobs.check_drift(space, reference_features(training))
    assert result.drifted and result.retrain and result.exported == 200
    assert space.readings.rows().isEmpty()
    assert spark.read.text(space.triggers).first()[0].startswith("drift detected: ")


def test_stable_readings_are_exported_only_on_request(spark, space, readings):
    reference = readers.current_features(readings)
    assert not jobs.check_drift(space, reference).drifted
    assert space.training.training().count() == 75
    result = jobs.check_drift(space, reference, export_always=True, purge=False)
    assert (result.exported, result.retrain) == (200, False)
    assert not writers.table_exists(spark, space.triggers)


def test_failed_export_is_logged_and_raised(spark, space, training, monkeypatch):
    def fail(*args, **kwargs):
        raise OSError("disk")

    monkeypatch.setattr(jobs, "export_readings", fail)
    with pytest.raises(OSError):
        jobs.check_drift(space, reference_features(training))
    log = writers.read_check_log(spark, space.check_log).first()
    assert (log["drift_detected"], log["retrain_triggered"]) == (True, False)


# --- registry -----------------------------------------------------------------------


def test_promotion_gates_on_a_grid(spark):
    """Every mix of scores around each other, with and without a model in production or a metric."""
    values = [None, 0.0, 0.3, 0.30000001, 0.6, 1.0]
    grid = [(new, held, floor) for new in values for held in values for floor in values if floor is not None]
    improvement, above = R.gates(F.col("n"), F.col("p"), F.col("f"))
    rows = spark.createDataFrame(grid, "n double, p double, f double").select("*", improvement.alias("i"), above.alias("a")).collect()
    assert len(rows) == len(grid)
    for r in rows:
        if r["p"] is None:
            assert r["i"]  # nothing to beat
        else:
            assert bool(r["i"]) == (r["n"] is not None and max(r["n"], r["p"]) != r["p"])
        assert bool(r["a"]) == (r["n"] is not None and min(r["n"], r["f"]) == r["f"])


def test_registry_versions_and_promotion(spark, tmp_path):
    reg = R.Registry(spark, str(tmp_path))
    name = "machine-failure-binary"
    with pytest.raises(ValueError):
        reg.promote(name)
    for i in range(10):
        version = reg.register(name, "e", f"run{i}", "/m", {"f1_test": 0.80 + i / 100}, {"a": 1}, {"target_type": "binary"})
    assert version == "10"  # as a number, not as text
    decision = reg.promote(name)
    assert (decision["candidate_version"], decision["outcome"]) == ("10", "WOULD PROMOTE")
    assert reg.resolve(name) is None
    assert reg.promote(name, auto=True)["outcome"] == "PROMOTED"
    assert reg.resolve(name)["version"] == "10"
    reg.register(name, "e", "worse", "/m", {"f1_test": 0.86}, {}, {})
    assert reg.promote(name, auto=True)["outcome"] == "NOT PROMOTED"
    reg.register(name, "e", "unmeasured", "/m", {}, {}, {})
    assert reg.promote(name, auto=True)["outcome"] == "NO METRIC"
    assert reg.resolve(name)["version"] == "10"
    assert reg.versions().count() == 12
