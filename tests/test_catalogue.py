"""The catalogue is complete, and a few queries of each group agree with their SQL twins."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry
from toolpulse.plans import adapters

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "p5_engineer_features", "p10_validate_readings", "p14_readings_to_training", "f7_multiclass_label", "f12_status_line",
    "d3_wasserstein", "d7_feature_table", "d8_dataset_verdict_stable", "t3_daily_drift_trend", "a11_roc_auc", "a17_data_summary",
    "w5_batch_counter", "w7_stratified_split", "w8_stratified_folds", "w11_tool_cycles", "j3_purge_by_id", "j5_resample_baseline",
    "m23_promotion_decisions", "e1_export_job", "t1_scored_stream", "t5_machine_wear",
]


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_reports_every_feature(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 9
    assert {r["feature"] for r in rows if r["drifted"]} == {"rotational_speed_rpm", "torque_nm", "power_kw"}


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), entry.oracle_sql()[name], connect(SF)) is None


def test_crowded_keys_unfold_in_chunks(spark, monkeypatch):
    """Keys with more rows than a chunk give the same numbering."""
    plain = adapters._numbered_keys(spark, SF)
    monkeypatch.setattr(adapters, "EXPAND_CHUNK", 1)
    chunked = adapters._numbered_keys(spark, SF)
    assert plain.count() == chunked.count() == plain.select("udi").distinct().count()
    assert chunked.exceptAll(plain).isEmpty()
