"""Model queries that train on every row of a table longer than the product's training window."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_full_presets import Called, record

import __spark_entry__ as entry
from toolpulse import schemas as S
from toolpulse.operators.experiments import EXPERIMENTS
from toolpulse.plans.catalogue import models as Q

ROWS = S.TRAINING_WINDOW + 100
WHOLE = [
    "m4_xgb_multiclass_checks", "m7_rf_binary_checks", "m8_rf_multiclass", "m10_logreg_multiclass_checks",
    "m13_mlp_binary_checks", "m14_mlp_multiclass_checks", "m19_train_with_best",
]


@pytest.fixture(scope="module")
def long_table(spark, tmp_path_factory):
    """Line items enough for a training table longer than the window."""
    path = str(tmp_path_factory.mktemp("long"))
    rows = spark.range(ROWS).selectExpr("id + 1 AS l_orderkey", "1 AS l_linenumber")
    rows.coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize("name", WHOLE)
def test_every_row_is_trained_on(spark, long_table, monkeypatch, name):
    monkeypatch.setattr(Q, "_trained", {})
    for function in ("train_model", "tune_model"):
        record(monkeypatch, Q.MM, function)
    with pytest.raises(Called) as stopped:
        entry.queries()[name](spark, long_table)
    assert stopped.value.args[1]["training"].count() == ROWS


@pytest.mark.parametrize("name", [n for n in WHOLE if n.endswith("_checks")])
def test_sql_splits_every_row(long_table, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{long_table}/lineitem.parquet/*.parquet'")
    assert sum(r[0] for r in con.sql(f"SELECT row_count FROM ({entry.oracle_sql()[name]})").fetchall()) == ROWS


def test_rows_that_lack_a_feature_are_split_but_not_called(training):
    """They lie outside the window of newest rows where their keys are missing; the whole table has them."""
    holes = training.withColumn("torque_nm", F.when(F.col("udi") % 10 != 3, F.col("torque_nm")))
    lacking = holes.where("torque_nm IS NULL").count()
    result = Q.MM.train_model(holes, EXPERIMENTS["logreg_multiclass"], "fast", {"iterations": 5})
    assert lacking and result.scored.count() == training.count()
    assert result.scored.where("prediction IS NULL AND probability IS NULL").count() == lacking
    assert Q.MM.measure(result.scored, EXPERIMENTS["logreg_multiclass"]).first().asDict() == result.metrics
