"""Work per row of scoring: every row is scored once, and only rows that are wanted."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from toolpulse.operators.scoring import gate_and_detail
from toolpulse.plans.catalogue import models as C


def counted_model(spark):
    """A model that calls every fifth row, and an accumulator of the rows it looked at."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(key):
        seen.add(1)
        return 0.9 if key % 5 == 0 else 0.1

    def transform(df, prefix=""):
        scored = df.withColumn("s", score("udi"))
        scored = scored.withColumn(f"{prefix}probability", F.array(1 - F.col("s"), F.col("s"))).drop("s")
        return scored.withColumn(f"{prefix}prediction", (F.col(f"{prefix}probability")[1] > 0.5).cast("int"))

    return SimpleNamespace(transform=transform), seen


def test_gate_looks_at_a_row_once(spark):
    gate, seen = counted_model(spark)
    detail, typed = counted_model(spark)
    rows = gate_and_detail(spark.range(100).withColumnRenamed("id", "udi"), gate, detail).collect()
    assert len(rows) == 100 and sum(r["machine_failure"] for r in rows) == 20
    assert sum(r["failure_type"] is not None for r in rows) <= 20
    assert seen.value == 100
    assert typed.value <= 40


def test_stored_models_score_only_the_rows_scored_before(spark, monkeypatch, training):
    model, seen = counted_model(spark)
    scored = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1, 11)], "udi long, prediction int")
    monkeypatch.setattr(C, "registry", lambda spark, sf: None)
    monkeypatch.setattr(C, "trained", lambda spark, sf, name: SimpleNamespace(scored=scored))
    monkeypatch.setattr(C.A, "training", lambda spark, sf: training)
    monkeypatch.setattr(C.MM, "load_production", lambda reg, name: (model, "1", 0.9))
    rows = C.s15(spark, "").collect()
    assert sum(r["row_count"] for r in rows) == sum(r["equal"] for r in rows) == 20
    assert seen.value == 20
