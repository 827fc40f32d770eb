"""Row numbers of the derived training table."""

from toolpulse.operators.ranking import rows_before
from toolpulse.plans import adapters

SF = "/root/testdata/sf0.001"


def test_rows_before_adds_up_over_ranges(spark):
    counts = spark.range(1000).selectExpr("(id * 7919) % 1000 - 500 AS k", "id % 4 AS n").repartition(7)
    found = rows_before(counts, "k", "n", "before", rows_per_range=90).orderBy("k").collect()
    total = 0
    for row in found:
        assert row["before"] == total
        total += row["n"]
    assert [r["k"] for r in found] == list(range(-500, 500))
    assert rows_before(counts.where("k > 999"), "k", "n", "before").count() == 0


def test_numbered_rows_are_not_shuffled_again(spark):
    """Only the keys are dealt out; their rows unfold where the ranges lie."""
    plan = adapters._numbered_keys(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" not in plan and "REPARTITION" not in plan
