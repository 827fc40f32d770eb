"""Rows of a fit are spread over its tasks, the same way each time."""

from toolpulse.operators import models as MM


def test_a_sorted_window_is_trained_on_by_several_tasks(spark):
    window = spark.range(50_000).withColumnRenamed("id", "udi").orderBy("udi").limit(20_000)
    assert window.rdd.getNumPartitions() == 1
    dealt = MM.dealt(window)
    assert dealt.rdd.getNumPartitions() == MM.FEW_FIT_TASKS
    parts = [[r["udi"] for r in part] for part in dealt.rdd.glom().collect()]
    assert sorted(sum(parts, [])) == list(range(20_000)) and all(p == sorted(p) and p for p in parts)
    assert parts == [[r["udi"] for r in part] for part in MM.dealt(window.repartition(7)).rdd.glom().collect()]


def test_few_rows_stay_in_one_task(spark):
    assert MM.dealt(spark.range(75).withColumnRenamed("id", "udi")).rdd.getNumPartitions() == 1
