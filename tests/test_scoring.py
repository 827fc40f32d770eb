"""Gate, detail and ordered answers on stand-in models."""

from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators.scoring import gate_and_detail, ordered_answers


class Gate:
    def transform(self, df, prefix):
        share = F.col("x") / 10.0
        return df.withColumns(
            {f"{prefix}prediction": (share > 0.5).cast("double"), f"{prefix}probability": F.array(1 - share, share)}
        )


class Detail:
    """Fails on a row that the gate lets pass."""

    def transform(self, df, prefix):
        osf = F.lit(float(S.FAILURE_CLASSES.index("osf")))
        return df.withColumn(f"{prefix}prediction", F.when(F.col("x") > 5, osf).otherwise(F.raise_error(F.lit("asked"))))


def rows(spark):
    return spark.createDataFrame([("a", 2, 9), ("a", 0, 1), ("a", 1, 7), ("b", 0, 5)], "request string, position int, x int")


def test_detail_sees_failures_only(spark):
    got = {(r["request"], r["position"]): r for r in gate_and_detail(rows(spark), Gate(), Detail()).collect()}
    assert {k: (r["machine_failure"], r["failure_type"]) for k, r in got.items()} == {
        ("a", 0): (0, None), ("a", 1): (1, "osf"), ("a", 2): (1, "osf"), ("b", 0): (0, None),
    }
    assert got["a", 1]["failure_probability"] == 0.7


def test_gate_alone_gives_no_type(spark):
    assert gate_and_detail(rows(spark), Gate()).where("failure_type IS NOT NULL").isEmpty()


def test_answers_keep_the_order_of_the_request(spark):
    got = {r["request"]: r for r in ordered_answers(gate_and_detail(rows(spark), Gate(), Detail()), "request", "position").collect()}
    assert [p["position"] for p in got["a"]["predictions"]] == [0, 1, 2]
    assert (got["a"]["total_readings"], got["a"]["total_failures_predicted"]) == (3, 2)
    assert (got["b"]["total_readings"], got["b"]["total_failures_predicted"]) == (1, 0)
