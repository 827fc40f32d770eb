"""Gate-and-detail scoring of whole frames."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolpulse.functions.labels import gated_failure_type, index_to_label
from toolpulse.sources.durable import materialise


def gate_and_detail(df: DataFrame, gate, detail=None) -> DataFrame:
    """Adds ``machine_failure, failure_probability, failure_type`` to feature rows.

    ``gate`` and ``detail`` are fitted models. Only rows that the gate calls
    failures, a few percent, go through the detail model; the others have no type.
    """
    if gate is None:
        raise ValueError("no gate model: cannot score")
    scored = gate.transform(df, prefix="gate_").withColumns(
        {
            "machine_failure": F.col("gate_prediction").cast("int"),
            "failure_probability": F.round(F.col("gate_probability")[1], 4),
        }
    )
    scored = scored.drop(*[c for c in scored.columns if c.startswith("gate_")])
    if detail is None:
        return scored.withColumn("failure_type", gated_failure_type(F.col("machine_failure"), None))
    if not df.isStreaming:
        # Both branches below read the gate's answer; unwritten, each would compute it for its filter and its rows.
        scored = materialise(scored, "gated")
    failing = F.col("machine_failure") == 1
    typed = detail.transform(scored.where(failing), prefix="detail_")
    typed = typed.withColumn("failure_type", gated_failure_type(F.col("machine_failure"), index_to_label(F.col("detail_prediction"))))
    typed = typed.drop(*[c for c in typed.columns if c.startswith("detail_")])
    plain = scored.where(~F.coalesce(failing, F.lit(False))).withColumn("failure_type", F.lit(None).cast("string"))
    return typed.unionByName(plain)


def ordered_answers(scored: DataFrame, request: str, position: str) -> DataFrame:
    """One row per request: its predictions in the order of its readings, and the totals.

    A request is as long as its payload, so its list is bounded by what a client can send.
    """
    answer = F.struct(position, "machine_failure", "failure_probability", "failure_type")
    return scored.groupBy(request).agg(
        F.array_sort(F.collect_list(answer)).alias("predictions"),
        F.count("*").alias("total_readings"),
        F.sum("machine_failure").alias("total_failures_predicted"),
    )


def batch_totals(scored: DataFrame, request: str) -> DataFrame:
    """Readings and predicted failures per request."""
    return scored.groupBy(request).agg(
        F.count("*").alias("total_readings"), F.sum("machine_failure").alias("total_failures_predicted")
    )
