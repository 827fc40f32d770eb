"""Ids, status lines, log triage and the metrics report, as string columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse import schemas as S

# Text fragments that identify a cause, in the order they are tried.
JOB_LOG_CAUSES = [
    (
        "no_network",
        [
            "Name or service not known",
            "nodename nor servname",
            "Temporary failure in name resolution",
            "getaddrinfo failed",
            "Could not resolve host",
        ],
    ),
    ("remote_unreachable", ["Connection refused", "Connection timed out", "Max retries exceeded", "Could not connect"]),
    (
        "login_failed",
        ["401", "403", "Authentication failed", "Permission denied (publickey)", "could not read Username"],
    ),
    ("remote_is_ahead", ["rejected", "non-fast-forward", "Updates were rejected"]),
    ("nothing_new", ["nothing to commit"]),
    ("disk_full", ["No space left on device"]),
]
MODEL_LOAD_CAUSES = [
    (
        "registry_unreachable",
        [
            "Name or service not known",
            "nodename nor servname",
            "getaddrinfo failed",
            "Temporary failure in name resolution",
            "Could not resolve host",
            "Max retries exceeded",
            "Connection refused",
            "ConnectTimeout",
            "ReadTimeout",
        ],
    ),
    ("registry_login_failed", ["401", "403", "UNAUTHENTICATED", "PERMISSION_DENIED", "authentication"]),
    ("no_production_model", ["RESOURCE_DOES_NOT_EXIST", "alias", "not found"]),
]
MODEL_LOAD_FALLBACK = "unrecognised"


def triage(text: Column, causes: list[tuple[str, list[str]]], fallback: str | None = None) -> Column:
    """First cause with a fragment in ``text``; ``fallback`` (null by default) if none fits."""
    chain = F
    for cause, fragments in causes:
        hit = F.lit(False)
        for fragment in fragments:
            hit = hit | text.contains(fragment)
        chain = chain.when(hit, F.lit(cause))
    return chain.otherwise(F.lit(fallback).cast("string"))


def product_id(machine_type: Column, counter: Column) -> Column:
    number = (F.lit(S.PRODUCT_NUMBER_BASE).cast("long") + counter.cast("long"))
    return F.format_string("%s%05d", machine_type, number)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text; the session time zone is expected to be UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def status_label(predicted: Column, failure_type: Column) -> Column:
    failed = predicted == 1
    return (
        F.when(failure_type.isNotNull() & failed, F.concat(F.upper(failure_type), F.lit(" ⚠")))
        .when(failure_type.isNotNull(), failure_type)
        .when(failed, F.lit("FAILURE ⚠"))
        .otherwise(F.lit("normal   "))
    )


def status_line(
    number: Column, clock: Column, machine: Column, machine_type: Column, torque: Column, wear: Column,
    rpm: Column, label: Column, probability: Column, rate: Column, injected: Column,
) -> Column:
    """One fixed-width line per reading for consoles and alert feeds."""
    line = F.format_string(
        "[%04d | %s]  %s  %s  T=%05.1fNm  W=%03dmin  rpm=%04d  → %-10s  p=%.2f  (rate=%.0f%%)",
        number.cast("long"), clock, machine, machine_type, torque.cast("double"), wear.cast("long"),
        rpm.cast("long"), label, probability, rate * 100,
    )
    return F.concat(line, F.when(injected == 1, F.lit("  [injected]")).otherwise(F.lit("")))


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Report lines ``(line_no, line)`` from a one-row metrics frame.

    The AUC line appears only where ``roc_auc_test`` exists and is not null.
    """
    entries = [
        ("f1_test", "f1_test:        %.4f"),
        ("precision_test", "precision_test: %.4f"),
        ("recall_test", "recall_test:    %.4f"),
        ("brier_score", "brier_score:    %.4f  (lower is better; 0 = perfect)"),
    ]
    lines = [F.lit("# Training Metrics"), F.lit("")]
    lines += [F.format_string(pattern, F.col(name)) for name, pattern in entries]
    if "roc_auc_test" in metrics.columns:
        lines.append(
            F.when(F.col("roc_auc_test").isNotNull(), F.format_string("roc_auc_test:   %.4f", F.col("roc_auc_test")))
        )
    return (
        metrics.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))
        .where(F.col("line").isNotNull())
    )
