"""Metrics, weights and summaries on the rule score."""

from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features
from toolpulse.functions.labels import label_to_index
from toolpulse.operators import drift as D
from toolpulse.operators import metrics as M
from toolpulse.operators.splits import with_folds, with_test_flag
from toolpulse.plans import adapters as A
from toolpulse.plans import sql as Q
from toolpulse.plans.catalogue import query
from toolpulse.plans.catalogue.drift import everything, reference
from toolpulse.plans.catalogue.tables import LABELLED, SPLIT, labelled, request_payloads
from toolpulse.sources.durable import materialise
from toolpulse.sources.readers import parse_requests


def six(name: str):
    return F.round(name, 6).alias(name)


@query(
    "a5_imbalance_ratio",
    Q.with_training(
        """SELECT round(count(*) FILTER (machine_failure = 0)::DOUBLE / count(*) FILTER (machine_failure = 1), 6) AS imbalance_ratio
        FROM split JOIN training USING (udi) WHERE NOT is_test""",
        LABELLED.replace(Q.LABEL, "machine_failure"),
        SPLIT,
    ),
)
def a5(spark, sf):
    rows = with_test_flag(A.training(spark, sf).select("udi", "machine_failure"), "machine_failure")
    train = rows.where("NOT is_test")
    return train.agg(F.round(M.imbalance_ratio(F.col("machine_failure")), 6).alias("imbalance_ratio"))


@query(
    "a6_class_weights",
    Q.with_training(
        """SELECT label, n AS class_rows, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
        FROM (SELECT label, count(*) AS n FROM labelled GROUP BY 1)""",
        LABELLED,
    ),
)
def a6(spark, sf):
    return M.class_weights(labelled(spark, sf), "label").select("label", "class_rows", six("weight"))


@query(
    "a7_batch_totals",
    Q.with_readings(
        f"""SELECT request_id, count(*) AS total_readings, CAST(sum(CASE WHEN pct > 50 THEN 1 ELSE 0 END) AS BIGINT) AS total_failures_predicted
        FROM (SELECT request_id, {Q.rule_percent('machine_type')} AS pct FROM (
          SELECT id AS request_id, machine_type, air_temperature_kelvin, process_temperature_kelvin, rotational_speed_rpm,
          torque_nm + position * 25.0::DOUBLE AS torque_nm, tool_wear_minutes FROM readings, (SELECT unnest([0, 1]) AS position) WHERE position < id % 3)) GROUP BY 1"""
    ),
)
def a7(spark, sf):
    from toolpulse.operators.scoring import batch_totals

    rows, _ = parse_requests(request_payloads(spark, sf))
    scored = rows.withColumn("machine_failure", F.when(A.rule_percent("machine_type") > 50, 1).otherwise(0))
    return batch_totals(scored, "request_id")


@query(
    "a9_binary_scores",
    Q.with_scored(
        """SELECT tp, fp, fn, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
        round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (SELECT CAST(sum(machine_failure * predicted) AS BIGINT) AS tp,
        CAST(sum((1 - machine_failure) * predicted) AS BIGINT) AS fp, CAST(sum(machine_failure * (1 - predicted)) AS BIGINT) AS fn FROM scored)"""
    ),
)
def a9(spark, sf):
    counts = M.confusion(A.scored_training(spark, sf), "machine_failure", "predicted")
    return M.binary_scores(counts).select("tp", "fp", "fn", six("precision"), six("recall"), six("f1"))


@query(
    "a10_macro_scores",
    Q.with_scored(
        """SELECT round(avg(coalesce(hit / nullif(called, 0), 0)), 6) AS precision, round(avg(coalesce(hit / nullif(actual, 0), 0)), 6) AS recall,
        round(avg(coalesce(2 * hit / nullif(called + actual, 0), 0)), 6) AS f1
        FROM (SELECT c, sum(a)::DOUBLE AS actual, sum(p)::DOUBLE AS called, sum(h)::DOUBLE AS hit FROM (
          SELECT failure_type AS c, 1 AS a, 0 AS p, CASE WHEN failure_type = predicted_type THEN 1 ELSE 0 END AS h FROM scored
          UNION ALL SELECT predicted_type, 0, 1, 0 FROM scored) GROUP BY 1)"""
    ),
)
def a10(spark, sf):
    counts = M.confusion(A.scored_training(spark, sf), "failure_type", "predicted_type")
    return M.macro_scores(counts).select(six("precision"), six("recall"), six("f1"))


@query(
    "a11_roc_auc",
    Q.with_scored(
        """SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc FROM (SELECT pos, neg,
        coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT probability, sum(machine_failure) AS pos, sum(1 - machine_failure) AS neg FROM scored GROUP BY 1))"""
    ),
)
def a11(spark, sf):
    return M.roc_auc(A.scored_training(spark, sf), "machine_failure", "probability").select(six("roc_auc"))


@query(
    "a11_roc_auc_fine_score",
    Q.with_scored(
        """SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc FROM (SELECT pos, neg,
        coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT mechanical_stress + udi / 1000000.0::DOUBLE AS s, sum(machine_failure) AS pos, sum(1 - machine_failure) AS neg FROM scored GROUP BY 1))"""
    ),
)
def a11_fine(spark, sf):
    """A score that hardly repeats: nearly as many distinct scores as rows."""
    rows = engineer_features(A.training(spark, sf))
    rows = rows.withColumn("s", F.col("mechanical_stress") + F.col("udi") / F.lit(1000000.0))
    return M.roc_auc(rows, "machine_failure", "s").select(six("roc_auc"))


SHARES_SQL = """shares AS (SELECT failure_type, [w1 / t, w2 / t, w3 / t, w4 / t, w5 / t] AS p FROM (SELECT *, w1 + w2 + w3 + w4 + w5 AS t FROM (
  SELECT failure_type, (1 + 40 * ({hdf})::INT)::DOUBLE AS w1, (100 - pct)::DOUBLE AS w2, (1 + 35 * ({osf})::INT)::DOUBLE AS w3,
  (1 + 45 * ({pwf})::INT)::DOUBLE AS w4, (1 + 25 * ({twf})::INT)::DOUBLE AS w5 FROM scored)))""".format(
    **{n: Q.condition(n) for n in ("twf", "hdf", "pwf", "osf")}
)


@query(
    "a12_brier",
    Q.with_scored(
        """SELECT (SELECT round(avg((probability - machine_failure) * (probability - machine_failure)), 6) FROM scored) AS brier_binary,
        round(avg("""
        + " + ".join(
            f"(p[{i + 1}] - (failure_type = '{c}')::INT) * (p[{i + 1}] - (failure_type = '{c}')::INT)"
            for i, c in enumerate(S.FAILURE_CLASSES)
        )
        + ") / 2, 6) AS brier_multiclass FROM shares",
        SHARES_SQL,
    ),
)
def a12(spark, sf):
    scored = A.with_rule_shares(A.scored_training(spark, sf))
    return scored.agg(
        F.round(M.brier_binary(F.col("machine_failure"), F.col("probability")), 6).alias("brier_binary"),
        F.round(M.brier_multiclass(label_to_index(F.col("failure_type")), F.col("shares")), 6).alias("brier_multiclass"),
    )


SPLIT_SCORES = """ss AS (SELECT is_test, 2.0::DOUBLE * sum(machine_failure * predicted) / sum(machine_failure + predicted) AS f1 FROM scored JOIN split USING (udi) GROUP BY 1)"""


@query(
    "a13_overfit_delta",
    Q.with_scored(
        """SELECT round(tr, 6) AS f1_train, round(te, 6) AS f1_test, round(tr - te, 6) AS overfit_delta, tr - te > 0.1 AS overfit_warning
        FROM (SELECT max(f1) FILTER (NOT is_test) AS tr, max(f1) FILTER (is_test) AS te FROM ss)""",
        LABELLED,
        SPLIT,
        SPLIT_SCORES,
    ),
)
def a13(spark, sf):
    rows = with_test_flag(A.scored_training(spark, sf), "failure_type")
    by_split = M.scores(M.confusion(rows, "machine_failure", "predicted", "is_test"), "binary", "is_test")
    return M.overfit(by_split).select(six("f1_train"), six("f1_test"), six("overfit_delta"), "overfit_warning")


# Trials: the rule score cut at ten levels, scored in each of five folds.
TRIAL_SQL = """folds AS (SELECT udi, CAST(ntile(5) OVER (PARTITION BY label ORDER BY h) - 1 AS INTEGER) AS fold FROM labelled),
  fs AS (SELECT trial, fold, coalesce(2.0::DOUBLE * sum(machine_failure * c) / nullif(sum(machine_failure + c), 0), 0) AS f1
    FROM (SELECT trial, fold, machine_failure, CASE WHEN pct > trial * 10 THEN 1 ELSE 0 END AS c FROM scored JOIN folds USING (udi), (SELECT unnest(range(0, 10))::INTEGER AS trial)) GROUP BY 1, 2),
  mean AS (SELECT trial, avg(f1) AS mean_f1, count(*) AS folds FROM fs GROUP BY 1)"""


def trial_scores(spark, sf):
    rows = with_folds(A.scored_training(spark, sf), "failure_type", S.CV_FOLDS)
    cuts = F.explode(F.array(*[F.lit(i) for i in range(10)])).alias("trial")
    called = rows.select("fold", "machine_failure", A.rule_percent().alias("pct"), cuts).withColumn(
        "called", F.when(F.col("pct") > F.col("trial") * 10, 1).otherwise(0)
    )
    counts = M.confusion(called, "machine_failure", "called", "trial", "fold")
    return M.mean_fold_score(M.scores(counts, "binary", "trial", "fold"))


@query(
    "a14_mean_fold_score",
    Q.with_scored("SELECT trial, round(mean_f1, 6) AS mean_f1, folds FROM mean", LABELLED, TRIAL_SQL),
)
def a14(spark, sf):
    return trial_scores(spark, sf).select("trial", six("mean_f1"), "folds")


@query(
    "w10_best_trial",
    Q.with_scored("SELECT trial, round(mean_f1, 6) AS mean_f1 FROM mean ORDER BY mean.mean_f1 DESC, trial LIMIT 1", LABELLED, TRIAL_SQL),
)
def w10(spark, sf):
    return M.best_trial(trial_scores(spark, sf)).select("trial", six("mean_f1"))


@query(
    "a15_scaling_moments",
    Q.with_training(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM featured" for c in Q.NUMERIC
        )
    ),
)
def a15(spark, sf):
    moments = M.scaling_moments(engineer_features(A.training(spark, sf)), S.NUMERIC_FEATURES)
    return moments.select("feature", six("mean"), six("std"))


@query(
    "a16_vocabulary",
    Q.with_training("SELECT CAST(row_number() OVER (ORDER BY type) - 1 AS INTEGER) AS position, type FROM (SELECT DISTINCT type FROM training)"),
)
def a16(spark, sf):
    return M.vocabulary(A.training(spark, sf), "type")


SUMMARY_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) AS row_count, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS distinct_values,
    round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25,
    round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max,
    CAST(NULL AS VARCHAR) AS top_category, CAST(NULL AS BIGINT) AS top_count FROM readings"""
    for c in Q.NUMERIC
)


@query(
    "a17_data_summary",
    Q.with_readings(
        SUMMARY_SQL
        + """ UNION ALL SELECT 'type', (SELECT count(*) FROM readings), 0, (SELECT count(DISTINCT machine_type) FROM readings),
        NULL, NULL, NULL, NULL, NULL, NULL, NULL, machine_type, n FROM
        (SELECT machine_type, count(*) AS n FROM readings GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1)"""
    ),
)
def a17(spark, sf):
    current = everything(spark, sf)
    counts = materialise(D.value_counts(current.limit(0), current), "value-counts")
    summary = D.data_summary(counts, "n_cur")
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "a18_histograms",
    Q.with_both(
        """SELECT feature, CAST(CASE WHEN v < lo THEN 0 WHEN v > hi THEN 11 ELSE least(10, 1 + floor((v - lo) * 10 / (hi - lo))) END AS INTEGER) AS bin,
        CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(c) AS BIGINT) AS n_cur
        FROM vc JOIN (SELECT feature, min(v) AS lo, max(v) AS hi FROM vc WHERE r > 0 GROUP BY 1) USING (feature) GROUP BY 1, 2""",
        Q.numeric_counts(),
    ),
)
def a18(spark, sf):
    return D.histograms(reference(spark, sf), everything(spark, sf))
