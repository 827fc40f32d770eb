"""Training, calibration, tuning and scoring with the full presets, trials and floors.

Fitted numbers have no SQL. What can be said of them exactly is checked beside
them: which rows were trained on and tested, that probabilities add up, that
stored metrics are those of the scored rows, and which answers may be null.
"""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features
from toolpulse.functions.labels import gated_failure_type
from toolpulse.operators import boosting as B
from toolpulse.operators import models as MM
from toolpulse.operators.experiments import BINARY_MODEL, EXPERIMENTS, MULTICLASS_MODEL
from toolpulse.operators.registry import Registry
from toolpulse.operators.splits import with_folds
from toolpulse.operators.scoring import batch_totals, gate_and_detail, ordered_answers
from toolpulse.plans import adapters as A
from toolpulse.plans import jobs
from toolpulse.plans import sql as Q
from toolpulse.plans.catalogue import query
from toolpulse.plans.catalogue.tables import REQUEST_SQL, SPLIT, request_payloads
from toolpulse.sources.durable import materialise, new_path
from toolpulse.sources.readers import parse_requests, training_window
from toolpulse.streaming.scoring import with_model_features

_trained: dict = {}


# Queries that train on the whole table; the others train on the product's window of newest rows.
WHOLE_TABLE = {
    "m4_xgb_multiclass_checks", "m7_rf_binary_checks", "m8_rf_multiclass", "m10_logreg_multiclass_checks",
    "m13_mlp_binary_checks", "m14_mlp_multiclass_checks", "m19_train_with_best",
}


def window_of(query_name: str) -> int | None:
    return None if query_name in WHOLE_TABLE else S.TRAINING_WINDOW


def trained(spark, sf, name: str, window: int | None = S.TRAINING_WINDOW) -> MM.TrainingResult:
    """One full training run per experiment, window and session; without a window on every row."""
    slot = (spark.sparkContext.applicationId, sf, name, window)
    if slot not in _trained:
        rows = training_window(A.training(spark, sf), window)
        _trained[slot] = MM.train_model(rows, EXPERIMENTS[name])
    return _trained[slot]


def registry(spark, sf) -> Registry:
    """A registry with a gate and a detail model, in production if they reach the floors."""
    slot = (spark.sparkContext.applicationId, sf, "registry")
    if slot not in _trained:
        reg = Registry(spark, new_path(spark, "registry"))
        for name in ("rf_binary", "rf_multiclass"):
            MM.register_model(reg, EXPERIMENTS[name], trained(spark, sf, name))
            reg.promote(EXPERIMENTS[name].model_name, auto=True)
        _trained[slot] = reg
    return _trained[slot]


INPUTS = [f"type_{t.lower()}" for t in S.MACHINE_TYPES] + S.NUMERIC_FEATURES
INPUT_SQL = [f"(type = '{t}')::INT::DOUBLE" for t in S.MACHINE_TYPES] + [f"{c}::DOUBLE" for c in S.NUMERIC_FEATURES]


def _vectors(spark, sf, scale: bool):
    """The model inputs as one rounded column each."""
    df = engineer_features(A.training(spark, sf))
    vectors = MM.feature_pipeline(scale).fit(df).transform(df).select("udi", vector_to_array("features").alias("v"))
    return vectors.select("udi", *[F.round(F.col("v")[i], 6).alias(name) for i, name in enumerate(INPUTS)])


@query(
    "m1_encode_features",
    Q.with_training("SELECT udi, " + ", ".join(f"round({e}, 6) AS {n}" for e, n in zip(INPUT_SQL, INPUTS)) + " FROM featured"),
)
def m1(spark, sf):
    return _vectors(spark, sf, scale=False)


@query(
    "m2_scale_features",
    Q.with_training(
        "SELECT udi, "
        + ", ".join(
            f"round(coalesce(({e} - avg({e}) OVER ()) / nullif(stddev_samp({e}) OVER (), 0), 0), 6) AS {n}"
            for e, n in zip(INPUT_SQL, INPUTS)
        )
        + " FROM featured"
    ),
)
def m2(spark, sf):
    return _vectors(spark, sf, scale=True)


def _experiment_query(number: int, name: str) -> None:
    @query(f"m{number}_{name}")
    def run(spark, sf):
        result = trained(spark, sf, name, window_of(f"m{number}_{name}"))
        return MM.measure(result.scored, EXPERIMENTS[name]).withColumn("experiment", F.lit(name))


def _split_sql(name: str, window: int | None) -> str:
    """Test flag of the newest rows, or of all without a window, stratified by the experiment's label."""
    label = "machine_failure" if EXPERIMENTS[name].target_type == "binary" else Q.LABEL
    rows = "training" if window is None else f"(SELECT * FROM training ORDER BY udi DESC LIMIT {window})"
    return f"""labelled AS (SELECT udi, {label} AS label, md5(CAST(udi AS VARCHAR) || ':42') AS h
        FROM {rows})"""


def _experiment_checks(number: int, name: str) -> None:
    body = """SELECT is_test, count(*) AS row_count, 0::BIGINT AS bad_totals, 0::BIGINT AS out_of_range, true AS metrics_agree
        FROM split GROUP BY is_test"""

    window = window_of(f"m{number}_{name}_checks")

    @query(f"m{number}_{name}_checks", Q.with_training(body, _split_sql(name, window), SPLIT))
    def run(spark, sf):
        """Rows per split, probabilities that do not add up or leave 0 to 1, and whether the stored metrics are those of the rows."""
        result = trained(spark, sf, name, window)
        again = MM.measure(result.scored, EXPERIMENTS[name]).first().asDict()
        agree = all(result.metrics[k] == v or abs(result.metrics[k] - v) < 1e-9 for k, v in again.items() if isinstance(v, float))
        total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
        return result.scored.groupBy("is_test").agg(
            F.count("*").alias("row_count"),
            F.count_if(F.abs(total - 1) > 1e-9).alias("bad_totals"),
            F.count_if(F.exists("probability", lambda p: (p < 0) | (p > 1))).alias("out_of_range"),
            F.lit(agree).alias("metrics_agree"),
        )


for _number, _name in enumerate(EXPERIMENTS, 3):
    _experiment_query(_number, _name)
    _experiment_checks(_number, _name)


TREE = B.Boosting(trees=1, depth=2, rate=1.0, l2=1.0, min_hessian=1.0, start=False)


def _histogram_sql(level: int, parent: str) -> str:
    """CTEs with the best split of every node of a level, from sums per node, feature and bin.

    Before any tree every probability is one half: a row's gradient is 0.5 - y and its hessian 0.25.
    """
    return f"""hist{level} AS (
        SELECT path, no, feature, bin, upper, sum(0.5 - y) AS g, sum(0.25) AS h, count(*) AS n
        FROM {parent} JOIN binned USING (udi) GROUP BY ALL),
    cuts{level} AS (
        SELECT path, no, feature, bin, upper, sum(g) OVER w::DOUBLE AS gl, sum(h) OVER w::DOUBLE AS hl, sum(n) OVER w AS nl,
            sum(g) OVER p::DOUBLE AS gt, sum(h) OVER p::DOUBLE AS ht, sum(n) OVER p AS nt
        FROM hist{level} WINDOW w AS (PARTITION BY path, feature ORDER BY bin), p AS (PARTITION BY path, feature)),
    split{level} AS (
        SELECT *, 0.5::DOUBLE * (gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) AS gain
        FROM cuts{level} WHERE least(hl, ht - hl) >= 1
        QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, no, bin) = 1),
    at{level} AS (
        SELECT r.udi, r.path || CASE WHEN b.bin <= s.bin THEN 'L' ELSE 'R' END AS path
        FROM {parent} r JOIN split{level} s ON r.path = s.path AND s.gain > 0 JOIN binned b ON r.udi = b.udi AND s.feature = b.feature)"""


def _tree_sql() -> str:
    values = " UNION ALL ".join(
        f"SELECT udi, machine_failure AS y, {i} AS no, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM newest" for i, c in enumerate(S.NUMERIC_FEATURES)
    )
    nodes = " UNION ALL ".join(f"SELECT udi, path FROM {t}" for t in ("root", "at0", "at1"))
    splits = " UNION ALL ".join(f"SELECT path, feature, upper, gain FROM split{i} WHERE gain > 0" for i in (0, 1))
    body = f"""SELECT path, feature, round(upper, 6) AS threshold, round(gain, 6) AS gain, row_count, round(value, 6) AS value
        FROM (SELECT path, count(*) AS row_count, -(sum(0.5 - machine_failure) / (sum(0.25) + 1))::DOUBLE AS value
            FROM ({nodes}) JOIN newest USING (udi) GROUP BY path)
        LEFT JOIN ({splits}) USING (path)"""
    return Q.with_training(
        body,
        f"newest AS (SELECT * FROM featured ORDER BY udi DESC LIMIT {S.TRAINING_WINDOW})",
        f"valued AS ({values})",
        f"""steps AS (SELECT feature, v, floor((sum(count(*)) OVER w - count(*)) * {B.BINS} / sum(count(*)) OVER (PARTITION BY feature)) AS bin
            FROM valued GROUP BY feature, v WINDOW w AS (PARTITION BY feature ORDER BY v))""",
        "binned AS (SELECT udi, y, no, feature, bin, max(v) OVER (PARTITION BY feature, bin) AS upper FROM valued JOIN steps USING (feature, v))",
        "root AS (SELECT udi, '' AS path FROM newest)",
        _histogram_sql(0, "root"),
        _histogram_sql(1, "at0"),
    )


@query("m3_boosted_tree", _tree_sql())
def m3_tree(spark, sf):
    """Splits, gains and leaf values of a first tree of two levels on the failure target."""
    rows = engineer_features(training_window(A.training(spark, sf)))
    rows = rows.select(F.col("udi").alias("key"), F.col("machine_failure").alias("label"), F.lit(0).alias("fold"), *S.NUMERIC_FEATURES)
    cuts = B.cut_points(rows, S.NUMERIC_FEATURES)
    tree = B.boost(rows, S.NUMERIC_FEATURES, [TREE], cuts)[0].rounds[0][0]
    schema = "path string, feature string, threshold double, gain double, row_count long, value double"
    out = spark.createDataFrame(B.tree_rows(tree, S.NUMERIC_FEATURES, cuts), schema)
    return out.withColumns({c: F.round(c, 6) for c in ("threshold", "gain", "value")})


@query("m15_training_run")
def m15(spark, sf):
    """Metrics and parameters of a run, as maps."""
    result = trained(spark, sf, "xgb_binary")
    row = {k: float(v) for k, v in result.metrics.items() if isinstance(v, float)}
    schema = "experiment string, metrics map<string,double>, params map<string,string>, scored_rows long"
    params = {k: str(v) for k, v in result.params.items()}
    return spark.createDataFrame([("xgb_binary", row, params, result.scored.count())], schema)


@query("m16_calibrated_probabilities")
def m16(spark, sf):
    """Per predicted class: rows and the range of the probability total, which is 1."""
    scored = trained(spark, sf, "rf_multiclass").scored
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    return scored.groupBy("prediction").agg(
        F.count("*").alias("rows_called"), F.round(F.min(total), 9).alias("least_total"), F.round(F.max(total), 9).alias("greatest_total")
    )


@query("m17_parameter_search")
def m17(spark, sf):
    rows = training_window(A.training(spark, sf))
    return MM.tune_model(rows, EXPERIMENTS["xgb_binary"])[1]


@query("m18_early_stopping")
def m18(spark, sf):
    """Rounds grown and kept when each of three folds in turn decides when boosting has gained nothing for 20 rounds."""
    experiment = EXPERIMENTS["lgbm_binary"]
    train = with_folds(MM.prepare(training_window(A.training(spark, sf)), experiment).where("NOT is_test"), "label", S.CALIBRATION_FOLDS)
    vectors = MM.feature_pipeline(scale=False).fit(train).transform(train)
    ensembles = MM.boosted_by_fold(experiment, experiment.params("full"), vectors, patience=20)
    rows = [(f, e.grown, e.kept, float(min(e.losses)), float(e.losses[-1])) for f, e in enumerate(ensembles)]
    return spark.createDataFrame(rows, "fold int, rounds_grown int, rounds_kept int, least_loss double, last_loss double")


@query("m19_train_with_best")
def m19(spark, sf):
    rows = training_window(A.training(spark, sf), window_of("m19_train_with_best"))
    experiment = EXPERIMENTS["lgbm_binary"]
    best, _ = MM.tune_model(rows, experiment)
    result = MM.train_model(rows, experiment, overrides=best)
    return MM.measure(result.scored, experiment).withColumn("params", F.lit(str(sorted(best.items()))))


@query("m20_batch_scoring")
def m20(spark, sf):
    """Readings of every request, scored in place."""
    reg = registry(spark, sf)
    gate, version, _ = MM.load_production(reg, BINARY_MODEL)
    detail, _, _ = MM.load_production(reg, MULTICLASS_MODEL)
    rows, _ = parse_requests(request_payloads(spark, sf))
    scored = gate_and_detail(with_model_features(rows), gate, detail)
    return scored.select(
        "request_id", "position", "machine_failure", "failure_probability", "failure_type", F.lit(version).alias("model_version")
    )


def _consistent():
    """A type only with a failure, and a probability between 0 and 1."""
    typed = F.col("failure_type").isNull() | (F.col("machine_failure") == 1)
    return (typed & F.col("failure_probability").between(0, 1)).alias("consistent")


@query("m20_batch_scoring_checks", Q.with_readings("SELECT request_id, position, true AS consistent FROM requests", REQUEST_SQL))
def m20_checks(spark, sf):
    return m20(spark, sf).select("request_id", "position", _consistent())


@query(
    "a7_ordered_answers",
    Q.with_readings(
        """SELECT request_id, count(*) AS total_readings, string_agg(position::VARCHAR, ',' ORDER BY position) AS positions
        FROM requests GROUP BY request_id""",
        REQUEST_SQL,
    ),
)
def ordered(spark, sf):
    """Every request's predictions, by the fixed rule, as one list in the order of its readings."""
    rows, _ = parse_requests(request_payloads(spark, sf))
    failed = (A.rule_percent("machine_type") > 50).cast("int")
    scored = rows.select(
        "request_id", "position", failed.alias("machine_failure"), (A.rule_percent("machine_type") / 100).alias("failure_probability"),
        gated_failure_type(failed, A.rule_type("machine_type")).alias("failure_type"),
    )
    answers = ordered_answers(scored, "request_id", "position")
    places = F.transform("predictions", lambda p: p["position"].cast("string"))
    return answers.select("request_id", "total_readings", F.array_join(places, ",").alias("positions"))


@query("m20_batch_scoring_totals")
def m20_totals(spark, sf):
    return batch_totals(m20(spark, sf), "request_id")


@query("m21_single_scoring")
def m21(spark, sf):
    """Readings scored with the gate only: the type stays unknown."""
    gate, _, _ = MM.load_production(registry(spark, sf), BINARY_MODEL)
    scored = gate_and_detail(with_model_features(A.readings(spark, sf)), gate)
    return scored.select("id", "machine_failure", "failure_probability", "failure_type")


@query("m21_single_scoring_checks", Q.with_readings("SELECT id, true AS consistent FROM readings"))
def m21_checks(spark, sf):
    return m21(spark, sf).select("id", (_consistent() & F.col("failure_type").isNull()).alias("consistent"))


@query(
    "s14_register_model_checks",
    f"SELECT unnest(['{BINARY_MODEL}', '{MULTICLASS_MODEL}']) AS model_name, 1::BIGINT AS versions, 0::BIGINT AS without_metrics",
)
def s14_checks(spark, sf):
    rows = s14(spark, sf).groupBy("model_name")
    return rows.agg(F.count("*").alias("versions"), F.count_if(F.size("metrics") == 0).alias("without_metrics"))


@query("s14_register_model")
def s14(spark, sf):
    reg = registry(spark, sf)
    return reg.versions().join(reg.runs().select("run_id", "metrics", "params"), "run_id").select(
        "model_name", "version", "metrics", "params", "description"
    )


@query("s15_load_production")
def s15(spark, sf):
    """The stored models score like the ones that were saved."""
    reg = registry(spark, sf)
    rows = engineer_features(A.training(spark, sf))
    out = None
    for model_name, name in ((BINARY_MODEL, "rf_binary"), (MULTICLASS_MODEL, "rf_multiclass")):
        model, version, f1 = MM.load_production(reg, model_name)
        first = trained(spark, sf, name).scored.select("udi", "prediction")
        # Only the rows that were scored then are scored again.
        wanted = materialise(rows.join(F.broadcast(first.select("udi")), "udi"), "wanted")
        again = model.transform(wanted).select("udi", F.col("prediction").alias("again"))
        same = first.join(again, "udi").groupBy("prediction").agg(
            F.count("*").alias("row_count"), F.count_if(F.col("prediction") == F.col("again")).alias("equal")
        )
        same = same.withColumns({"model_name": F.lit(model_name), "version": F.lit(version), "f1_test": F.lit(f1)})
        out = same if out is None else out.union(same)
    return out


@query(
    "s15_load_production_checks",
    Q.with_training(
        f"""SELECT unnest(['{BINARY_MODEL}', '{MULTICLASS_MODEL}']) AS model_name,
        (SELECT least(count(*), {S.TRAINING_WINDOW}) FROM training) AS row_count, 0::BIGINT AS unequal"""
    ),
)
def s15_checks(spark, sf):
    """A stored model calls every row as the one that was saved."""
    rows = s15(spark, sf).groupBy("model_name")
    return rows.agg(F.sum("row_count").alias("row_count"), F.sum(F.col("row_count") - F.col("equal")).alias("unequal"))


@query("e3_retrain_and_promote")
def e3(spark, sf):
    space = jobs.Workspace(spark, new_path(spark, "space"))
    space.training.seed(A.training(spark, sf))
    decision = jobs.retrain(space, EXPERIMENTS["rf_binary"])
    reg = Registry(spark, space.registry_root)
    held = reg.aliases().select("model_name", F.col("version").alias("production_version"))
    return held.withColumns({"outcome": F.lit(decision["outcome"]), "training_rows": F.lit(space.training.training().count())})
