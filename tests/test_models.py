import pytest
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features
from toolpulse.operators import models as MM
from toolpulse.operators import scoring
from toolpulse.operators.experiments import EXPERIMENTS
from toolpulse.operators.registry import Registry

TINY = {
    "xgboost": {"trees": 1, "depth": 2},
    "lightgbm": {"trees": 1, "depth": 2, "min_rows": 1},
    "random_forest": {"trees": 2, "depth": 3},
    "logreg": {"iterations": 5},
    "svm": {"iterations": 3, "components": 8},
    "mlp": {"hidden": "4", "iterations": 5},
}


@pytest.fixture(scope="module")
def runs(training):
    cache = {}

    def run(name):
        if name not in cache:
            experiment = EXPERIMENTS[name]
            cache[name] = MM.train_model(training, experiment, "fast", TINY[experiment.family])
        return cache[name]

    return run


@pytest.mark.parametrize("name", list(EXPERIMENTS))
def test_every_experiment_trains_calibrated(runs, name):
    result = runs(name)
    metrics = result.metrics
    assert 0.0 <= metrics["brier_score"] <= 1.0
    assert 0.0 <= metrics["f1_test"] <= 1.0
    assert ("roc_auc_test" in metrics) == name.endswith("binary")
    assert len(result.model.sigmoids) == S.CALIBRATION_FOLDS
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    worst = result.scored.agg(F.max(F.abs(total - 1)).alias("gap"), F.min(F.array_min("probability")).alias("low")).first()
    assert worst["gap"] < 1e-9 and worst["low"] >= 0.0
    assert result.scored.count() == 75


def test_full_presets_hold_reference_parameters(spark):
    xgb = EXPERIMENTS["xgb_binary"]
    assert xgb.params("full") == {
        "trees": 155, "depth": 8, "rate": 0.0856, "min_hessian": 1, "l2": 0.2413, "row_share": 0.6472, "column_share": 0.9604, "curvature": 2.0
    }
    run = xgb.build(xgb.params("full"), 100)
    assert (run.trees, run.depth, run.rate, run.l2, run.row_share, run.column_share) == (155, 8, 0.0856, 0.2413, 0.6472, 0.9604)
    assert EXPERIMENTS["lgbm_multiclass"].build(EXPERIMENTS["lgbm_multiclass"].params("full"), 100).l2 == 2.0
    for experiment in EXPERIMENTS.values():
        params = {**experiment.params("full"), "inputs": 11, "outputs": experiment.classes}
        assert experiment.build(params, 1000) is not None


def test_unseen_type_encodes_to_zeros(training):
    df = engineer_features(training)
    fitted = MM.feature_pipeline(scale=False).fit(df)
    odd = fitted.transform(df.limit(1).withColumn("type", F.lit("Z")))
    vector = odd.select("features").first()[0]
    assert list(vector.toArray()[:3]) == [0.0, 0.0, 0.0] and len(vector) == 11


def test_sigmoid_fit_matches_dense_newton(spark):
    """Two groups against a direct minimisation of the same loss on a grid around the optimum."""
    import numpy as np

    rows = [(g, s / 10.0 - 1.0 + g, p, n) for g in (0, 1) for s, p, n in [(0, 1, 9), (5, 3, 6), (10, 5, 5), (15, 8, 2), (20, 9, 1)]]
    df = spark.createDataFrame(rows, "g int, score double, pos long, neg long")
    pairs = MM.fit_sigmoids(df, 2)
    for g, (a, b) in enumerate(pairs):
        mine = [r for r in rows if r[0] == g]
        pos, neg = sum(r[2] for r in mine), sum(r[3] for r in mine)
        hi, lo = (pos + 1) / (pos + 2), 1 / (neg + 2)

        def loss(a, b):
            return sum((p * hi + n * lo) * (a * s + b) + (p + n) * np.log1p(np.exp(-(a * s + b))) for _, s, p, n in mine)

        best = loss(a, b)
        assert all(loss(a + da, b + db) >= best - 1e-7 for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))
        assert a < 0  # higher scores, higher probability


def test_saved_model_scores_the_same(spark, runs, training, tmp_path):
    for name in ("svm_multiclass", "xgb_binary"):
        model = runs(name).model
        model.save(spark, f"{tmp_path}/{name}")
        again = MM.FailureModel.load(spark, f"{tmp_path}/{name}")
        df = engineer_features(training)
        a = {r["udi"]: r["probability"] for r in model.transform(df).collect()}
        b = {r["udi"]: r["probability"] for r in again.transform(df).collect()}
        assert all(a[k] == pytest.approx(b[k]) for k in a)


class Fixed:
    """Stands in for a fitted model with a constant answer."""

    def __init__(self, prediction, probability):
        self.prediction, self.probability = prediction, probability

    def transform(self, df, prefix=""):
        return df.withColumn(f"{prefix}prediction", F.lit(self.prediction)).withColumn(
            f"{prefix}probability", F.array(*[F.lit(p) for p in self.probability])
        )


@pytest.mark.parametrize(
    "gate, detail, failure, kind",
    [
        (Fixed(0, [0.9, 0.1]), Fixed(2, [0.0]), 0, None),
        (Fixed(1, [0.1, 0.9]), Fixed(2, [0.0]), 1, "osf"),
        (Fixed(1, [0.1, 0.9]), Fixed(1, [0.0]), 1, None),
        (Fixed(1, [0.1, 0.9]), None, 1, None),
    ],
)
def test_gate_and_detail(training, gate, detail, failure, kind):
    row = scoring.gate_and_detail(engineer_features(training), gate, detail).first()
    assert (row["machine_failure"], row["failure_type"]) == (failure, kind)
    assert row["failure_probability"] == gate.probability[1]


def test_scoring_needs_a_gate(training):
    with pytest.raises(ValueError):
        scoring.gate_and_detail(training, None)


def test_search_needs_a_space(training):
    with pytest.raises(ValueError):
        MM.tune_model(training, EXPERIMENTS["rf_binary"])


def test_search_starts_from_the_known_point(training):
    limits = {"trees": 1, "depth": 2}
    best, table = MM.tune_model(training, EXPERIMENTS["xgb_binary"], n_trials=1, preset="fast", limits=limits)
    assert best["rate"] == 0.0856 and best["trees"] == 1
    assert [(r["trial"], r["folds"]) for r in table.collect()] == [(0, 5)]


def test_registered_model_loads_by_alias(spark, runs, tmp_path):
    reg = Registry(spark, str(tmp_path))
    experiment = EXPERIMENTS["rf_binary"]
    version = MM.register_model(reg, experiment, runs("rf_binary"))
    assert MM.load_production(reg, experiment.model_name) is None
    reg.set_alias(experiment.model_name, version)
    model, held, f1 = MM.load_production(reg, experiment.model_name)
    assert held == "1" and f1 == pytest.approx(runs("rf_binary").metrics["f1_test"]) and model.classes == 2
