"""The twelve experiments: six model families, each for failure yes/no and for failure type."""

import random
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)

from toolpulse import schemas as S
from toolpulse.operators.boosting import Boosting

BINARY_MODEL = "machine-failure-binary"
MULTICLASS_MODEL = "machine-failure-multiclass"
SEED = S.SPLIT_SEED


@dataclass(frozen=True)
class Experiment:
    """One entry of the registry.

    ``build(params, rows)`` returns an untrained classifier, or the settings of
    a boosted ensemble; ``rows`` is the
    training row count, which turns per-row penalties into Spark's averaged
    ones. A ``one_vs_rest`` experiment trains one such classifier per class.
    """

    name: str
    family: str
    target_type: str
    build: Callable[[dict, int], object]
    full: dict
    fast: dict
    weighting: str = "none"  # none, ratio (positives count negatives/positives times) or balanced
    score: str = "probability"  # which output is calibrated
    one_vs_rest: bool = False
    needs_scaling: bool = False
    fourier: bool = False
    space: dict = field(default_factory=dict)
    warm_start: dict | None = None
    early_stopping: bool = False

    @property
    def classes(self) -> int:
        return 2 if self.target_type == "binary" else len(S.FAILURE_CLASSES)

    @property
    def boosted(self) -> bool:
        return self.build is boosted_trees

    @property
    def target(self) -> str:
        return "machine_failure" if self.target_type == "binary" else "failure_class"

    @property
    def average(self) -> str:
        return "binary" if self.target_type == "binary" else "macro"

    @property
    def model_name(self) -> str:
        return BINARY_MODEL if self.target_type == "binary" else MULTICLASS_MODEL

    def params(self, preset: str, overrides: dict | None = None) -> dict:
        return {**(self.full if preset == "full" else self.fast), **(overrides or {})}

    def sample(self, rng: random.Random) -> dict:
        """One random point of the search space."""
        out = {}
        for name, (kind, *bounds) in self.space.items():
            if kind == "int":
                out[name] = rng.randint(*bounds)
            elif kind == "float":
                out[name] = rng.uniform(*bounds)
            elif kind == "log":
                low, high = bounds
                out[name] = low * (high / low) ** rng.random()
            else:
                out[name] = rng.choice(bounds[0])
        return out


def boosted_trees(p: dict, rows: int) -> Boosting:
    """Settings of the boosted ensembles; classes, weights and folds are set where they are trained."""
    return Boosting(
        trees=p["trees"], depth=p["depth"], rate=p["rate"], l2=p["l2"], min_hessian=p["min_hessian"], min_rows=p.get("min_rows", 1),
        row_share=p.get("row_share", 1.0), column_share=p.get("column_share", 1.0), max_leaves=p.get("max_leaves"),
        curvature=p["curvature"], seed=SEED,
    )


def random_forest(p: dict, rows: int):
    return RandomForestClassifier(
        numTrees=p["trees"], maxDepth=p["depth"], featureSubsetStrategy="sqrt", seed=SEED
    )


def logistic(p: dict, rows: int):
    return LogisticRegression(
        maxIter=p["iterations"], regParam=1.0 / (p.get("C", 1.0) * max(rows, 1)), standardization=False
    )


def margin(p: dict, rows: int):
    """A linear margin on random Fourier features stands in for the RBF kernel."""
    return LinearSVC(maxIter=p["iterations"], regParam=1.0 / (p.get("C", 1.0) * max(rows, 1)), standardization=False)


def perceptron(p: dict, rows: int):
    """Sigmoid hidden layers; Spark's network has no activation choice, penalty or early stop.

    A learning rate means gradient descent; the default solver has none.
    """
    hidden = [int(w) for w in str(p["hidden"]).split("_")]
    network = MultilayerPerceptronClassifier(
        layers=[p["inputs"], *hidden, p["outputs"]], maxIter=p["iterations"], seed=SEED
    )
    return network.setSolver("gd").setStepSize(p["rate"]) if "rate" in p else network


# Tuned and default parameters and search ranges of each experiment.
XGB = {"min_hessian": 1, "l2": 1.0, "curvature": 2.0}
XGB_TUNED = {**XGB, "trees": 155, "depth": 8, "rate": 0.0856, "min_hessian": 1, "l2": 0.2413, "row_share": 0.6472, "column_share": 0.9604}
XGB_SPACE = {
    "trees": ("int", 100, 500),
    "depth": ("int", 2, 12),
    "rate": ("log", 0.01, 0.3),
    "min_hessian": ("int", 1, 20),
    "l2": ("log", 0.001, 10.0),
    "row_share": ("float", 0.5, 1.0),
    "column_share": ("float", 0.5, 1.0),
}
XGB_MULTI = {**XGB, "trees": 200, "depth": 6, "rate": 0.3}
LGBM = {"min_hessian": 0.001, "l2": 0.0, "max_leaves": 31, "curvature": 1.25}
LGBM_BINARY = {**LGBM, "trees": 200, "depth": 4, "rate": 0.1, "min_rows": 20}
LGBM_BINARY_SPACE = {
    "trees": ("int", 100, 500),
    "depth": ("int", 2, 8),
    "rate": ("log", 0.01, 0.3),
    "min_rows": ("int", 10, 100),
    "l2": ("log", 0.001, 10.0),
    "patience": ("int", 20, 50),
}
LGBM_MULTI = {**LGBM, "trees": 200, "depth": 3, "rate": 0.1, "min_rows": 30, "l2": 2.0}
LGBM_MULTI_SPACE = {
    "trees": ("int", 100, 500),
    "depth": ("int", 2, 6),
    "rate": ("log", 0.01, 0.3),
    "min_rows": ("int", 20, 150),
    "l2": ("log", 0.001, 10.0),
    "patience": ("int", 20, 50),
}
FOREST = {"trees": 100, "depth": 30}
LOGISTIC = {"iterations": 1000}
SVM_SPACE = {"C": ("log", 0.01, 100.0), "gamma": ("choice", ["scale", "auto"])}
MLP = {"hidden": "128_64", "iterations": 300}
MLP_SPACE = {"hidden": ("choice", ["64", "128", "64_32", "128_64"]), "rate": ("log", 0.0001, 0.01)}

FAST_XGB = {**XGB, "trees": 2, "depth": 3, "rate": 0.3}
FAST_LGBM = {**LGBM, "trees": 2, "depth": 3, "rate": 0.3}
FAST_FOREST = {"trees": 8, "depth": 5}
FAST_SVM = {"iterations": 10, "components": 32, "gamma": "scale"}
SVM = {"iterations": 100, "components": 256, "gamma": "scale"}

EXPERIMENTS = {
    e.name: e
    for e in [
        Experiment("xgb_binary", "xgboost", "binary", boosted_trees, XGB_TUNED, FAST_XGB, weighting="ratio",
                   space=XGB_SPACE, warm_start=XGB_TUNED),
        Experiment("xgb_multiclass", "xgboost", "multiclass", boosted_trees, XGB_MULTI, FAST_XGB,
                   space={**XGB_SPACE, "depth": ("int", 2, 6)}),
        Experiment("lgbm_binary", "lightgbm", "binary", boosted_trees, LGBM_BINARY, FAST_LGBM, weighting="ratio",
                   space=LGBM_BINARY_SPACE, early_stopping=True),
        Experiment("lgbm_multiclass", "lightgbm", "multiclass", boosted_trees, LGBM_MULTI, FAST_LGBM,
                   space=LGBM_MULTI_SPACE, early_stopping=True),
        Experiment("rf_binary", "random_forest", "binary", random_forest, FOREST, FAST_FOREST, weighting="balanced"),
        Experiment("rf_multiclass", "random_forest", "multiclass", random_forest, FOREST, FAST_FOREST, weighting="balanced"),
        Experiment("logreg_binary", "logreg", "binary", logistic, LOGISTIC, {"iterations": 20}, weighting="balanced",
                   score="rawPrediction"),
        Experiment("logreg_multiclass", "logreg", "multiclass", logistic, LOGISTIC, {"iterations": 20},
                   weighting="balanced", score="rawPrediction"),
        Experiment("svm_binary", "svm", "binary", margin, SVM, FAST_SVM, weighting="balanced", score="rawPrediction",
                   needs_scaling=True, fourier=True, space=SVM_SPACE),
        Experiment("svm_multiclass", "svm", "multiclass", margin, SVM, FAST_SVM, weighting="balanced",
                   score="rawPrediction", one_vs_rest=True, needs_scaling=True, fourier=True, space=SVM_SPACE),
        Experiment("mlp_binary", "mlp", "binary", perceptron, MLP, {"hidden": "8", "iterations": 15}, needs_scaling=True,
                   space=MLP_SPACE),
        Experiment("mlp_multiclass", "mlp", "multiclass", perceptron, MLP, {"hidden": "8", "iterations": 15},
                   needs_scaling=True, space=MLP_SPACE),
    ]
}
