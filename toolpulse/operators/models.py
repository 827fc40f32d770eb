"""Training, calibration, tuning and storage of failure models."""

import json
import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_
from threading import BoundedSemaphore

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features, feature_frame
from toolpulse.functions.labels import label_training_rows
from toolpulse.operators import metrics as M
from toolpulse.operators.boosting import BoostedTrees, Boosting, Ensemble, boost, cut_points
from toolpulse.operators.experiments import Experiment
from toolpulse.operators.registry import Registry
from toolpulse.operators.splits import with_folds, with_test_flag
from toolpulse.sources.durable import materialise

PARALLEL_FITS = 4
# Folds and classes are fitted by pools within pools; each fit sends the driver many small jobs and keeps its rows again.
_fitting = BoundedSemaphore(PARALLEL_FITS)
# Rows of a training split that one task of a fit takes, and the most tasks until rows are many.
ROWS_PER_FIT_TASK = 4_000
FEW_FIT_TASKS = 4
MANY_ROWS_PER_FIT_TASK = 200_000


# --- feature vectors ----------------------------------------------------------------


def feature_pipeline(scale: bool) -> Pipeline:
    """One-hot type plus numeric features. A type not seen in training becomes all zeros."""
    stages = [
        StringIndexer(inputCol="type", outputCol="type_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=["type_index"], outputCols=["type_vector"], dropLast=True),
        VectorAssembler(inputCols=["type_vector", *S.NUMERIC_FEATURES], outputCol="assembled" if scale else "features"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=stages)


@dataclass
class FourierMap:
    """Random features whose inner products approximate an RBF kernel."""

    inputs: int
    components: int
    gamma: float
    seed: int = S.SPLIT_SEED

    def apply(self, df: DataFrame) -> DataFrame:
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(0.0, math.sqrt(2.0 * self.gamma), (self.inputs, self.components))
        phases = rng.uniform(0.0, 2.0 * math.pi, self.components)
        size = math.sqrt(2.0 / self.components)

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if rows.empty:
                return pd.Series([], dtype=object)
            return pd.Series(list(size * np.cos(np.vstack(rows.to_numpy()) @ directions + phases)))

        return df.withColumn("features", array_to_vector(project(vector_to_array("features"))))


def kernel_width(setting, inputs: int) -> float:
    """Scaled inputs have variance 1, so both named settings are 1 / inputs."""
    return 1.0 / inputs if isinstance(setting, str) else float(setting)


# --- a fitted, calibrated model -----------------------------------------------------


@dataclass
class FailureModel:
    """Feature pipeline and calibrated members; probabilities are the members' mean."""

    features: PipelineModel
    fourier: FourierMap | None
    score: str
    classes: int
    members: list[PipelineModel | BoostedTrees]  # stages: one model, or one per class
    sigmoids: list[list[tuple[float, float]]]  # per member, per calibrated class

    def vectors(self, df: DataFrame) -> DataFrame:
        out = self.features.transform(df).drop("type_index", "type_vector", "assembled")
        return self.fourier.apply(out) if self.fourier else out

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Adds ``<prefix>probability`` (array in class order) and ``<prefix>prediction``."""
        out = self.vectors(df)
        for i, member in enumerate(self.members):
            out = member_scores(out, member, self.score, self.classes, f"__s{i}")
        each = [calibrated(F.col(f"__s{i}"), s, self.classes) for i, s in enumerate(self.sigmoids)]
        mean = F.array(*[sum((p[c] for p in each[1:]), each[0][c]) / F.lit(float(len(each))) for c in range(self.classes)])
        out = out.withColumn(f"{prefix}probability", mean).drop("features", *[f"__s{i}" for i in range(len(each))])
        p = F.col(f"{prefix}probability")
        best = F.array_position(p, F.array_max(p)) - 1  # the first of equals
        return out.withColumn(f"{prefix}prediction", best.cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.features.write().save(f"{path}/features")
        for i, member in enumerate(self.members):
            if isinstance(member, BoostedTrees):
                member.save(spark, f"{path}/member-{i}")
            else:
                member.write().save(f"{path}/member-{i}")
        f = self.fourier
        meta = {
            "score": self.score,
            "classes": self.classes,
            "sigmoids": self.sigmoids,
            "boosted": isinstance(self.members[0], BoostedTrees),
            "fourier": [f.inputs, f.components, f.gamma, f.seed] if f else None,
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FailureModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        return cls(
            features=PipelineModel.load(f"{path}/features"),
            fourier=FourierMap(*meta["fourier"]) if meta["fourier"] else None,
            score=meta["score"],
            classes=meta["classes"],
            members=[
                BoostedTrees.load(spark, f"{path}/member-{i}") if meta["boosted"] else PipelineModel.load(f"{path}/member-{i}")
                for i in range(len(meta["sigmoids"]))
            ],
            sigmoids=[[tuple(ab) for ab in member] for member in meta["sigmoids"]],
        )


def member_scores(df: DataFrame, member: PipelineModel | BoostedTrees, score: str, classes: int, name: str) -> DataFrame:
    """Adds the scores to calibrate as an array: class 1 only for two classes, else all."""
    if isinstance(member, BoostedTrees):
        return member.with_scores(df, name)
    outputs = ["rawPrediction", "probability", "prediction"]
    if len(member.stages) == 1:
        out = member.transform(df)
        values = vector_to_array(score)
        values = F.array(values[1]) if classes == 2 else values
        return out.withColumn(name, values).drop(*outputs)
    parts = []
    for c, model in enumerate(member.stages):
        df = model.transform(df).withColumn(f"{name}_{c}", vector_to_array(score)[1]).drop(*outputs)
        parts.append(f"{name}_{c}")
    return df.withColumn(name, F.array(*parts)).drop(*parts)


def calibrated(scores: Column, sigmoids: list[tuple[float, float]], classes: int) -> list[Column]:
    """Class probabilities of one member from its scores."""
    raw = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(a) * scores[i] + F.lit(b))) for i, (a, b) in enumerate(sigmoids)]
    if classes == 2:
        return [F.lit(1.0) - raw[0], raw[0]]
    total = sum(raw[1:], raw[0])
    return [F.coalesce(F.try_divide(r, total), F.lit(1.0 / classes)) for r in raw]


# --- fitting ------------------------------------------------------------------------


def class_weights(experiment: Experiment, sizes: dict[int, int]) -> dict[int, float]:
    """Row weight by class from the class sizes of the training rows; 1 where none is given."""
    total, present = sum(sizes.values()), len(sizes)
    if experiment.weighting == "balanced":
        weights = {c: total / (present * n) for c, n in sizes.items()}
    elif experiment.weighting == "ratio":
        weights = {1: sizes.get(0, 0) / sizes[1]} if sizes.get(1) else {}
    else:
        weights = {}
    return weights


def weight_column(experiment: Experiment, sizes: dict[int, int]) -> Column:
    chain = F.lit(1.0)
    for c, w in class_weights(experiment, sizes).items():
        chain = F.when(F.col("label") == c, F.lit(float(w))).otherwise(chain)
    return chain


def dealt(rows: DataFrame, key: str = "udi") -> DataFrame:
    """The rows spread over the tasks of a fit, the same way and in the same order on any cluster.

    A window of newest rows comes from one sort and would be trained on by one task.
    """
    total = rows.count()
    tasks = max(1, min(FEW_FIT_TASKS, math.ceil(total / ROWS_PER_FIT_TASK)), math.ceil(total / MANY_ROWS_PER_FIT_TASK))
    return rows.repartition(tasks, key).sortWithinPartitions(key)


def class_sizes(rows: DataFrame) -> dict[int, int]:
    return {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}


def fit_member(experiment: Experiment, params: dict, rows: DataFrame, weigh_by: dict[int, int] | None = None) -> PipelineModel:
    """Train on ``features, label``; one classifier, or one per class.

    Weights come from the class sizes ``weigh_by``, by default those of the rows.
    """
    sizes = class_sizes(rows)
    rows = rows.withColumn("weight", weight_column(experiment, weigh_by or sizes))
    total = sum(sizes.values())

    def fit(label: str, frame: DataFrame):
        classifier = experiment.build(params, total)
        classifier.setFeaturesCol("features").setLabelCol(label)
        if experiment.weighting != "none":
            classifier.setWeightCol("weight")
        with _fitting:
            return classifier.fit(frame)

    if not experiment.one_vs_rest:
        return PipelineModel([fit("label", rows)])
    each = rows.withColumns({f"__is_{c}": (F.col("label") == c).cast("double") for c in range(experiment.classes)})
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return PipelineModel(list(pool.map(lambda c: fit(f"__is_{c}", each), range(experiment.classes))))


def boosting_of(experiment: Experiment, params: dict, sizes: dict[int, int], **changes) -> Boosting:
    """The settings of one ensemble with the experiment's classes and weights."""
    weights = class_weights(experiment, sizes)
    own = tuple(float(weights.get(c, 1.0)) for c in range(experiment.classes)) if weights else ()
    return replace(experiment.build(params, sum(sizes.values())), classes=experiment.classes, weights=own, **changes)


def boosting_rows(vectors: DataFrame, inputs: int) -> tuple[DataFrame, list[str]]:
    """``key, label, fold`` and one column per entry of the feature vector."""
    names = [f"f{i}" for i in range(inputs)]
    values = vectors.select(F.col("udi").alias("key"), "label", "fold", vector_to_array("features").alias("v"))
    return values.select("key", "label", "fold", *[F.col("v")[i].alias(n) for i, n in enumerate(names)]), names


def boosted_by_fold(experiment: Experiment, params: dict, rows: DataFrame, patience: int | None = None) -> list[Ensemble]:
    """One ensemble per calibration fold, each without that fold, all grown together."""
    return _by_fold(experiment, params, rows, patience)[0]


def _by_fold(experiment: Experiment, params: dict, rows: DataFrame, patience: int | None = None):
    frame, names = boosting_rows(rows, len(rows.select("features").first()[0]))
    frame = materialise(frame, "boosting")
    cuts, sizes = cut_points(frame, names), class_sizes(rows)
    runs = [boosting_of(experiment, params, sizes, held_fold=f, patience=patience) for f in range(S.CALIBRATION_FOLDS)]
    return boost(frame, names, runs, cuts), cuts


def fit_sigmoids(scored: DataFrame, groups: int, max_steps: int = 40) -> list[tuple[float, float]]:
    """Platt's two parameters for every group at once, by damped Newton steps.

    ``scored`` is ``g, score, pos, neg``: counts per group number and distinct
    score. One small aggregation per step serves all groups.
    """
    sizes = {r["g"]: (r["p"], r["n"]) for r in scored.groupBy("g").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect()}
    at, step, best, high, low = {}, {}, {}, {}, {}
    for g in range(groups):
        pos, neg = sizes.get(g, (0, 0))
        high[g], low[g] = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)
        at[g], step[g], best[g] = (0.0, math.log((neg + 1.0) / (pos + 1.0))), (0.0, 0.0), math.inf
    active = set(sizes)

    def by_group(values: dict) -> Column:
        return F.element_at(F.array(*[F.lit(float(values[g])) for g in range(groups)]), F.col("g") + 1)

    for _ in range(max_steps):
        a, b = by_group({g: at[g][0] for g in at}), by_group({g: at[g][1] for g in at})
        f, n = F.col("score"), F.col("pos") + F.col("neg")
        z = a * f + b
        # log(1 + exp(-z)) and 1 / (1 + exp(z)) without overflow
        softplus = F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        p = F.when(z > 0, F.exp(-z) / (F.lit(1.0) + F.exp(-z))).otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(z)))
        target = F.col("pos") * by_group(high) + F.col("neg") * by_group(low)
        slope, curve = target - n * p, n * p * (F.lit(1.0) - p)
        sums = scored.where(F.col("g").isin(sorted(active))).groupBy("g").agg(
            F.sum(target * z + n * softplus).alias("loss"),
            F.sum(f * slope).alias("ga"), F.sum(slope).alias("gb"),
            F.sum(f * f * curve).alias("haa"), F.sum(f * curve).alias("hab"), F.sum(curve).alias("hbb"),
        )
        for r in sums.collect():
            g = r["g"]
            if r["loss"] > best[g] + 1e-12 * abs(best[g]):  # too far: half the step back
                step[g] = (step[g][0] / 2.0, step[g][1] / 2.0)
                at[g] = (at[g][0] - step[g][0], at[g][1] - step[g][1])
                if max(abs(s) for s in step[g]) < 1e-10:
                    active.discard(g)
                continue
            gain, best[g] = best[g] - r["loss"], r["loss"]
            ridge = 1e-12 * (1.0 + r["haa"])
            haa, hab, hbb = r["haa"] + ridge, r["hab"], r["hbb"] + 1e-12
            det = haa * hbb - hab * hab
            if gain < 1e-9 * (1.0 + abs(best[g])) or det <= 0 or max(abs(r["ga"]), abs(r["gb"])) < 1e-5:
                active.discard(g)
                continue
            step[g] = (-(hbb * r["ga"] - hab * r["gb"]) / det, -(haa * r["gb"] - hab * r["ga"]) / det)
            at[g] = (at[g][0] + step[g][0], at[g][1] + step[g][1])
        if not active:
            break
    return [at[g] for g in range(groups)]


def fit_calibrated(experiment: Experiment, params: dict, rows: DataFrame) -> tuple[list[PipelineModel], list]:
    """Members and their sigmoids: each member is fitted without one fold and calibrated on it.

    ``rows`` is ``udi, features, label, fold`` and should be cached.
    """
    folds = range(S.CALIBRATION_FOLDS)
    # One weight for the whole training split, whichever fold a member leaves out.
    sizes = class_sizes(rows) if experiment.weighting == "ratio" else None
    if experiment.boosted:
        ensembles, cuts = _by_fold(experiment, params, rows)
        members = [BoostedTrees.of(e, cuts) for e in ensembles]
    else:
        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            members = list(
                pool.map(lambda f: fit_member(experiment, params, rows.where(F.col("fold") != f), weigh_by=sizes), folds)
            )
    width = 1 if experiment.classes == 2 else experiment.classes
    held_out = None
    for f, member in zip(folds, members):
        part = member_scores(rows.where(F.col("fold") == f), member, experiment.score, experiment.classes, "s")
        part = part.select(F.lit(f).alias("fold"), "label", F.posexplode("s").alias("c", "score"))
        held_out = part if held_out is None else held_out.union(part)
    hit = F.col("label") == (F.lit(1) if width == 1 else F.col("c"))
    counts = held_out.groupBy((F.col("fold") * width + F.col("c")).alias("g"), "score").agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )
    counts = materialise(counts, "calibration").persist()
    try:
        pairs = fit_sigmoids(counts, len(members) * width)
    finally:
        counts.unpersist()
    return members, [pairs[i * width : (i + 1) * width] for i in range(len(members))]


# --- training runs ------------------------------------------------------------------


def prepare(training: DataFrame, experiment: Experiment) -> DataFrame:
    """Features, target and id of the training rows, with the stratified test flag."""
    df = label_training_rows(engineer_features(training))
    df = feature_frame(df, "udi", experiment.target).withColumnRenamed(experiment.target, "label")
    return with_test_flag(df, "label")


def complete() -> Column:
    """Whether a row has every numeric feature. Others cannot be learnt from or called; a missing type is a value of its own."""
    return reduce(and_, [F.col(c).isNotNull() for c in S.NUMERIC_FEATURES])


@dataclass
class TrainingResult:
    model: FailureModel
    metrics: dict
    params: dict
    scored: DataFrame


def train_model(
    training: DataFrame, experiment: Experiment, preset: str = "full", overrides: dict | None = None
) -> TrainingResult:
    """Split, fit, calibrate and measure one experiment.

    Rows that lack a feature are split like all others and are in ``scored``, without probability and prediction.
    """
    prepared = materialise(prepare(training, experiment), "prepared")
    df, lacking = prepared.where(complete()), prepared.where(~complete())
    train = with_folds(df.where("NOT is_test"), "label", S.CALIBRATION_FOLDS)
    params = experiment.params(preset, overrides)
    features, fourier, params, vectors = _vectors(experiment, params, train)
    rows = vectors.select("udi", "features", F.col("label").cast("double").alias("label"), "fold")
    # A forest's steps are few and heavy; the many light steps of the other solvers cost more by more tasks than they gain.
    rows = (dealt(rows) if experiment.family == "random_forest" else rows).persist()
    try:
        members, sigmoids = fit_calibrated(experiment, params, rows)
    finally:
        rows.unpersist()
    model = FailureModel(features, fourier, experiment.score, experiment.classes, members, sigmoids)
    scored = model.transform(dealt(df)).select("udi", "label", "is_test", "probability", "prediction")
    if not lacking.isEmpty():
        none = [F.lit(None).cast(scored.schema[c].dataType).alias(c) for c in ("probability", "prediction")]
        scored = scored.union(lacking.select("udi", "label", "is_test", *none))
    scored = materialise(scored, "scored")
    return TrainingResult(model, measure(scored, experiment).first().asDict(), params, scored)


def _vectors(experiment: Experiment, params: dict, train: DataFrame):
    """Fit the feature pipeline; returns it, the Fourier map, the completed parameters and the rows."""
    features = feature_pipeline(experiment.needs_scaling).fit(train)
    vectors, fourier, params = _completed(experiment, params, features, features.transform(train))
    return features, fourier, params, vectors


def _completed(experiment: Experiment, params: dict, features: PipelineModel, vectors: DataFrame):
    """Vectors, Fourier map and parameters of one setting, from the plain feature vectors."""
    inputs = len(features.stages[0].labels) + len(S.NUMERIC_FEATURES)
    fourier = None
    if experiment.fourier:
        fourier = FourierMap(inputs, params["components"], kernel_width(params["gamma"], inputs))
        vectors = fourier.apply(vectors)
    if experiment.family == "mlp":
        params = {**params, "inputs": inputs, "outputs": experiment.classes}
    return vectors, fourier, params


def measure(scored: DataFrame, experiment: Experiment) -> DataFrame:
    """Metrics row of a scored frame (``label, prediction, probability, is_test``); rows without prediction do not count."""
    label = F.col("label")
    scored = scored.where("prediction IS NOT NULL")
    if experiment.target_type == "binary":
        flat = scored.withColumn("p", F.col("probability")[1])
        return M.evaluate(flat, "label", "prediction", "binary", M.brier_binary(label, F.col("p")), "p")
    return M.evaluate(scored, "label", "prediction", "macro", M.brier_multiclass(label, F.col("probability")))


def tune_model(
    training: DataFrame,
    experiment: Experiment,
    n_trials: int = 30,
    preset: str = "full",
    seed: int = S.SPLIT_SEED,
    limits: dict | None = None,
) -> tuple[dict, DataFrame]:
    """Random search by mean F1 over five stratified folds of the training split.

    The known good point, if any, is trial 0. ``limits`` fixes parameters that
    the search should not move. Returns the best parameters and the trial
    table. The test split is not looked at.
    """
    if not experiment.space:
        raise ValueError(f"{experiment.name} has no search space")
    spark = training.sparkSession
    rng = random.Random(seed)
    base = experiment.params(preset)
    trials = [dict(experiment.warm_start)] if experiment.warm_start else []
    while len(trials) < n_trials:
        trials.append(experiment.sample(rng))
    trials = [{**base, **t, **(limits or {})} for t in trials[:n_trials]]

    train = prepare(training, experiment).where("NOT is_test").where(complete())
    train = materialise(with_folds(train, "label", S.CV_FOLDS), "tuning")
    if experiment.boosted:
        return _tuned(spark, experiment, trials, _boosted_cells(experiment, trials, train))
    rows = train.withColumn("label", F.col("label").cast("double"))

    def fold_vectors(fold: int) -> tuple[PipelineModel, DataFrame]:
        """Vocabulary and scaling come from the other folds only; all trials share them."""
        features = feature_pipeline(experiment.needs_scaling).fit(rows.where(F.col("fold") != fold))
        return features, materialise(features.transform(rows).select("features", "label", "fold"), "fold-vectors")

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        prepared = list(pool.map(fold_vectors, range(S.CV_FOLDS)))

    def fold_counts(trial: int, fold: int) -> list:
        features, vectors = prepared[fold]
        vectors, _, params = _completed(experiment, trials[trial], features, vectors)
        inside = F.col("fold") == fold
        member = fit_member(experiment, params, vectors.where(~inside))
        scored = member_scores(vectors.where(inside), member, experiment.score, experiment.classes, "s")
        s = F.col("s")
        if experiment.classes == 2:
            called = (s[0] > (0.0 if experiment.score == "rawPrediction" else 0.5)).cast("int")
        else:
            called = (F.array_position(s, F.array_max(s)) - 1).cast("int")
        counts = M.confusion(scored.select("label", called.alias("called")), "label", "called")
        return [(trial, fold, int(r["truth"]), r["predicted"], r["n"]) for r in counts.collect()]

    jobs = [(t, f) for t in range(len(trials)) for f in range(S.CV_FOLDS)]
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        cells = [row for rows_ in pool.map(lambda job: fold_counts(*job), jobs) for row in rows_]
    return _tuned(spark, experiment, trials, cells)


def _boosted_cells(experiment: Experiment, trials: list[dict], train: DataFrame) -> list[tuple]:
    """(trial, fold, truth, predicted, n) of all trials and folds, grown together.

    With ``patience`` in a trial its fold decides how many trees count. Bins
    and the type vocabulary come from all training rows; labels are not looked at for them.
    """
    features = feature_pipeline(experiment.needs_scaling).fit(train)
    frame, names = boosting_rows(features.transform(train), len(features.stages[0].labels) + len(S.NUMERIC_FEATURES))
    frame = materialise(frame, "boosting")
    cuts = cut_points(frame, names)
    sizes = class_sizes(train)
    jobs = [(t, f) for t in range(len(trials)) for f in range(S.CV_FOLDS)]
    runs = [boosting_of(experiment, trials[t], sizes, held_fold=f, patience=trials[t].get("patience")) for t, f in jobs]
    cells = []
    for (t, f), ensemble in zip(jobs, boost(frame, names, runs, cuts, keep_trees=False)):
        cells += [(t, f, a, b, int(n)) for a, row in enumerate(ensemble.confusion) for b, n in enumerate(row) if n]
    return cells


def _tuned(spark: SparkSession, experiment: Experiment, trials: list[dict], cells: list[tuple]) -> tuple[dict, DataFrame]:
    counts = spark.createDataFrame(cells, "trial int, fold int, truth int, predicted int, n long")
    table = M.mean_fold_score(M.scores(counts, experiment.average, "trial", "fold"))
    best = M.best_trial(table).first()
    return trials[best["trial"]], table


def register_model(
    registry: Registry, experiment: Experiment, result: TrainingResult, extra: dict | None = None
) -> str:
    """Save the model and record its run and version; returns the version."""
    run_id = uuid.uuid4().hex
    path = f"{registry.root}/models/{run_id}"
    result.model.save(registry.spark, path)
    return registry.register(
        experiment.model_name,
        experiment.name,
        run_id,
        path,
        result.metrics,
        {**result.params, "model_family": experiment.family, "target_type": experiment.target_type,
         "test_size": S.TEST_SIZE, **(extra or {})},
        {"model_family": experiment.family, "target_type": experiment.target_type, "target": experiment.target,
         "experiment_name": experiment.name},
    )


def load_production(registry: Registry, model_name: str):
    """``(model, version, f1_test)`` behind the production alias, or None."""
    held = registry.resolve(model_name)
    if held is None:
        return None
    return FailureModel.load(registry.spark, held["path"]), held["version"], held["f1_test"]
