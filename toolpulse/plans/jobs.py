"""Whole jobs: drift check, drift-gated export, retrain and promote."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from toolpulse import schemas as S
from toolpulse.operators.drift import drift_report
from toolpulse.operators.export import ReadingsStore, TrainingStore, export_readings
from toolpulse.operators.experiments import Experiment
from toolpulse.operators.models import register_model, train_model, tune_model
from toolpulse.operators.registry import Registry
from toolpulse.sources import writers
from toolpulse.sources.durable import materialise
from toolpulse.sources.readers import training_window


@dataclass
class Workspace:
    """Where one installation keeps its tables."""

    spark: SparkSession
    root: str

    @property
    def readings(self) -> ReadingsStore:
        return ReadingsStore(self.spark, f"{self.root}/readings", f"{self.root}/readings-purged")

    @property
    def training(self) -> TrainingStore:
        return TrainingStore(self.spark, f"{self.root}/training")

    @property
    def check_log(self) -> str:
        return f"{self.root}/check-log"

    @property
    def triggers(self) -> str:
        return f"{self.root}/retrain-triggers"

    @property
    def registry_root(self) -> str:
        return f"{self.root}/registry"


@dataclass
class CheckResult:
    status: str
    drifted: bool = False
    exported: int = 0
    retrain: bool = False
    features: DataFrame | None = None


def check_drift(
    space: Workspace,
    reference: DataFrame,
    since: str | None = None,
    limit: int | None = S.CURRENT_ROW_LIMIT,
    share: float = S.DRIFT_SHARE,
    export_always: bool = False,
    purge: bool = True,
    baseline: DataFrame | None = None,
) -> CheckResult:
    """One check: compare, and on drift export the readings, ask for a retrain and log.

    Recurring checks pass ``baseline``, the reference's counts, counted once.

    With ``export_always`` stable readings are exported as well, without a
    retrain. The check is logged even when the export fails; the error goes on
    to the caller, and the next check exports the same readings.
    """
    spark = space.spark
    current = materialise(space.readings.sample(since, limit), "current-sample")
    if current.isEmpty():
        writers.append_check_log(spark, space.check_log, False, False)
        return CheckResult("NO_DATA")
    features, verdict = drift_report(reference, current, share, baseline=baseline)
    outcome = verdict.first()
    drifted = outcome["verdict"] == "DRIFT"
    result = CheckResult(outcome["status"], drifted, features=features)
    if drifted or export_always:
        try:
            result.exported = export_readings(space.readings, space.training, since, purge=purge).count()
        except Exception:
            writers.append_check_log(spark, space.check_log, drifted, False)
            raise
    if drifted:
        writers.append_retrain_trigger(spark, space.triggers)
        result.retrain = True
    writers.append_check_log(spark, space.check_log, drifted, drifted)
    return result


def retrain(
    space: Workspace,
    experiment: Experiment,
    preset: str = "full",
    window: int | None = S.TRAINING_WINDOW,
    min_f1: float | None = None,
    tune_trials: int = 0,
    limits: dict | None = None,
):
    """Train on the newest rows, register the version and promote it if both gates pass.

    With ``tune_trials`` the parameters are searched first. Returns the
    promotion decision row.
    """
    rows = training_window(space.training.training(), window)
    registry = Registry(space.spark, space.registry_root)
    overrides, extra = None, {}
    if tune_trials:
        overrides, _ = tune_model(rows, experiment, tune_trials, preset, limits=limits)
        extra = {"tuned": True, "trials": tune_trials}
    result = train_model(rows, experiment, preset, overrides)
    register_model(registry, experiment, result, extra)
    return registry.promote(experiment.model_name, min_f1, auto=True)
