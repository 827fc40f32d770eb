"""Runs, model versions and aliases as append-only tables, and the promotion rule."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.sources import writers
from toolpulse.sources.commit_log import CommitLog

PRODUCTION = "production"


# --- look-ups on tables -----------------------------------------------------------


def version_metrics(versions: DataFrame, runs: DataFrame, metric: str = "f1_test") -> DataFrame:
    """``model_name, version, run_id, <metric>``; null where run or metric is missing."""
    measured = runs.select("run_id", F.try_element_at("metrics", F.lit(metric)).alias(metric))
    return versions.select("model_name", "version", "run_id").join(measured, "run_id", "left")


def latest_versions(versions: DataFrame) -> DataFrame:
    """Highest version number per model, compared as numbers."""
    return versions.groupBy("model_name").agg(F.max(F.col("version").cast("long")).alias("number")).select(
        "model_name", F.col("number").cast("string").alias("version")
    )


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The version each alias points to now: the last row appended for it."""
    newest = F.struct("set_at", F.col("version").cast("long"))
    return aliases.groupBy("model_name", "alias").agg(F.max_by("version", newest).alias("version"))


def production_versions(models: DataFrame, aliases: DataFrame, alias: str = PRODUCTION) -> DataFrame:
    """Every model of ``models`` with its aliased version, null if it has none."""
    held = current_aliases(aliases.where(F.col("alias") == alias)).select(
        "model_name", F.col("version").alias("production_version")
    )
    return models.select("model_name").join(held, "model_name", "left")


def floor_for(model_name: Column) -> Column:
    return F.when(model_name.contains("binary"), F.lit(S.MIN_F1_BINARY)).otherwise(F.lit(S.MIN_F1_MULTICLASS))


def gates(new_f1: Column, production_f1: Column, min_f1: Column) -> tuple[Column, Column]:
    """(improvement, floor): strictly better than production, if any, and at least the floor."""
    return production_f1.isNull() | (new_f1 > production_f1), new_f1 >= min_f1


def promotion_decisions(
    versions: DataFrame, runs: DataFrame, aliases: DataFrame, min_f1: float | None = None, auto: bool = False
) -> DataFrame:
    """One row per model: candidate, production, both gates, outcome and F1 gain."""
    measured = version_metrics(versions, runs)
    latest = latest_versions(versions)
    candidate = latest.join(measured, ["model_name", "version"]).select(
        "model_name", F.col("version").alias("candidate_version"), F.col("f1_test").alias("new_f1")
    )
    holders = production_versions(latest, aliases).join(
        measured.select("model_name", F.col("version").alias("production_version"), F.col("f1_test").alias("production_f1")),
        ["model_name", "production_version"],
        "left",
    )
    floor = F.lit(min_f1) if min_f1 is not None else floor_for(F.col("model_name"))
    improvement, above_floor = gates(F.col("new_f1"), F.col("production_f1"), F.col("min_f1"))
    outcome = (
        F.when(F.col("new_f1").isNull(), F.lit("NO METRIC"))
        .when(F.col("gate_improvement") & F.col("gate_floor"), F.lit("PROMOTED" if auto else "WOULD PROMOTE"))
        .otherwise(F.lit("NOT PROMOTED"))
    )
    return (
        candidate.join(holders, "model_name", "left")
        .withColumn("min_f1", floor)
        .withColumns({"gate_improvement": improvement, "gate_floor": above_floor})
        .withColumn("outcome", outcome)
        .withColumn("f1_gain", F.col("new_f1") - F.col("production_f1"))
    )


def serving_status(models: DataFrame, production: DataFrame, measured: DataFrame) -> DataFrame:
    """Per service: gate and detail model in production, and ok / degraded by the gate.

    ``models`` is ``service, kind, model_name`` with kind ``binary`` or ``multiclass``.
    """
    held = (
        models.join(production, "model_name", "left")
        .join(measured.select("model_name", F.col("version").alias("production_version"), "f1_test"),
              ["model_name", "production_version"], "left")
    )

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    return (
        held.groupBy("service")
        .agg(
            of("binary", "production_version").alias("gate_version"),
            of("binary", "f1_test").alias("gate_f1"),
            of("multiclass", "production_version").alias("detail_version"),
            of("multiclass", "f1_test").alias("detail_f1"),
        )
        .withColumn("status", F.when(F.col("gate_version").isNotNull(), "ok").otherwise("degraded"))
    )


# --- the stored registry ----------------------------------------------------------


@dataclass
class Registry:
    """Three append-only tables in one folder. Version numbers come from a commit log, so no two writers get the same."""

    spark: SparkSession
    root: str

    def _read(self, name: str, schema) -> DataFrame:
        path = f"{self.root}/{name}"
        if not writers.table_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _append(self, name: str, row: DataFrame, schema) -> None:
        writers.checked_not_null(row, schema).write.mode("append").parquet(f"{self.root}/{name}")

    def runs(self) -> DataFrame:
        return self._read("runs", S.RUNS_SCHEMA)

    def versions(self) -> DataFrame:
        return self._read("model_versions", S.VERSIONS_SCHEMA)

    def aliases(self) -> DataFrame:
        return self._read("aliases", S.ALIASES_SCHEMA)

    def next_version(self, model_name: str) -> int:
        """A version number that nobody else gets: above all stored and all reserved ones."""
        found = self.versions().where(F.col("model_name") == model_name)
        stored = found.agg(F.max(F.col("version").cast("long"))).first()[0] or 0
        numbers = CommitLog(self.spark, f"{self.root}/version-numbers", lambda state, e: {**state, e["model"]: e["version"]})
        entry = numbers.commit(lambda state: {"model": model_name, "version": max(stored, state.get(model_name, 0)) + 1})
        return entry["version"]

    def register(
        self, model_name: str, experiment: str, run_id: str, path: str, metrics: dict, params: dict, tags: dict
    ) -> str:
        """Record a run and a new version of the model it produced; returns the version."""
        version = str(self.next_version(model_name))
        one = self.spark.range(1)
        text = {k: str(v) for k, v in params.items()}
        measured = {k: float(v) for k, v in metrics.items() if v is not None}
        self._append(
            "runs",
            one.select(
                F.lit(run_id).alias("run_id"),
                F.lit(experiment).alias("experiment"),
                _map(tags, "string").alias("tags"),
                _map(text, "string").alias("params"),
                _map(measured, "double").alias("metrics"),
                F.current_timestamp().alias("created_at"),
            ),
            S.RUNS_SCHEMA,
        )
        f1 = measured.get("f1_test")
        description = "\n".join(
            [
                f"Model family : {tags.get('model_family')}",
                f"Target       : {tags.get('target')} ({tags.get('target_type')})",
                f"F1 (test)    : {'n/a' if f1 is None else round(f1, 4)}",
            ]
        )
        self._append(
            "model_versions",
            one.select(
                F.lit(model_name).alias("model_name"),
                F.lit(version).alias("version"),
                F.lit(run_id).alias("run_id"),
                F.lit(path).alias("path"),
                F.lit(description).alias("description"),
                _map(tags, "string").alias("tags"),
                F.current_timestamp().alias("created_at"),
            ),
            S.VERSIONS_SCHEMA,
        )
        return version

    def set_alias(self, model_name: str, version: str, alias: str = PRODUCTION) -> None:
        row = self.spark.range(1).select(
            F.lit(model_name).alias("model_name"),
            F.lit(alias).alias("alias"),
            F.lit(version).alias("version"),
            F.current_timestamp().alias("set_at"),
        )
        self._append("aliases", row, S.ALIASES_SCHEMA)

    def resolve(self, model_name: str, alias: str = PRODUCTION):
        """``version, path, f1_test`` behind an alias, or None."""
        held = current_aliases(self.aliases().where((F.col("model_name") == model_name) & (F.col("alias") == alias)))
        named = self.versions().join(held.drop("alias"), ["model_name", "version"])
        measured = version_metrics(self.versions(), self.runs()).select("model_name", "version", "f1_test")
        return named.join(measured, ["model_name", "version"], "left").select("version", "path", "f1_test").first()

    def promote(self, model_name: str, min_f1: float | None = None, auto: bool = False):
        """Decide on the newest version of one model; with ``auto`` a pass moves the alias."""
        mine = F.col("model_name") == model_name
        decision = promotion_decisions(
            self.versions().where(mine), self.runs(), self.aliases().where(mine), min_f1, auto
        ).first()
        if decision is None:
            raise ValueError(f"no versions of {model_name}")
        if decision["outcome"] == "PROMOTED":
            self.set_alias(model_name, decision["candidate_version"])
        return decision


def _map(values: dict, value_type: str) -> Column:
    if not values:
        return F.create_map().cast(f"map<string,{value_type}>")
    entries = []
    for key, value in values.items():
        entries += [F.lit(key), F.lit(value).cast(value_type)]
    return F.create_map(*entries)
