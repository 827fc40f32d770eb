"""Scoring readings as they arrive."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from toolpulse.functions.features import engineer_features
from toolpulse.functions.validation import split_valid
from toolpulse.operators.models import load_production
from toolpulse.operators.registry import Registry
from toolpulse.operators.scoring import gate_and_detail
from toolpulse.streaming.sources import trigger


def with_model_features(readings: DataFrame) -> DataFrame:
    """Features of readings under the names the models were trained on."""
    return engineer_features(readings.withColumn("type", F.col("machine_type")))


def append_scored(
    readings: DataFrame, score: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, every: int | None = None
) -> StreamingQuery:
    """Valid readings with features and scores, appended to a Parquet table exactly once."""
    valid, _ = split_valid(readings)
    scored = score(with_model_features(valid))
    writer = scored.writeStream.format("parquet").outputMode("append")
    return writer.option("path", sink).option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()


@dataclass
class ProductionModels:
    """The models behind the production aliases. A failed reload keeps the last good one."""

    registry: Registry
    gate_name: str
    detail_name: str
    loaded: dict = field(default_factory=dict)
    errors: dict = field(default_factory=dict)

    def refresh(self) -> dict:
        """Load versions that changed; returns the outcome per model."""
        outcome = {}
        for name in (self.gate_name, self.detail_name):
            try:
                held = self.registry.resolve(name)
                if held is None:
                    raise LookupError(f"no production version of {name}")
                if name not in self.loaded or self.loaded[name][1] != held["version"]:
                    self.loaded[name] = load_production(self.registry, name)
                self.errors.pop(name, None)
                outcome[name] = {"status": "loaded", "version": self.loaded[name][1]}
            except Exception as problem:  # any failure leaves the old model in place
                self.errors[name] = str(problem)
                outcome[name] = {"status": "failed", "error": str(problem)}
        if self.gate_name not in self.loaded:
            raise RuntimeError(f"gate model not available: {self.errors.get(self.gate_name)}")
        return outcome

    def score(self, df: DataFrame) -> DataFrame:
        gate, version, _ = self.loaded[self.gate_name]
        detail = self.loaded.get(self.detail_name)
        scored = gate_and_detail(df, gate, detail[0] if detail else None)
        return scored.withColumns({"model_name": F.lit(self.gate_name), "model_version": F.lit(version)})


def score_with_production(
    readings: DataFrame, models: ProductionModels, sink: str, quarantine: str, checkpoint: str, every: int | None = None
) -> StreamingQuery:
    """Score with whatever is in production when a batch starts; bad readings go to quarantine.

    A batch writes the folder of its number, so a repeated batch replaces itself.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        models.refresh()
        batch.persist()
        try:
            valid, rejected = split_valid(batch)
            models.score(with_model_features(valid)).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = readings.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger(every)).start()
