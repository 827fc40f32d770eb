"""Streaming jobs run to the end of what is there, returned as tables."""

from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators.daily_counts import DailyCounts
from toolpulse.operators.drift import baseline_counts
from toolpulse.operators.experiments import BINARY_MODEL, EXPERIMENTS, MULTICLASS_MODEL
from toolpulse.operators.ranking import newest_rows
from toolpulse.plans import adapters as A
from toolpulse.plans import jobs
from toolpulse.plans import sql as Q
from toolpulse.plans.catalogue import query
from toolpulse.plans.catalogue.columns import CANDIDATE_SQL, REASONS_SQL, candidates
from toolpulse.plans.catalogue.drift import FEATURE_ROWS, TREND_SQL, drift_ctes, reference, rounded
from toolpulse.sources import writers
from toolpulse.sources.durable import new_path, shared_path
from toolpulse.streaming import monitor, scoring, tool_state
from toolpulse.streaming.sources import readings_stream


@query(
    "t1_scored_stream",
    Q.with_readings(
        f"SELECT id, {', '.join(S.NUMERIC_FEATURES)}, failure_probability AS score FROM readings"
    ),
)
def t1(spark, sf):
    root = new_path(spark, "stream")
    arriving = readings_stream(spark, A.readings_path(spark, sf), files_per_batch=1)

    def score(df):
        return df.select("id", *S.NUMERIC_FEATURES, (A.rule_percent().cast("double") / 100).alias("score"))

    scoring.append_scored(arriving, score, f"{root}/sink", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/sink")


@query(
    "t2_drift_monitor",
    Q.with_both(
        "SELECT d AS drift_detected, d AS retrain_triggered, (SELECT count(*) FROM readings) AS exported FROM (SELECT avg(drifted::INT) >= 0.2 AS d FROM fd)",
        *drift_ctes(),
    ),
)
def t2(spark, sf):
    """One micro-batch holding all readings: logged, checked, exported and purged."""
    space = jobs.Workspace(spark, new_path(spark, "space"))
    space.training.seed(A.training(spark, sf))
    arriving = readings_stream(spark, A.readings_path(spark, sf))
    monitor.watch_drift(
        arriving, space, reference(spark, sf), f"{space.root}/checkpoint", every=None, limit=None
    ).awaitTermination()
    exported = space.training.exported_ids().agg(F.count("*")).scalar()
    return writers.read_check_log(spark, space.check_log).select("drift_detected", "retrain_triggered", exported.alias("exported"))


def _daily_counts(spark, sf) -> DailyCounts:
    """Counts of all readings, taken in by batches of one file, the first of them twice."""

    def write(path):
        counts = DailyCounts(spark, path)

        def take_in(batch, batch_id):
            for _ in range(2 if batch_id == 0 else 1):
                counts.add(batch, batch_id)

        arriving = readings_stream(spark, A.readings_path(spark, sf), files_per_batch=1)
        writer = arriving.writeStream.foreachBatch(take_in).option("checkpointLocation", new_path(spark, "checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()

    return DailyCounts(spark, shared_path(spark, f"daily-counts:{sf}", write))


@query(
    "t3_trend_from_daily_counts",
    Q.with_both(
        "SELECT strftime(day, '%Y-%m-%d') AS day, feature, row_count, round(distance, 6) AS distance, distance > 0.1 AS drifted FROM trend",
        Q.numeric_counts(),
        TREND_SQL,
    ),
)
def t3_counts(spark, sf):
    """The daily trend without reading the log."""
    trend = _daily_counts(spark, sf).trend(reference(spark, sf))
    return trend.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "feature", "row_count", F.round("distance", 6).alias("distance"), "drifted"
    )


@query(
    "t2_sliding_week",
    Q.with_both(
        """SELECT strftime(day, '%Y-%m-%d') AS day, max(row_count) AS row_count, round(avg((distance > 0.1)::INT), 6) AS drift_share,
        avg((distance > 0.1)::INT) >= 0.2 AS drifted FROM trend GROUP BY day""",
        Q.numeric_counts(),
        TREND_SQL.replace("days AS (", "single_days AS (").replace(
            "cb AS (",
            """days AS (SELECT e.day, feature, v FROM single_days s JOIN (SELECT DISTINCT day FROM single_days) e
                ON s.day BETWEEN e.day - INTERVAL 6 DAY AND e.day),
            cb AS (""",
        ),
    ),
)
def t2_week(spark, sf):
    """Verdict over the seven days up to every day, merged from the counts of the days."""
    week = _daily_counts(spark, sf).trend(reference(spark, sf), days=7)
    share = F.avg(F.col("drifted").cast("int"))
    return week.groupBy("day").agg(F.max("row_count").alias("row_count"), share.alias("share")).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "row_count", F.round("share", 6).alias("drift_share"),
        (F.col("share") >= S.DRIFT_SHARE).alias("drifted"),
    )


@query(
    "d10_report_from_daily_counts",
    Q.with_both(FEATURE_ROWS, *drift_ctes()),
)
def d10_counts(spark, sf):
    """The full report over all readings, from the counts."""
    return rounded(_daily_counts(spark, sf).report(baseline_counts(reference(spark, sf))))


@query(
    "t4_newest_in_log",
    Q.with_readings(
        """SELECT machine_id, count(*) AS readings FROM (SELECT * FROM readings ORDER BY "timestamp" DESC, id DESC LIMIT 10000) GROUP BY 1"""
    ),
)
def t4(spark, sf):
    """Newest readings across batches, read from the log the batches built."""
    root = new_path(spark, "stream")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/log/batch={batch_id}")

    arriving = readings_stream(spark, A.readings_path(spark, sf), files_per_batch=1)
    arriving.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    log = spark.read.schema(S.READINGS_SCHEMA).option("recursiveFileLookup", True).parquet(f"{root}/log")
    newest = newest_rows(log, S.CURRENT_ROW_LIMIT, "timestamp", "id")
    return newest.groupBy("machine_id").agg(F.count("*").alias("readings"))


@query(
    "w11_tool_cycles_stream",
    Q.with_readings(
        """SELECT machine_id, CAST(cycle AS BIGINT) AS cycle, count(*) AS readings, max(tool_wear_minutes) AS max_wear,
        CAST(sum(injected_failure) AS BIGINT) AS failures, 0::BIGINT AS late_readings
        FROM (SELECT *, sum(r) OVER (PARTITION BY machine_id ORDER BY id) AS cycle
          FROM (SELECT *, CASE WHEN tool_wear_minutes < lag(tool_wear_minutes) OVER (PARTITION BY machine_id ORDER BY id) THEN 1 ELSE 0 END AS r FROM readings))
        GROUP BY 1, 2"""
    ),
)
def w11_stream(spark, sf):
    """Six batches in the order of ids, with a new start from the checkpoint before each."""
    root = new_path(spark, "stream")
    log = A.readings(spark, sf)
    first, last = log.agg(F.min("id"), F.max("id")).first()
    sixth = F.floor((F.col("id") - first) * 6 / (last - first + 1))
    for part in range(6):
        writers.append_readings(log.where(sixth == part), f"{root}/log")
        arriving = readings_stream(spark, f"{root}/log")
        tool_state.track_tools(arriving, f"{root}/cycles", f"{root}/checkpoint").awaitTermination()
    return tool_state.tracked_tools(spark, f"{root}/cycles")


@query(
    "t5_machine_wear",
    Q.with_readings(
        "SELECT machine_id, count(*) AS readings, (count(*) % 108) * 2 AS wear, count(*) // 108 AS tools_replaced FROM readings GROUP BY 1"
    ),
)
def t5(spark, sf):
    root = new_path(spark, "stream")
    arriving = readings_stream(spark, A.readings_path(spark, sf), files_per_batch=1)
    monitor.track_wear(arriving, f"{root}/wear", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/wear")


def _faulty_path(spark, sf) -> str:
    """A log with bad readings among the good."""

    def write(path):
        bad = candidates(spark, sf)
        log = A.readings(spark, sf).drop(*[c for c in bad.columns if c != "id"])
        log.join(bad, "id").select(*S.READINGS_COLUMNS).write.parquet(path)

    return shared_path(spark, f"faulty:{sf}", write)


@query(
    "t6_quarantine",
    Q.with_readings(f"SELECT id, concat_ws(',', {REASONS_SQL}) AS reasons FROM candidates WHERE concat_ws(',', {REASONS_SQL}) <> ''", CANDIDATE_SQL),
)
def t6(spark, sf):
    from toolpulse.plans.catalogue.models import registry

    root = new_path(spark, "stream")
    models = scoring.ProductionModels(registry(spark, sf), BINARY_MODEL, MULTICLASS_MODEL)
    arriving = readings_stream(spark, _faulty_path(spark, sf))
    scoring.score_with_production(
        arriving, models, f"{root}/scored", f"{root}/quarantine", f"{root}/checkpoint"
    ).awaitTermination()
    bad = spark.read.parquet(f"{root}/quarantine")
    return bad.select("id", F.array_join("reject_reasons", ",").alias("reasons"))


@query(
    "t7_model_swap",
    Q.with_readings("SELECT CAST(1 + id % 2 AS VARCHAR) AS model_version, count(*) AS row_count FROM readings GROUP BY 1"),
)
def t7(spark, sf):
    """Half of the readings, a promotion, the other half: rows per model version."""
    from toolpulse.operators import models as MM
    from toolpulse.operators.registry import Registry
    from toolpulse.plans.catalogue.models import trained

    root = new_path(spark, "stream")
    reg = Registry(spark, f"{root}/registry")
    first, second = EXPERIMENTS["rf_binary"], EXPERIMENTS["xgb_binary"]
    reg.set_alias(first.model_name, MM.register_model(reg, first, trained(spark, sf, first.name)))
    models = scoring.ProductionModels(reg, BINARY_MODEL, MULTICLASS_MODEL)
    log = A.readings(spark, sf)

    def run() -> None:
        scoring.score_with_production(
            readings_stream(spark, f"{root}/log"), models, f"{root}/scored", f"{root}/quarantine", f"{root}/checkpoint"
        ).awaitTermination()

    writers.append_readings(log.where("id % 2 = 0"), f"{root}/log")
    run()
    reg.set_alias(second.model_name, MM.register_model(reg, second, trained(spark, sf, second.name)))
    writers.append_readings(log.where("id % 2 = 1"), f"{root}/log")
    run()
    scored = spark.read.parquet(f"{root}/scored")
    return scored.groupBy("model_version").agg(F.count("*").alias("row_count"))
