"""Scans, writes, joins, windows, splits, set operations and the export job."""

from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.functions.features import engineer_features, to_raw_names
from toolpulse.functions.labels import failure_label
from toolpulse.functions.text import metrics_report
from toolpulse.operators import export, lifecycle
from toolpulse.operators import metrics as M
from toolpulse.operators.ranking import row_numbers
from toolpulse.operators.splits import with_folds, with_test_flag
from toolpulse.plans import adapters as A
from toolpulse.plans import jobs
from toolpulse.plans import sql as Q
from toolpulse.plans.catalogue import query
from toolpulse.plans.catalogue.columns import CLEAN, FEATURE_LIST
from toolpulse.plans.catalogue.drift import drift_ctes, reference
from toolpulse.sources import readers, writers
from toolpulse.sources.durable import materialise, new_path

# --- sources and sinks ------------------------------------------------------------


@query("s1_training_scan", Q.with_training(f"SELECT {CLEAN} FROM training"))
def s1(spark, sf):
    return readers.training_table(spark, A.training_path(spark, sf))


@query("s2_udi_scan", Q.with_training("SELECT udi FROM training"))
def s2(spark, sf):
    return readers.training_udis(spark, A.training_path(spark, sf))


@query("s3_baseline_csv", Q.with_training(f"SELECT {CLEAN} FROM training"))
def s3(spark, sf):
    return readers.baseline_csv(spark, A.baseline_csv_path(spark, sf))


CSV_COLUMNS = ["type", "air_temperature_kelvin", "process_temperature_kelvin", "rotational_speed_rpm", "torque_nm"]


@query("s4_csv_columns", Q.with_training(f"SELECT {', '.join(CSV_COLUMNS)} FROM training"))
def s4(spark, sf):
    return readers.baseline_csv_columns(spark, A.baseline_csv_path(spark, sf), CSV_COLUMNS)


SINCE = "2024-01-10 06:00:00"
LOG_COLUMNS = ", ".join(c for c in S.READINGS_COLUMNS if c not in ("timestamp", "effective_failure_rate"))
LOG_SQL = f"""SELECT {LOG_COLUMNS}, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f') AS at, round(effective_failure_rate, 9) AS rate FROM readings"""


def log_row(log):
    kept = [c for c in S.READINGS_COLUMNS if c not in ("timestamp", "effective_failure_rate")]
    return log.select(
        *kept,
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"),
        F.round("effective_failure_rate", 9).alias("rate"),
    )


@query("s5_readings_since", Q.with_readings(f"""{LOG_SQL} WHERE "timestamp" > TIMESTAMP '{SINCE}' ORDER BY id"""))
def s5(spark, sf):
    log = A.readings(spark, sf)
    return log_row(readers.readings_since(log, SINCE).orderBy("id"))


@query(
    "s6_current_projection",
    Q.with_readings(
        f"SELECT machine_type AS type, {', '.join(S.NUMERIC_FEATURES)} FROM readings"
    ),
)
def s6(spark, sf):
    return readers.current_features(A.readings(spark, sf))


@query("s7_create_readings_log", Q.with_readings("SELECT machine_id, count(*) AS readings FROM readings GROUP BY 1"))
def s7(spark, sf):
    """Creating the log twice keeps the rows appended in between."""
    path = new_path(spark, "log")
    writers.create_readings_log(spark, path)
    writers.append_readings(A.readings(spark, sf), path)
    writers.create_readings_log(spark, path)
    return readers.readings_log(spark, path).groupBy("machine_id").agg(F.count("*").alias("readings"))


@query("s8_append_readings", Q.with_readings(LOG_SQL))
def s8(spark, sf):
    path = new_path(spark, "log")
    log = A.readings(spark, sf)
    writers.append_readings(log.where("injected_failure = 0"), path)
    writers.append_readings(log.where("injected_failure = 1"), path)
    return log_row(readers.readings_log(spark, path))


@query("s9_clear_readings", Q.with_readings("SELECT id FROM readings"))
def s9(spark, sf):
    """Rows appended after a clear are the only ones left."""
    path = new_path(spark, "log")
    log = A.readings(spark, sf)
    writers.append_readings(log, path)
    writers.clear_readings(spark, path)
    writers.append_readings(log, path)
    return readers.readings_log(spark, path).select("id")


@query("s10_write_training", Q.with_training(f"SELECT {CLEAN} FROM training"))
def s10(spark, sf):
    path = new_path(spark, "training")
    writers.write_table(to_raw_names(A.training(spark, sf)), path)
    return readers.training_table(spark, path)


EXPORT_SQL = """exported AS (SELECT start + n AS udi, machine_type || CAST(20000 + n AS VARCHAR) AS product_id, machine_type AS type,
  round(air_temperature_kelvin, 1) AS air_temperature_kelvin, round(process_temperature_kelvin, 1) AS process_temperature_kelvin,
  CAST(trunc(rotational_speed_rpm) AS INTEGER) AS rotational_speed_rpm, round(torque_nm, 1) AS torque_nm,
  CAST(trunc(tool_wear_minutes) AS INTEGER) AS tool_wear_minutes, injected_failure AS machine_failure,
  CAST(CASE WHEN injected_failure = 1 AND {twf} THEN 1 ELSE 0 END AS INTEGER) AS twf,
  CAST(CASE WHEN injected_failure = 1 AND {hdf} THEN 1 ELSE 0 END AS INTEGER) AS hdf,
  CAST(CASE WHEN injected_failure = 1 AND ({pwf}) THEN 1 ELSE 0 END AS INTEGER) AS pwf,
  CAST(CASE WHEN injected_failure = 1 AND {osf} THEN 1 ELSE 0 END AS INTEGER) AS osf,
  CAST(0 AS INTEGER) AS rnf
  FROM (SELECT *, row_number() OVER (ORDER BY id) AS n, (SELECT max(udi) FROM training) AS start FROM readings))""".format(
    **{n: Q.condition(n, "machine_type") for n in ("twf", "hdf", "pwf", "osf")}
)


@query(
    "s11_append_training",
    Q.with_both(f"SELECT {CLEAN} FROM training UNION ALL SELECT {CLEAN} FROM exported", EXPORT_SQL),
)
def s11(spark, sf):
    store = export.TrainingStore(spark, new_path(spark, "training"))
    store.seed(A.training(spark, sf))
    start = export.next_udi(store.rows()).first()["next_udi"]
    store.append(export.build_export(A.readings(spark, sf), start))
    return store.training()


def _fresh_space(spark, sf) -> jobs.Workspace:
    """A workspace whose log holds all readings and whose training table is the baseline."""
    space = jobs.Workspace(spark, new_path(spark, "space"))
    writers.append_readings(A.readings(spark, sf), space.readings.path)
    space.training.seed(A.training(spark, sf))
    return space


@query(
    "s12_check_log",
    Q.with_both(
        "SELECT d AS drift_detected, d AS retrain_triggered FROM (SELECT avg(drifted::INT) >= 0.2 AS d FROM fd)", *drift_ctes()
    ),
)
def s12(spark, sf):
    space = _fresh_space(spark, sf)
    jobs.check_drift(space, reference(spark, sf), limit=None)
    return writers.read_check_log(spark, space.check_log).select("drift_detected", "retrain_triggered")


@query(
    "s13_metrics_report",
    Q.with_scored(
        """SELECT line_no::INTEGER AS line_no, line FROM (SELECT unnest(range(0, 7)) AS line_no, unnest(['# Training Metrics', '',
        printf('f1_test:        %.4f', f1), printf('precision_test: %.4f', p), printf('recall_test:    %.4f', r),
        printf('brier_score:    %.4f  (lower is better; 0 = perfect)', brier), printf('roc_auc_test:   %.4f', auc)]) AS line
        FROM (SELECT 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / (tp + fn) AS r, brier, auc
          FROM (SELECT sum(machine_failure * predicted) AS tp, sum((1 - machine_failure) * predicted) AS fp,
              sum(machine_failure * (1 - predicted)) AS fn, avg((probability - machine_failure) * (probability - machine_failure)) AS brier FROM scored),
            (SELECT sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (SELECT pos, neg,
              coalesce(sum(neg) OVER (ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT probability, sum(machine_failure) AS pos, sum(1 - machine_failure) AS neg FROM scored GROUP BY 1)))))"""
    ),
)
def s13(spark, sf):
    scored = A.scored_training(spark, sf)
    one = F.lit(1).alias("one")
    scores = M.scores(M.confusion(scored, "machine_failure", "predicted"), "binary").select("*", one)
    brier = scored.agg(M.brier_binary(F.col("machine_failure"), F.col("probability")).alias("brier_score")).select("*", one)
    auc = M.roc_auc(scored, "machine_failure", "probability").select(F.col("roc_auc").alias("roc_auc_test"), one)
    row = scores.join(brier, "one").join(auc, "one").withColumnsRenamed(
        {"f1": "f1_test", "precision": "precision_test", "recall": "recall_test"}
    )
    path = new_path(spark, "report")
    row = materialise(row, "metrics")
    writers.write_metrics_report(row, path)
    return metrics_report(row)


# Requests of 0 to 2 readings, as JSON text.
def request_payloads(spark, sf):
    log = A.readings(spark, sf)

    def reading(shift: float):
        return F.struct(
            "machine_type", "air_temperature_kelvin", "process_temperature_kelvin", "rotational_speed_rpm",
            (F.col("torque_nm") + F.lit(shift)).alias("torque_nm"), "tool_wear_minutes",
        )

    readings = F.slice(F.array(reading(0.0), reading(25.0)), F.lit(1), (F.col("id") % 3).cast("int"))
    return log.select(F.col("id").alias("request_id"), F.to_json(F.struct(readings.alias("readings"))).alias("payload"))


REQUEST_SQL = """requests AS (SELECT id AS request_id, CAST(position AS INTEGER) AS position, machine_type, air_temperature_kelvin,
  process_temperature_kelvin, rotational_speed_rpm, torque_nm + position * 25.0::DOUBLE AS torque_nm, tool_wear_minutes
  FROM readings, (SELECT unnest([0, 1]) AS position) WHERE position < id % 3)"""


@query("s16_batch_requests", Q.with_readings("SELECT * FROM requests", REQUEST_SQL))
def s16(spark, sf):
    return readers.parse_requests(request_payloads(spark, sf))[0]


@query("s16_empty_requests", Q.with_readings("SELECT id AS request_id FROM readings WHERE id % 3 = 0"))
def s16_empty(spark, sf):
    return readers.parse_requests(request_payloads(spark, sf))[1]


@query(
    "s17_retrain_trigger",
    Q.with_both("SELECT 'drift detected' AS kind, count(*) AS triggers FROM (SELECT 1 FROM fd HAVING avg(drifted::INT) >= 0.2)", *drift_ctes()),
)
def s17(spark, sf):
    space = _fresh_space(spark, sf)
    jobs.check_drift(space, reference(spark, sf), limit=None)
    lines = spark.read.text(space.triggers)
    return lines.groupBy(F.split_part("value", F.lit(":"), F.lit(1)).alias("kind")).agg(F.count("*").alias("triggers"))


# --- aggregates of the export ---------------------------------------------------------


@query("a1_row_count", Q.with_readings("SELECT count(*) AS row_count, count(*) > 0 AS has_data FROM readings"))
def a1(spark, sf):
    log = A.readings(spark, sf)
    return log.agg(F.count("*").alias("row_count")).withColumn("has_data", F.col("row_count") > 0)


@query("a2_next_udi", Q.with_training("SELECT count(*) AS existing_rows, coalesce(max(udi), 0) + 1 AS next_udi FROM training"))
def a2(spark, sf):
    return export.next_udi(A.training(spark, sf))


@query(
    "a3_failure_rate",
    Q.with_both(
        """SELECT count(*) AS rows_to_export, round(avg(machine_failure), 6) AS failure_rate,
        count(*) + (SELECT count(*) FROM training) AS total_after FROM exported""",
        EXPORT_SQL,
    ),
)
def a3(spark, sf):
    training = A.training(spark, sf)
    exported = export.to_training_layout(A.readings(spark, sf), F.col("id"), F.col("id"))
    summary = export.export_summary(exported, training.agg(F.count("*")).scalar())
    return summary.select("rows_to_export", F.round("failure_rate", 6).alias("failure_rate"), "total_after")


@query(
    "a4_export_summary",
    Q.with_both(
        "SELECT count(*) AS rows_to_export, "
        + ", ".join(
            f"CAST(sum({f}) AS BIGINT) AS {f}_count, round(avg({f}), 6) AS {f}_share" for f in ("hdf", "pwf", "osf", "twf")
        )
        + ", min(udi) AS first_udi, max(udi) AS last_udi FROM exported",
        EXPORT_SQL,
    ),
)
def a4(spark, sf):
    training = A.training(spark, sf)
    start = export.next_udi(training).first()["next_udi"]
    exported = export.build_export(A.readings(spark, sf), start)
    summary = export.export_summary(exported, F.lit(0))
    shares = {f"{f}_share": F.round(f"{f}_share", 6) for f in ("hdf", "pwf", "osf", "twf")}
    return summary.withColumns(shares).drop("failure_rate", "total_after")


# --- joins ----------------------------------------------------------------------------


def exported_before(spark, sf):
    """Ids a former export took: all readings of the first 20 days with an even number."""
    early = F.col("timestamp") <= F.lit("2024-01-20 00:00:00").cast("timestamp")
    return A.readings(spark, sf).where(early & (F.col("id") % 2 == 0)).select("id")


BEFORE_SQL = """before AS (SELECT id FROM readings WHERE "timestamp" <= TIMESTAMP '2024-01-20 00:00:00' AND id % 2 = 0)"""


@query("j3_purge_by_id", Q.with_readings("SELECT id FROM readings WHERE id NOT IN (SELECT id FROM before)", BEFORE_SQL))
def j3(spark, sf):
    root = new_path(spark, "purge")
    store = export.ReadingsStore(spark, A.readings_path(spark, sf), f"{root}/purged")
    store.purge(exported_before(spark, sf))
    return store.rows().select("id")


@query("j3_compacted_log", Q.with_readings("SELECT id, machine_id FROM readings WHERE id NOT IN (SELECT id FROM before)", BEFORE_SQL))
def j3_compacted(spark, sf):
    """Purged rows are gone from the files themselves; the log is its own copy, in several files."""
    root = new_path(spark, "purge")
    writers.append_readings(A.readings(spark, sf), f"{root}/log")
    store = export.ReadingsStore(spark, f"{root}/log", f"{root}/purged")
    store.purge(exported_before(spark, sf))
    store.compact()
    if store.files.state()["purges"]:
        raise RuntimeError("purged ids are left after a compaction")
    return store.rows().select("id", "machine_id")


@query(
    "j4_not_exported",
    Q.with_readings("SELECT id, machine_id, torque_nm FROM readings WHERE id NOT IN (SELECT id FROM before)", BEFORE_SQL),
)
def j4(spark, sf):
    log = A.readings(spark, sf)
    return export.not_exported(log, exported_before(spark, sf)).select("id", "machine_id", "torque_nm")


@query("j4_already_exported", Q.with_readings("SELECT id FROM readings SEMI JOIN before USING (id)", BEFORE_SQL))
def j4_semi(spark, sf):
    log = A.readings(spark, sf)
    return export.already_exported(log, exported_before(spark, sf)).select("id")


@query(
    "j5_resample_baseline",
    Q.with_training(
        """SELECT id, udi, type, air_temperature_kelvin, process_temperature_kelvin, rotational_speed_rpm, torque_nm
        FROM (SELECT event_id + 1 AS id, ('0x' || substr(md5(CAST(event_id + 1 AS VARCHAR) || ':42'), 1, 15))::BIGINT
          % (SELECT max(udi) FROM training) + 1 AS udi FROM events) JOIN training USING (udi)"""
    ),
)
def j5(spark, sf):
    draws = A.source(spark, sf, "events").select((F.col("event_id") + 1).alias("id"))
    return lifecycle.resample(draws, "id", A.training(spark, sf), CSV_COLUMNS)


# --- order, windows, splits -------------------------------------------------------------


@query("w1_order_by_id", Q.with_readings("SELECT id, machine_id FROM readings ORDER BY id"))
def w1(spark, sf):
    return A.readings(spark, sf).orderBy("id").select("id", "machine_id")


@query(
    "w2_newest_readings",
    Q.with_readings(
        f"""SELECT machine_type AS type, {', '.join(S.NUMERIC_FEATURES)} FROM (SELECT * FROM readings
        WHERE "timestamp" > TIMESTAMP '{SINCE}' ORDER BY "timestamp" DESC, id DESC LIMIT 10000)"""
    ),
)
def w2(spark, sf):
    return readers.current_sample(A.readings(spark, sf), SINCE)


@query(
    "w2_newest_by_file_ranges",
    Q.with_readings(
        f"""SELECT machine_type AS type, {', '.join(S.NUMERIC_FEATURES)} FROM (SELECT * FROM readings
        WHERE id NOT IN (SELECT id FROM before) ORDER BY "timestamp" DESC, id DESC LIMIT 1000)""",
        BEFORE_SQL,
    ),
)
def w2_files(spark, sf):
    """The newest thousand readings that were not purged, from the files that can hold them."""
    root = new_path(spark, "purge")
    store = export.ReadingsStore(spark, A.readings_path(spark, sf), f"{root}/purged")
    store.purge(exported_before(spark, sf))
    return store.sample(limit=1000)


@query("w3_training_window", Q.with_training(f"SELECT {CLEAN} FROM training ORDER BY udi DESC LIMIT 50000"))
def w3(spark, sf):
    return readers.training_window(A.training(spark, sf))


@query("w4_consecutive_udi", Q.with_readings("SELECT id, 70000 + row_number() OVER (ORDER BY id) AS udi FROM readings"))
def w4(spark, sf):
    return row_numbers(A.readings(spark, sf).select("id"), "id", "udi", start=70001)


@query(
    "w5_batch_counter",
    Q.with_readings("SELECT mode, id, row_number() OVER (PARTITION BY mode ORDER BY id) AS counter FROM readings"),
)
def w5(spark, sf):
    log = A.readings(spark, sf).select("mode", "id")
    return row_numbers(log, "id", "counter", by="mode")


@query("w6_export_preview", Q.with_both(f"SELECT {CLEAN} FROM exported ORDER BY udi LIMIT 3", EXPORT_SQL))
def w6(spark, sf):
    space = _fresh_space(spark, sf)
    exported = jobs.export_readings(space.readings, space.training, dry_run=True)
    return export.preview(exported.select(*S.TRAINING_COLUMNS))


LABELLED = f"labelled AS (SELECT udi, {Q.LABEL} AS label, md5(CAST(udi AS VARCHAR) || ':42') AS h FROM training)"
SPLIT = """split AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) <= floor(count(*) OVER (PARTITION BY label) * 0.2::DOUBLE + 0.5) AS is_test FROM labelled)"""


def labelled(spark, sf):
    return A.training(spark, sf).select("udi", failure_label().alias("label"))


@query("w7_stratified_split", Q.with_training("SELECT udi, label, is_test FROM split", LABELLED, SPLIT))
def w7(spark, sf):
    return with_test_flag(labelled(spark, sf), "label")


def _folds_sql(k: int) -> str:
    return f"SELECT udi, label, CAST(ntile({k}) OVER (PARTITION BY label ORDER BY h) - 1 AS INTEGER) AS fold FROM split WHERE NOT is_test"


def _folds(k: int):
    def run(spark, sf):
        train = with_test_flag(labelled(spark, sf), "label").where("NOT is_test").drop("is_test")
        return with_folds(train, "label", k)

    return run


query("w8_stratified_folds", Q.with_training(_folds_sql(5), LABELLED, SPLIT))(_folds(S.CV_FOLDS))
query("w9_calibration_folds", Q.with_training(_folds_sql(3), LABELLED, SPLIT))(_folds(S.CALIBRATION_FOLDS))


@query(
    "w11_tool_cycles",
    Q.with_readings(
        """SELECT machine_id, CAST(cycle AS BIGINT) AS cycle, count(*) AS readings, max(tool_wear_minutes) AS max_wear,
        CAST(sum(injected_failure) AS BIGINT) AS failures
        FROM (SELECT *, sum(r) OVER (PARTITION BY machine_id ORDER BY id) AS cycle
          FROM (SELECT *, CASE WHEN tool_wear_minutes < lag(tool_wear_minutes) OVER (PARTITION BY machine_id ORDER BY id) THEN 1 ELSE 0 END AS r FROM readings))
        GROUP BY 1, 2"""
    ),
)
def w11(spark, sf):
    return lifecycle.tool_cycles(A.readings(spark, sf))


# --- set operations -----------------------------------------------------------------------


@query(
    "u1_union_all",
    Q.with_both(
        f"""SELECT {FEATURE_LIST}, 'baseline' AS side FROM featured
        UNION ALL SELECT machine_type, {', '.join(S.NUMERIC_FEATURES)}, 'current' FROM readings"""
    ),
)
def u1(spark, sf):
    ref = engineer_features(A.training(spark, sf)).select(*S.FEATURES, F.lit("baseline").alias("side"))
    wide = {c: F.col(c).cast("double") for c in ("rotational_speed_rpm", "tool_wear_minutes")}
    cur = readers.current_features(A.readings(spark, sf)).withColumn("side", F.lit("current"))
    return ref.withColumns(wide).unionByName(cur)


@query(
    "u2_feature_completeness",
    Q.with_training(
        "SELECT feature, count(v) AS filled FROM (UNPIVOT (SELECT "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in S.FEATURES)
        + " FROM featured) ON COLUMNS(*) INTO NAME feature VALUE v) GROUP BY 1"
    ),
)
def u2(spark, sf):
    from toolpulse.functions.features import feature_frame

    frame = feature_frame(engineer_features(A.training(spark, sf)))
    filled = F.array(*[F.struct(F.lit(c).alias("feature"), F.count(c).alias("filled")) for c in S.FEATURES])
    return frame.agg(filled.alias("f")).select(F.inline("f"))


# --- export jobs ----------------------------------------------------------------------------


@query(
    "e1_export_job",
    Q.with_both(
        f"""SELECT *, (SELECT count(*) FROM readings) - (SELECT count(*) FROM exported) AS remaining_readings
        FROM (SELECT {CLEAN} FROM training UNION ALL SELECT {CLEAN} FROM exported)""",
        EXPORT_SQL,
    ),
)
def e1(spark, sf):
    """Export and purge, then once more: the second run finds nothing new. The rows left in the log go with each row."""
    space = _fresh_space(spark, sf)
    jobs.export_readings(space.readings, space.training, purge=True)
    jobs.export_readings(space.readings, space.training, purge=True)
    return space.training.training().withColumn("remaining_readings", F.lit(space.readings.rows().count()))


@query(
    "e2_drift_gated_export",
    Q.with_both(
        f"SELECT {CLEAN}, (SELECT avg(drifted::INT) >= 0.2 FROM fd) AS retrain FROM exported", EXPORT_SQL, *drift_ctes()
    ),
)
def e2(spark, sf):
    space = _fresh_space(spark, sf)
    result = jobs.check_drift(space, reference(spark, sf), limit=None, export_always=True, purge=False)
    new = space.training.rows().where(F.col(export.SOURCE_ID).isNotNull())
    return new.select(*S.TRAINING_COLUMNS, F.lit(result.retrain).alias("retrain"))
