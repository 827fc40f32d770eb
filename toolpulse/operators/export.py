"""Moving labelled readings into the training table."""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolpulse import schemas as S
from toolpulse.functions.features import to_raw_names
from toolpulse.functions.labels import failure_flags
from toolpulse.functions.text import product_id
from toolpulse.operators.ranking import row_numbers
from toolpulse.sources import readers, writers
from toolpulse.sources.commit_log import CommitLog, Folder
from toolpulse.sources.durable import materialise
from toolpulse.sources.log_files import FileManifest

# The stored training rows remember the reading they came from.
SOURCE_ID = "source_id"


def one_decimal(name: str) -> Column:
    return F.round(F.col(name), 1)


def whole_number(name: str) -> Column:
    """Cut off the fraction, towards zero."""
    return F.col(name).cast("int")


def to_training_layout(readings: DataFrame, udi: Column, counter: Column, *keep: str) -> DataFrame:
    """Readings as training rows: rounded sensors, failure flags, product id."""
    flags = failure_flags(F.col("injected_failure"), F.col("machine_type"))
    return readings.select(
        udi.cast("long").alias("udi"),
        product_id(F.col("machine_type"), counter).alias("product_id"),
        F.col("machine_type").alias("type"),
        one_decimal("air_temperature_kelvin").alias("air_temperature_kelvin"),
        one_decimal("process_temperature_kelvin").alias("process_temperature_kelvin"),
        whole_number("rotational_speed_rpm").alias("rotational_speed_rpm"),
        one_decimal("torque_nm").alias("torque_nm"),
        whole_number("tool_wear_minutes").alias("tool_wear_minutes"),
        F.col("injected_failure").cast("int").alias("machine_failure"),
        *[flags[name].cast("int").alias(name) for name in S.FLAGS],
        *keep,
    )


def next_udi(training: DataFrame) -> DataFrame:
    """Row count and first free id of the training table, in one row."""
    return training.agg(
        F.count("*").alias("existing_rows"), (F.coalesce(F.max("udi"), F.lit(0)) + 1).alias("next_udi")
    )


def export_summary(exported: DataFrame, existing_rows: Column) -> DataFrame:
    """Counts, shares and id range of an export, in one row."""
    shares = []
    for flag in ("hdf", "pwf", "osf", "twf"):
        shares += [F.sum(flag).alias(f"{flag}_count"), F.avg(flag).alias(f"{flag}_share")]
    return exported.agg(
        F.count("*").alias("rows_to_export"),
        F.avg("machine_failure").alias("failure_rate"),
        *shares,
        F.min("udi").alias("first_udi"),
        F.max("udi").alias("last_udi"),
    ).withColumn("total_after", F.col("rows_to_export") + existing_rows)


def preview(exported: DataFrame, rows: int = 3) -> DataFrame:
    return exported.orderBy("udi").limit(rows)


def not_exported(readings: DataFrame, exported_ids: DataFrame) -> DataFrame:
    return readings.join(exported_ids, "id", "left_anti")


def already_exported(readings: DataFrame, exported_ids: DataFrame) -> DataFrame:
    return readings.join(exported_ids, "id", "left_semi")


def build_export(readings: DataFrame, start_udi: int) -> DataFrame:
    """Training rows with consecutive ids in reading order; product numbers start at 1."""
    numbered = row_numbers(readings, "id", "__offset")
    return to_training_layout(
        numbered, F.col("__offset") + (start_udi - 1), F.col("__offset"), F.col("id").alias(SOURCE_ID)
    )


def _after_export(state: dict, entry: dict) -> dict:
    """``exports`` committed so far, the first free id, and the folders of the newest export."""
    return {"exports": state.get("exports", 0) + 1, "next_udi": entry["next_udi"], "staged": entry["staged"], "folder": entry["folder"]}


@dataclass
class TrainingStore:
    """The growing training table. Each export is one folder of it.

    An export is written to a hidden folder first. It counts once it is an entry
    of the commit log, and then gets its final name. Two exporters cannot both
    commit from the same state: the second one starts again and finds the rows
    of the first.
    """

    spark: SparkSession
    path: str

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}-commits", _after_export)

    def state(self) -> dict:
        """Of the commit log; an export that was committed but not yet named gets its name."""
        _, state = self.commits.state()
        if state:
            Folder(self.spark, self.path).move(state["staged"], state["folder"])
        return state

    def exists(self) -> bool:
        self.state()
        return writers.table_exists(self.spark, self.path)

    def rows(self) -> DataFrame:
        raw = T.StructType([*S.RAW_TRAINING_SCHEMA, T.StructField(SOURCE_ID, T.LongType())])
        return readers.to_clean_names(self.spark.read.schema(raw).option("recursiveFileLookup", True).parquet(self.path))

    def training(self) -> DataFrame:
        return self.rows().select(*S.TRAINING_COLUMNS)

    def exported_ids(self) -> DataFrame:
        return self.rows().where(F.col(SOURCE_ID).isNotNull()).select(F.col(SOURCE_ID).alias("id"))

    def seed(self, training: DataFrame) -> None:
        to_raw_names(training.select(*S.TRAINING_COLUMNS, F.lit(None).cast("long").alias(SOURCE_ID))).write.parquet(
            self.path
        )

    def append(self, exported: DataFrame, since: dict | None = None) -> bool:
        """Add an export that was built on the state ``since`` (None: on any); False if another one was committed meanwhile."""
        name = uuid.uuid4().hex
        staged, folder = f"_staged-{name}", f"export-{name}"
        to_raw_names(exported).write.parquet(f"{self.path}/{staged}")
        last = self.spark.read.parquet(f"{self.path}/{staged}").agg(F.max("UDI")).first()[0]
        entry = {"staged": staged, "folder": folder, "next_udi": last + 1}
        known = None if since is None else since.get("exports", 0)
        unchanged = self.commits.commit(lambda now: entry if known in (None, now.get("exports", 0)) else None)
        if unchanged is None:
            jpath = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{staged}")
            jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, True)
            return False
        Folder(self.spark, self.path).move(staged, folder)
        return True


@dataclass
class ReadingsStore:
    """The readings log, in one folder that never moves, and what was purged from it beside it.

    A purge only adds to the purged ids, so rows that arrive meanwhile, and
    writers with a fixed sink, are not touched. Readers leave purged ids out;
    ``compact`` writes the files that hold them anew.
    """

    spark: SparkSession
    path: str
    purged: str

    @property
    def files(self) -> FileManifest:
        return FileManifest(self.spark, self.path, self.purged)

    def rows(self) -> DataFrame:
        return self.files.rows()

    def sample(self, since: str | None = None, limit: int | None = S.CURRENT_ROW_LIMIT) -> DataFrame:
        """The newest complete readings as drift features; only files that can hold them are opened."""
        after = None
        if since is not None:
            after = self.spark.range(1).select(F.unix_micros(F.lit(since).cast("timestamp"))).first()[0]
        return readers.current_sample(self.files.newest_candidates(limit, after), since, limit)

    def purge(self, exported_ids: DataFrame) -> int:
        """Drop exactly the given ids; returns how many rows went. Repeating it drops nothing more."""
        return self.files.purge(exported_ids)

    def compact(self) -> int:
        return self.files.compact()


def export_readings(
    readings: ReadingsStore,
    training: TrainingStore,
    since: str | None = None,
    purge: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Export readings not exported before; returns the rows.

    The training rows carry the reading id, so a run after a crash, or a second
    run on the same readings, adds nothing twice. Of two runs at once one is
    first; the other builds its export again on what that one left. A purge
    comes last, also when nothing is new, and so makes up for one that a crash
    prevented.
    """
    while True:
        before = training.state()
        rows = readers.readings_since(readings.rows(), since)
        start = 1
        if training.exists():
            # Ids only grow, so the scan of exported ids shrinks to the files of this range.
            first, last = rows.agg(F.min("id"), F.max("id")).first()
            if first is not None:
                rows = not_exported(rows, training.exported_ids().where(F.col("id").between(first, last)))
            start = before.get("next_udi") or next_udi(training.rows()).first()["next_udi"]
        exported = materialise(build_export(rows, start), "export")
        if dry_run:
            return exported
        if exported.isEmpty() or training.append(exported, before):
            break
    if purge and training.exists():
        readings.purge(training.exported_ids())
    return exported
