"""The files of a readings log: what each holds, which ids were purged, and compaction.

Writers add files to the log's folder as they like. ``FileManifest`` notes the
rows and the ranges of id and time of every file once. From these a reader
opens only files that can hold what it looks for, and only files in whose range
of ids something was purged are joined with the purged ids. A compaction
writes the remaining rows of such files anew; one entry of the commit log swaps
old files for new ones, so a reader sees either.
"""

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.sources.commit_log import CommitLog, Folder

ROWS_PER_FILE = 4_000_000
KEEP_SECONDS = 3600


def _after(state: dict, entry: dict) -> dict:
    files = {**state.get("files", {}), **entry.get("add", {})}
    purges = {**state.get("purges", {}), **entry.get("purge", {})}
    replaced = {**state.get("replaced", {}), **{f: entry["time"] for f in entry.get("replace", [])}}
    for name in [*entry.get("replace", []), *entry.get("lost", [])]:
        files.pop(name, None)
    for name in entry.get("folded", []):
        purges.pop(name, None)
    for name in entry.get("deleted", []):
        replaced.pop(name, None)
    return {"files": files, "purges": purges, "replaced": replaced}


def _named(path: str) -> str:
    """One spelling of a local file's address."""
    return re.sub("^file:/+", "file:///", path)


def _overlap(a: dict, b: dict) -> bool:
    return a["first_id"] <= b["last_id"] and b["first_id"] <= a["last_id"]


class FileManifest:
    """``path`` is the log's folder, ``beside`` one for the manifest and the purged ids."""

    def __init__(self, spark: SparkSession, path: str, beside: str):
        self.spark, self.path, self.beside = spark, path.rstrip("/"), beside.rstrip("/")
        self.log = CommitLog(spark, f"{self.beside}/manifest", _after)

    # --- files ------------------------------------------------------------------------

    def _listed(self) -> list[str]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        found, files = [], fs.listFiles(root, True)
        prefix = fs.makeQualified(root).toString()
        while files.hasNext():
            name = files.next().getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name.removeprefix(prefix).split("/")):
                found.append(_named(name))
        return found

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], S.READINGS_SCHEMA)
        return self.spark.read.schema(S.READINGS_SCHEMA).parquet(*files)

    def _measured(self, files: list[str]) -> dict[str, dict]:
        """Rows and ranges of files; two columns are read."""
        at = F.unix_micros("timestamp")
        rows = self._read(files).groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
            F.min(at).alias("first_at"), F.max(at).alias("last_at"),
        )
        return {_named(r["file"]): {k: v for k, v in r.asDict().items() if k != "file"} for r in rows.collect()}  # one row per file

    def state(self) -> dict:
        """Takes in files that came or went since the last entry; an empty file is noted with no rows."""
        _, state = self.log.state()
        listed = set(self._listed())
        known = set(state.get("files", {})) | set(state.get("replaced", {}))
        new, lost = sorted(listed - known), sorted(set(state.get("files", {})) - listed)
        if not new and not lost:
            return {"files": {}, "purges": {}, "replaced": {}, **state}
        measured = self._measured(new) if new else {}
        empty = {"rows": 0, "first_id": 0, "last_id": -1, "first_at": 0, "last_at": -1}
        add = {f: measured.get(f, empty) for f in new}

        def decide(now: dict) -> dict | None:
            seen = set(now.get("files", {})) | set(now.get("replaced", {}))
            fresh = {f: m for f, m in add.items() if f not in seen}
            gone = [f for f in lost if f in now.get("files", {})]
            return {"add": fresh, "lost": gone} if fresh or gone else None

        self.log.commit(decide)
        return {"files": {}, "purges": {}, "replaced": {}, **self.log.state()[1]}

    # --- reading ----------------------------------------------------------------------

    def _rows_of(self, state: dict, files: list[str]) -> DataFrame:
        """Rows of the files without purged ids; only files that share a range of ids with a purge are joined."""
        purges = state["purges"]
        touched = [f for f in files if any(_overlap(state["files"][f], p) for p in purges.values())]
        plain = self._read([f for f in files if f not in set(touched)])
        if not touched:
            return plain
        ids = self.spark.read.schema("id long").parquet(*[p for p, m in purges.items() if any(_overlap(state["files"][f], m) for f in touched)])
        return plain.unionByName(self._read(touched).join(ids, "id", "left_anti").select(*S.READINGS_COLUMNS))

    def rows(self) -> DataFrame:
        state = self.state()
        return self._rows_of(state, [f for f, m in state["files"].items() if m["rows"]])

    def newest_candidates(self, n: int | None, after: int | None = None) -> DataFrame:
        """Rows among which the newest ``n`` (all: None) later than ``after`` (microseconds) are.

        Files are taken from the latest start backwards until those taken surely
        hold n rows; nothing before the earliest of their starts can be among them.
        """
        state = self.state()
        files = {f: m for f, m in state["files"].items() if m["rows"] and (after is None or m["last_at"] > after)}
        if n is not None:
            sure, cut = 0, None
            for m in sorted(files.values(), key=lambda m: -m["first_at"]):
                if after is not None and m["first_at"] <= after:
                    break
                sure += max(0, m["rows"] - sum(p["rows"] for p in state["purges"].values() if _overlap(m, p)))
                if sure >= n:
                    cut = m["first_at"]
                    break
            if cut is not None:
                files = {f: m for f, m in files.items() if m["last_at"] >= cut}
        return self._rows_of(state, list(files))

    # --- changing ---------------------------------------------------------------------

    def purge(self, ids: DataFrame) -> int:
        """Leave the given ids out from now on; returns how many rows they were. Repeating it does nothing more."""
        state = self.state()
        ranges = [m for m in state["files"].values() if m["rows"]]
        if not ranges:
            return 0
        first, last = min(m["first_id"] for m in ranges), max(m["last_id"] for m in ranges)
        present = self._rows_of(state, [f for f, m in state["files"].items() if m["rows"]]).select("id")
        gone = present.join(ids.where(F.col("id").between(first, last)), "id", "left_semi")
        path = f"{self.beside}/purged-{uuid.uuid4().hex}"
        gone.write.parquet(path)
        n, first, last = self.spark.read.schema("id long").parquet(path).agg(F.count("*"), F.min("id"), F.max("id")).first()
        if n:
            self.log.commit(lambda _: {"purge": {path: {"rows": n, "first_id": first, "last_id": last}}})
        return n

    def compact(self) -> int:
        """Write files with purged rows anew, by day and without those rows; returns how many files were replaced.

        Rows that arrive or are purged meanwhile are in other entries and stay as they are. If another
        compaction took one of the files first, nothing changes.
        """
        state = self.state()
        purges, files = state["purges"], state["files"]
        touched = [f for f, m in files.items() if m["rows"] and any(_overlap(m, p) for p in purges.values())]
        target = f"{self.path}/compacted-{uuid.uuid4().hex}"
        add: dict[str, dict] = {}
        if touched:
            kept = self._rows_of(state, touched).withColumn("day", F.to_date("timestamp"))
            # A day's rows go to as many files as they need; sizes come from one count.
            days = kept.groupBy("day").count().collect()
            parts = sum(-(-r["count"] // ROWS_PER_FILE) for r in days)
            if parts:
                widest = max(-(-r["count"] // ROWS_PER_FILE) for r in days)
                piece = F.pmod(F.xxhash64("id"), F.lit(widest))
                hidden = f"{self.path}/_compacting-{uuid.uuid4().hex}"
                kept.repartition(parts, "day", piece).sortWithinPartitions("day", "timestamp").drop("day").write.parquet(hidden)
                Folder(self.spark, self.path).move(hidden.rsplit("/", 1)[1], target.rsplit("/", 1)[1])
                prefix = target.rsplit("/", 1)[1] + "/"
                names = [f for f in self._listed() if prefix in f]
                add = self._measured(names)
        elif not purges:
            return 0

        def decide(now: dict) -> dict | None:
            if not set(touched) <= set(now["files"]):
                return {"lost": [], "replace": list(add)}  # ours are not needed
            return {"add": add, "replace": touched, "folded": list(purges)}

        done = self.log.commit(decide)
        return len(touched) if done and "folded" in done else 0

    def delete_replaced(self, now: float, keep_seconds: float = KEEP_SECONDS) -> list[str]:
        """Delete files replaced at least ``keep_seconds`` ago, when no reader has them open any more."""
        _, state = self.log.state()
        old = [f for f, at in state.get("replaced", {}).items() if now - at >= keep_seconds]
        for name in old:
            jpath = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(jpath, False)
        if old:
            self.log.commit(lambda _: {"deleted": old})
        return old
