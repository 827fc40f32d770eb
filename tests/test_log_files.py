"""Manifest, compaction and concurrent writers."""

import json
from concurrent.futures import ThreadPoolExecutor
from multiprocessing import get_context

import pytest
from pyspark.sql import functions as F

from toolpulse.operators import export, registry
from toolpulse.plans import jobs
from toolpulse.sources import readers, writers
from toolpulse.sources.commit_log import FOLD_EVERY, CommitLog


@pytest.fixture
def store(spark, readings, tmp_path):
    """Ten files of twenty readings in the order of time."""
    for start in range(0, 200, 20):
        writers.append_readings(readings.where(F.col("id").between(start + 1, start + 20)).coalesce(1), f"{tmp_path}/log")
    return export.ReadingsStore(spark, f"{tmp_path}/log", f"{tmp_path}/purged")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_manifest_knows_every_file(spark, store, readings):
    files = store.files.state()["files"]
    assert len(files) == 10 and sum(m["rows"] for m in files.values()) == 200
    assert sorted((m["first_id"], m["last_id"]) for m in files.values()) == [(s + 1, s + 20) for s in range(0, 200, 20)]
    assert store.rows().exceptAll(readings).isEmpty() and store.rows().count() == 200


def test_purged_ids_join_only_the_files_of_their_range(spark, store):
    assert store.purge(numbers(spark, 25, 27, 9999)) == 2
    plan = store.rows()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1
    joined = store.files._rows_of(store.files.state(), [f for f, m in store.files.state()["files"].items() if m["first_id"] == 41])
    assert "LeftAnti" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert ids(store.rows()) == [i for i in range(1, 201) if i not in (25, 27)]
    assert store.purge(numbers(spark, 25)) == 0


def test_compaction_folds_purged_ids_into_files(spark, store, readings):
    store.purge(numbers(spark, *range(15, 46)))
    before = ids(store.rows())
    old = set(store.files.state()["files"])
    writers.append_readings(readings.where("id <= 2").withColumn("id", F.col("id") + 1000), store.path)
    assert store.compact() == 3
    state = store.files.state()
    assert state["purges"] == {} and len(old & set(state["files"])) == 7
    assert ids(store.rows()) == [*before, 1001, 1002]
    assert store.compact() == 0
    # Rows that arrive later are visible, and so is a purge.
    writers.append_readings(readings.where("id <= 2").withColumn("id", F.col("id") + 2000), store.path)
    store.purge(numbers(spark, 1001, 14))
    assert ids(store.rows()) == [i for i in [*before, 1002, 2001, 2002] if i != 14]
    # Replaced files stay until no reader can have them open.
    replaced = store.files.state()["replaced"]
    assert len(replaced) == 3 and store.files.delete_replaced(min(replaced.values()) + 10) == []
    assert sorted(store.files.delete_replaced(max(replaced.values()) + 4000)) == sorted(replaced)
    assert ids(store.rows()) == [i for i in [*before, 1002, 2001, 2002] if i != 14] and not store.files.state()["replaced"]


def test_a_purge_during_a_compaction_is_kept(spark, store, monkeypatch):
    store.purge(numbers(spark, 5))
    measured = store.files.__class__._measured

    def purge_meanwhile(self, files):
        monkeypatch.setattr(store.files.__class__, "_measured", measured)
        store.purge(numbers(spark, 6))
        return measured(self, files)

    store.files.state()
    monkeypatch.setattr(store.files.__class__, "_measured", purge_meanwhile)
    assert store.compact() == 1
    assert ids(store.rows()) == [i for i in range(1, 201) if i not in (5, 6)]
    assert len(store.files.state()["purges"]) == 1
    assert store.compact() == 1 and ids(store.rows())[:5] == [1, 2, 3, 4, 7]


def test_everything_purged(spark, store):
    assert store.purge(store.rows().select("id")) == 200
    assert store.compact() == 10
    assert store.rows().isEmpty() and store.sample().isEmpty() and store.compact() == 0


def test_newest_open_few_files(spark, store, readings):
    for limit, files in ((20, 1), (21, 2), (200, 10), (None, 10)):
        found = store.files.newest_candidates(limit)
        assert len(found.inputFiles()) == files
        rows = store.sample(limit=limit)
        assert rows.exceptAll(readers.current_sample(readings, limit=limit)).isEmpty() and rows.count() == min(limit or 200, 200)
    store.purge(numbers(spark, *range(190, 201)))
    rows = store.sample(limit=20)
    assert rows.exceptAll(readers.current_sample(readings.where("id < 190"), limit=20)).isEmpty() and rows.count() == 20
    assert len([f for f in store.files.newest_candidates(5).inputFiles() if "/log/" in f]) == 1
    since = "2024-01-01 02:10:00"
    assert store.sample(since=since).count() == readers.current_sample(readings.where("id < 190"), since).count() > 0
    assert store.sample(since="2031-01-01 00:00:00").isEmpty()


def test_newest_where_files_overlap_in_time(spark, readings, tmp_path):
    for part in range(4):
        writers.append_readings(readings.where(F.col("id") % 4 == part).coalesce(1), f"{tmp_path}/log")
    writers.append_readings(readings.where("id = 1").withColumn("id", F.lit(5000)).withColumn("timestamp", F.lit("2030-01-01").cast("timestamp")), f"{tmp_path}/log")
    store = export.ReadingsStore(spark, f"{tmp_path}/log", f"{tmp_path}/purged")
    every = store.rows()
    for limit in (1, 2, 30):
        assert store.sample(limit=limit).exceptAll(readers.current_sample(every, limit=limit)).isEmpty()
        assert store.sample(limit=limit).count() == limit


# --- commits --------------------------------------------------------------------------


def counted(state, entry):
    return {"n": state.get("n", 0) + 1, "taken": [*state.get("taken", []), entry["start"]]}


def reserve(path, times):
    log = CommitLog(None, path, counted)
    return [log.commit(lambda state: {"start": 10 * state.get("n", 0)})["start"] for _ in range(times)]


def test_processes_never_reserve_the_same_range(tmp_path):
    path = f"{tmp_path}/commits"
    with get_context("spawn").Pool(3) as pool:
        taken = [s for part in pool.starmap(reserve, [(path, 25)] * 3) for s in part]
    assert sorted(taken) == [10 * i for i in range(75)]
    at, state = CommitLog(None, path, counted).state()
    assert at == state["n"] == 75 and state["taken"] == sorted(taken)
    names = CommitLog(None, path, counted).folder.names()
    assert len([n for n in names if n.endswith(".state")]) == 75 // FOLD_EVERY and not [n for n in names if n.startswith(".")]


def test_hadoop_clients_create_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/commits", counted)
    log.folder.local = None  # as in a store that only Spark reaches
    assert log.folder.create("0000000001.json", json.dumps({"start": 7}))
    assert not log.folder.create("0000000001.json", "{}")
    assert log.commit(lambda state: {"start": state["n"]})["start"] == 1
    assert log.state() == (2, {"n": 2, "taken": [7, 1]})
    assert log.commit(lambda state: None) is None


def test_two_exports_at_once(spark, training, readings, tmp_path):
    space = jobs.Workspace(spark, str(tmp_path))
    writers.append_readings(readings, space.readings.path)
    space.training.seed(training)
    with ThreadPoolExecutor(2) as pool:
        exported = list(pool.map(lambda _: jobs.export_readings(space.readings, space.training).count(), range(2)))
    assert sorted(exported) == [0, 200]
    rows = space.training.rows()
    assert ids(rows.select(F.col("udi").alias("id"))) == list(range(1, 276))
    assert rows.where("source_id IS NOT NULL").select("source_id").distinct().count() == 200


def test_committed_export_without_its_name_is_found(spark, training, readings, tmp_path, monkeypatch):
    space = jobs.Workspace(spark, str(tmp_path))
    writers.append_readings(readings, space.readings.path)
    space.training.seed(training)
    with monkeypatch.context() as broken:
        broken.setattr(export.Folder, "move", lambda *a: (_ for _ in ()).throw(OSError("down")))
        with pytest.raises(OSError):
            space.training.append(export.build_export(readings, 76))
    assert jobs.export_readings(space.readings, space.training).count() == 0
    assert space.training.training().count() == 275


def test_versions_reserved_at_once_differ(spark, tmp_path):
    reg = registry.Registry(spark, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda i: reg.next_version("model-a" if i % 2 else "model-b"), range(8)))
    assert sorted(found) == [1, 1, 2, 2, 3, 3, 4, 4]
