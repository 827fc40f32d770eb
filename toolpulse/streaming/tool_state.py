"""Tool cycles per machine on the arriving readings, from the wear that they report.

State per machine is the tool at work (last reading and its wear, cycle number,
totals of the cycle) and the readings that are too young to be settled. A
reading is settled, in the order of ids, once the machine has sent one that
is ``delay`` younger; so readings may come out of order by that much. One that
comes after younger ones were settled is late: it is counted and left out.

A batch's rows of a machine are one group. What it holds in memory is the
batch's share of that machine and the unsettled readings, so batches should be
bounded (``files_per_batch``).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from toolpulse.streaming.sources import trigger

TOOL = "last_id long, last_wear double, cycle long, readings long, max_wear double, failures long, newest long, late long"
PENDING = "id long, at long, wear double, failure long"
CYCLES = "machine_id string, cycle long, readings long, max_wear double, failures long, late_readings long"
START = (-1, 0.0, 0, 0, 0.0, 0, 0, 0)
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def wear_on(tool: tuple, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    """The tool after ``rows`` (by id), and every cycle that they belong to with its totals.

    A tool is replaced where wear falls.
    """
    last_id, last_wear, cycle, readings, max_wear, failures, newest, late = tool
    if rows.empty:
        return tool, pd.DataFrame({"cycle": [], "readings": [], "max_wear": [], "failures": []})
    wear = rows["wear"].to_numpy()
    before = np.concatenate([[last_wear if last_id >= 0 else wear[0]], wear[:-1]])
    own = cycle + np.cumsum(wear < before)
    totals = pd.DataFrame({"cycle": own, "readings": 1, "max_wear": wear, "failures": rows["failure"].to_numpy()})
    if readings:
        open_one = pd.DataFrame({"cycle": [cycle], "readings": [readings], "max_wear": [max_wear], "failures": [failures]})
        totals = pd.concat([open_one, totals])
    cycles = totals.groupby("cycle", as_index=False).agg({"readings": "sum", "max_wear": "max", "failures": "sum"})
    end = cycles.iloc[-1]
    after = (int(rows["id"].iloc[-1]), float(wear[-1]), int(end["cycle"]), int(end["readings"]), float(end["max_wear"]), int(end["failures"]))
    return (*after, newest, late), cycles


class ToolCycles(StatefulProcessor):
    def __init__(self, delay_seconds: int):
        self.delay = delay_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tool = handle.getValueState("tool", TOOL)
        self.pending = handle.getListState("pending", PENDING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tool = tuple(self.tool.get() or START)
        columns = ["id", "at", "wear", "failure"]
        held = pd.DataFrame(list(self.pending.get()), columns=columns)
        all_rows = pd.concat([held, *(part[columns] for part in rows)]).drop_duplicates("id").sort_values("id")
        is_late = all_rows["id"] <= tool[0]
        waiting = all_rows[~is_late]
        newest = max(tool[6], int(all_rows["at"].max()))
        tool = (*tool[:6], newest, tool[7] + int(is_late.sum()))
        young = (waiting["at"] > newest - self.delay).to_numpy()
        settled = int(young.argmax()) if young.any() else len(waiting)
        tool, done = wear_on(tool, waiting.iloc[:settled])
        rest = waiting.iloc[settled:]
        _, open_ones = wear_on(tool, rest)
        self.tool.update(tool)
        self.pending.clear()
        if len(rest):
            self.pending.appendList([(int(r.id), int(r.at), float(r.wear), int(r.failure)) for r in rest.itertuples()])
        cycles = pd.concat([done, open_ones]).drop_duplicates("cycle", keep="last")
        yield pd.DataFrame(
            {
                "machine_id": key[0],
                "cycle": cycles["cycle"].astype("int64"),
                "readings": cycles["readings"].astype("int64"),
                "max_wear": cycles["max_wear"].astype("float64"),
                "failures": cycles["failures"].astype("int64"),
                "late_readings": tool[7],
            }
        )

    def close(self) -> None:
        pass


def track_tools(readings: DataFrame, table: str, checkpoint: str, delay_seconds: int = 600, every: int | None = None) -> StreamingQuery:
    """Append every batch's changed cycles to ``table``; a batch writes the folder of its number."""
    spark = readings.sparkSession
    needed = readings.select(
        "machine_id", "id", F.unix_micros("timestamp").alias("at"), F.col("tool_wear_minutes").cast("double").alias("wear"),
        F.col("injected_failure").cast("long").alias("failure"),
    )
    cycles = needed.groupBy("machine_id").transformWithStateInPandas(
        statefulProcessor=ToolCycles(delay_seconds), outputStructType=CYCLES, outputMode="Update", timeMode="None"
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = cycles.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)  # state of several variables needs this store
    try:
        return writer.trigger(**trigger(every)).start()
    finally:
        spark.conf.set(STORE, before)


def tracked_tools(spark: SparkSession, table: str) -> DataFrame:
    """The last word on every cycle: machine_id, cycle, readings, max_wear, failures, late_readings."""
    rows = spark.read.parquet(table)
    newest = F.max_by(F.struct("readings", "max_wear", "failures", "late_readings"), "batch").alias("last")
    return rows.groupBy("machine_id", "cycle").agg(newest).select("machine_id", "cycle", "last.*")
