"""Helpers that several operators share."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse.sources.durable import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SALTS = 16
SLICE_CHARS = 1_000_000
_worker_table: dict = {}


def worker_table(name, make):
    """A table that a Python worker keeps from task to task; asking for another one drops the one before."""
    if name not in _worker_table:
        _worker_table.clear()
        _worker_table[name] = make()
    return _worker_table[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; letters beyond ASCII stay."""
    return F.translate(text, UPPER, LOWER)


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Equi-join of many rows per key with at most one row per key.

    Each row of ``small`` is repeated ``salts`` times and the rows of ``big``
    are dealt out by ``spread``, so that a key with a third of all rows meets
    its partner in several tasks.
    """
    dealt = big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b) of longs; component is the smallest node.

    Every round takes the smallest label among a node and its neighbours and
    then the label of that label, so chains shorten by doubling. Labels live
    in written tables; the driver sees one count a round. Nodes without an
    edge are not returned.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    both = materialise(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS node", "least(a, m) AS label"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("up"))
        jumped = hooked.join(up, "next", "left").select(
            "node", F.least("next", F.coalesce("up", "next")).alias("label"), (F.col("next") < F.col("label")).alias("moved")
        )
        stepped = materialise(jumped, "labels")
        if stepped.where("moved").isEmpty():
            return stepped.select("node", F.col("label").alias("component"))
        labels = stepped.select("node", "label")


def slices(batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``chars`` characters of text; one row at least."""
    start = total = 0
    for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if total and total + (size or 0) > chars:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)
