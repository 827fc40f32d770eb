"""Running sums, row numbers and order-statistic cuts that spread over many tasks.

A window without a partition key, or with one value holding most rows, sorts
everything in one task. Here rows are dealt out by ranges of the order column
and written once with the number of their range; each range is its own window
partition and gets the totals of the earlier ranges, one small row per range.
Being written, a recomputed task sees the same ranges. Every size takes this path.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from toolpulse.sources.durable import materialise

ROWS_PER_RANGE = 200_000
# Rows beyond the wanted ones that a cut-off may leave for the last sort.
FEW_ROWS = 1_000_000
HISTOGRAM_BINS = 1024


def in_ranges(df: DataFrame, *order: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The rows written in ranges of ``order``, with ``__range`` growing in that order.

    Equal order values share a range.
    """
    ranges = max(1, math.ceil(df.count() / rows_per_range))
    return materialise(df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")


def prefix_sums(
    df: DataFrame, key: str, order: str, sums: list[str], lead: bool = False, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Running totals of ``sums`` up to and including each row, per ``key``.

    ``df`` holds one row per (key, order value), so pre-aggregate first, and
    should be cheap to scan again (a materialised table). Any number of keys is
    taken, whatever their sizes. Adds ``cum_<column>`` and, with ``lead``,
    ``next_<order>``.
    """
    ranged = in_ranges(df, key, order, rows_per_range=rows_per_range)
    totals = ranged.groupBy(key, "__range").agg(
        *[F.sum(c).alias(f"__t_{c}") for c in sums], F.min(order).alias("__first")
    )
    by_range = Window.partitionBy(key).orderBy("__range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        key,
        "__range",
        *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in sums],
        F.lead("__first").over(by_range).alias("__next_first"),
    )
    window = Window.partitionBy(key, "__range").orderBy(order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(offsets, [key, "__range"])
    out = out.withColumns({f"cum_{c}": F.sum(c).over(running) + F.col(f"__o_{c}") for c in sums})
    if lead:
        out = out.withColumn(f"next_{order}", F.coalesce(F.lead(order).over(window), "__next_first"))
    return out.drop("__range", "__next_first", *[f"__o_{c}" for c in sums])


def rows_before(df: DataFrame, order: str, n: str, name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds the total of the whole numbers ``n`` over all rows with a smaller ``order``, one column of unique whole numbers.

    Unlike ``prefix_sums`` it deals the rows out once: a range adds up while it
    is written, so no second exchange brings it together. ``df`` should be cheap to scan again.
    """
    ranges = max(1, math.ceil(df.count() / rows_per_range))
    sorted_ranges = df.select(F.col(order).cast("long"), F.col(n).cast("long")).repartitionByRange(ranges, order).sortWithinPartitions(order)

    def add_up(batches):
        total = 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            ends = total + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ends - sizes)], ["at", "size", "inside"])
            total = int(ends[-1]) if len(ends) else total

    summed = sorted_ranges.mapInArrow(add_up, "at long, size long, inside long").withColumn("__range", F.spark_partition_id())
    summed = materialise(summed, "ranges")
    # One row per range: a thousandth of a percent of the rows at most.
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summed.groupBy("__range").agg(F.sum("size").alias("__total")).select(
        "__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before")
    )
    joined = summed.join(F.broadcast(offsets), "__range")
    return joined.select(F.col("at").alias(order), F.col("size").alias(n), (F.col("inside") + F.col("__before")).alias(name))


def newest_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The ``n`` greatest rows by ``order`` (numbers or timestamps; the last one unique); nulls come last.

    A top-k over many input partitions sends k rows of each to one task. So a
    cut-off is found first, by counting rows in ever narrower bins, and only
    the rows beyond it, at most about a million more than ``n``, are sorted.
    """
    return df.where(_beyond_cut_off(df, n, list(order))).orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n)


def _beyond_cut_off(df: DataFrame, n: int, order: list[str]) -> Column:
    """A condition that keeps the top ``n`` rows and at most ``FEW_ROWS`` others, unless they tie in all of ``order``."""
    if not order:
        return F.lit(True)
    name = order[0]
    is_time = df.schema[name].dataType.typeName().startswith("timestamp")
    number = F.unix_micros(name) if is_time else F.col(name)

    def literal(value: int) -> Column:
        return F.timestamp_micros(F.lit(value)) if is_time else F.lit(value)

    rows, filled, low, high = df.agg(F.count(F.lit(1)), F.count(name), F.min(number), F.max(number)).first()
    if rows <= n + FEW_ROWS:
        return F.lit(True)
    if filled <= n:  # all of these, and the best of the nulls by the next column
        null = F.col(name).isNull()
        return ~null | _beyond_cut_off(df.where(null), n - filled, order[1:])
    while True:
        width = max(1, -(-(high - low + 1) // HISTOGRAM_BINS))
        inside = F.col(name).between(literal(low), literal(high))
        bins = df.where(inside).groupBy(F.floor((number - F.lit(low)) / F.lit(width)).cast("int").alias("bin")).count()
        sizes = {r["bin"]: r["count"] for r in bins.collect()}
        for b in sorted(sizes, reverse=True):
            if n <= sizes[b]:
                break
            n -= sizes[b]
        low, high = low + b * width, min(high, low + (b + 1) * width - 1)
        if sizes[b] <= FEW_ROWS:
            return F.col(name) >= literal(low)
        if width == 1:  # one value holds the crowd: go on with the next column
            same = F.col(name) == literal(low)
            return (F.col(name) > literal(low)) | (same & _beyond_cut_off(df.where(same), n, order[1:]))


def row_numbers(
    df: DataFrame, order: str, name: str, start: int = 1, by: str | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Consecutive numbers from ``start`` in the order of a unique column, per ``by`` if given."""
    keys = [by] if by else []
    ranged = in_ranges(df, *keys, order, rows_per_range=rows_per_range)
    sizes = ranged.groupBy(*keys, "__range").count()
    # One row per range and key: a thousandth of a percent of the rows at most.
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    window = Window.partitionBy(*keys, "__range").orderBy(order)
    joined = ranged.withColumn("__place", F.row_number().over(window)).join(offsets, [*keys, "__range"])
    value = (F.col("__place") + F.col("__before") + (start - 1)).cast("long")
    return joined.withColumn(name, value).drop("__range", "__place", "__before")


def hash_cuts(df: DataFrame, group: str, digest: str, wanted) -> dict[object, list[str | None]]:
    """Exact order statistics of a hex digest per group, without sorting the table.

    ``wanted(n)`` gives the ranks (1-based, 0 for "before the first row") to
    find in a group of ``n`` rows. Rows are counted by digest prefix; only the
    prefixes that contain a wanted rank are looked at again, by a longer prefix
    while they hold many rows, and then ranked. Digests spread evenly, so those
    are a small share of any group, however large the group is. Groups must be
    few (classes); the answer is a short dictionary.
    """
    step = 2
    width = step
    counts = _prefix_counts(df, group, digest, width)
    cuts: dict = {}
    targets = []
    for value, sizes in counts.items():
        ranks = wanted(sum(sizes.values()))
        cuts[value] = [None] * len(ranks)
        for slot, rank in enumerate(ranks):
            if rank > 0:
                targets.append((value, slot) + _locate(sizes, "", rank))
    while any(size > ROWS_PER_RANGE for *_, size in targets):
        width += step
        counts = _prefix_counts(_in_targets(df, group, digest, targets), group, digest, width)
        targets = [
            (value, slot) + _locate(counts[value], prefix, rank) for value, slot, prefix, rank, _ in targets
        ]
    if not targets:
        return cuts
    window = Window.partitionBy(group, "__prefix").orderBy(digest)
    ranked = _in_targets(df, group, digest, targets).withColumn("__rank", F.row_number().over(window))
    ranks = sorted({t[3] for t in targets})
    found = {
        (r[group], r["__prefix"], r["__rank"]): r[digest] for r in ranked.where(F.col("__rank").isin(ranks)).collect()
    }
    for value, slot, prefix, rank, _ in targets:
        cuts[value][slot] = found[(value, prefix, rank)]
    return cuts


def _prefix_counts(df: DataFrame, group: str, digest: str, width: int) -> dict[object, dict[str, int]]:
    counts: dict = {}
    for row in df.groupBy(group, F.substring(digest, 1, width).alias("prefix")).count().collect():
        counts.setdefault(row[group], {})[row["prefix"]] = row["count"]
    return counts


def _locate(sizes: dict[str, int], within: str, rank: int) -> tuple[str, int, int]:
    """The prefix holding the row of that rank, its rank inside, and the prefix's size."""
    for prefix in sorted(p for p in sizes if p.startswith(within)):
        if rank <= sizes[prefix]:
            return prefix, rank, sizes[prefix]
        rank -= sizes[prefix]
    raise ValueError("rank beyond the group")


def _in_targets(df: DataFrame, group: str, digest: str, targets: list) -> DataFrame:
    """Rows under the target prefixes; a join with one small row per prefix computes each digest once."""
    wanted = sorted({(t[0], t[2]) for t in targets}, key=str)
    width = len(wanted[0][1])
    kind = df.schema[group].dataType.simpleString()
    table = df.sparkSession.createDataFrame(wanted, f"`{group}` {kind}, __prefix string")
    prefixed = df.select(group, digest, F.substring(digest, 1, width).alias("__prefix"))
    return prefixed.join(F.broadcast(table), [group, "__prefix"])
