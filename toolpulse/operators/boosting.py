"""Gradient boosting on histograms of gradients, many ensembles at once.

Features are put into bins once. A level of all trees that grow at the moment,
whatever their class, fold or trial, is one distributed sum of (gradient,
hessian, rows) by tree, node, feature and bin; the driver sees these sums, whose
size does not depend on the rows, and picks the splits. Of two children only
the one with fewer rows is summed, the other is the difference to the parent.

Rows live in blocks of bytes, kept by the executors between levels together
with the margins of the ensembles. A lost block is computed again from the one
of the round before; every ``CHECKPOINT_ROUNDS`` rounds that chain is cut by a
checkpoint in the shared folder.

Up to ``SHARED_ROWS`` rows, as in the training window, a job per level costs more
than its sums. Such rows are one block that every task gets, and each task
grows one ensemble by the same steps; classes of one ensemble need each other,
folds and trials do not.
"""

import json
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolpulse.operators.ranking import prefix_sums
from toolpulse.sources.durable import materialise, work_dir

BINS = 64
BLOCK_ROWS = 8192
CHECKPOINT_ROUNDS = 25
SHARED_ROWS = 200_000
# Beyond: rows of a partition of blocks, margins that all rows carry at once, and bytes of sums that the driver takes from a level.
PARTITION_ROWS = 8 * BLOCK_ROWS
MARGINS_AT_ONCE = 32
SUMS_AT_ONCE = 64 * 2**20
LEAF = -1


@dataclass(frozen=True)
class Boosting:
    """Settings of one ensemble; two classes share one margin, more have one each.

    Rows whose fold is ``held_fold`` are not learnt from; with ``patience`` their
    loss decides when to stop. ``weights`` are row weights by class. ``curvature``
    scales the hessian of several classes. ``row_share`` and ``column_share`` are
    drawn anew for every round, by hash.
    """

    classes: int = 2
    trees: int = 100
    depth: int = 6
    rate: float = 0.3
    l2: float = 1.0
    min_hessian: float = 1e-3
    min_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    max_leaves: int | None = None
    held_fold: int | None = None
    patience: int | None = None
    weights: tuple[float, ...] = ()
    curvature: float = 2.0
    start: bool = True
    seed: int = 42

    @property
    def margins(self) -> int:
        return 1 if self.classes == 2 else self.classes


# --- bins ---------------------------------------------------------------------------


def value_bins(df: DataFrame, features: list[str], bins: int = BINS) -> DataFrame:
    """``feature, bin, upper``: the greatest value of every bin that is in use.

    A value's bin is the share of rows below it, in ``bins`` steps, so bins hold
    about equally many rows and equal values stay together. Counts per distinct
    value come first; nothing else is shuffled.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    counts = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n"))
    counts = materialise(counts, "bin-counts")
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("n").alias("total")))  # one row per feature
    below = prefix_sums(counts, "feature", "value", ["n"]).withColumn("below", F.col("cum_n") - F.col("n"))
    step = F.floor(F.col("below") * bins / F.col("total")).cast("int")
    return below.join(totals, "feature").groupBy("feature", step.alias("bin")).agg(F.max("value").alias("upper"))


def cut_points(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending upper ends of the bins of every feature; at most ``bins`` each."""
    found: dict[str, list[float]] = {f: [] for f in features}
    for row in value_bins(df, features, bins).collect():
        found[row["feature"]].append(row["upper"])
    return [np.array(sorted(found[f]) or [0.0]) for f in features]


def _blocks(df: DataFrame, features: list[str], cuts: list[np.ndarray]):
    """RDD of (bins, label, fold, hash of the key) arrays; ``df`` has key, label and fold."""
    width = len(features)

    def pack(frames):
        for frame in frames:
            bins = np.empty((len(frame), width), dtype=np.uint8)
            for j, name in enumerate(features):
                value = frame[name].to_numpy(dtype=float)
                bins[:, j] = np.minimum(np.searchsorted(cuts[j], np.nan_to_num(value, nan=-np.inf)), len(cuts[j]) - 1)
            parts = [bins, frame["label"].to_numpy(np.int16), frame["fold"].to_numpy(np.int16), frame["key"].to_numpy(np.int64)]
            yield pd.DataFrame([[p.tobytes() for p in parts]], columns=["bins", "label", "fold", "key"])

    def unpack(row):
        return (
            np.frombuffer(row["bins"], np.uint8).reshape(-1, width),
            np.frombuffer(row["label"], np.int16),
            np.frombuffer(row["fold"], np.int16),
            np.frombuffer(row["key"], np.int64).astype(np.uint64),
        )

    return df.mapInPandas(pack, "bins binary, label binary, fold binary, key binary").rdd.map(unpack)


# --- trees --------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order they were made; children are neighbours and ``left`` is the first."""

    feature: list[int] = field(default_factory=lambda: [LEAF])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, at: int, gain: float) -> int:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, at, len(self.feature), gain
        for column, empty in ((self.feature, LEAF), (self.bin, 0), (self.left, 0), (self.value, 0.0), (self.gain, 0.0), (self.rows, 0)):
            column.extend([empty, empty])
        return self.left[node]

    def arrays(self):
        return np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.value)


def nodes_of(tree, bins: np.ndarray, depth: int, at: np.ndarray | None = None) -> np.ndarray:
    """The node every row is in after ``depth`` steps from ``at`` (the root)."""
    feature, cut, left, _ = tree
    at = np.zeros(len(bins), dtype=np.int64) if at is None else at
    rows = np.arange(len(bins))
    for _ in range(depth):
        own = feature[at]
        inner = own >= 0
        if not inner.any():
            break
        at = np.where(inner, left[at] + (bins[rows, np.maximum(own, 0)] > cut[at]), at)
    return at


def _drawn(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number from 0 to 1 per key, by a mixing hash."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64(seed % (1 << 63)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


def _probabilities(run: Boosting, margins: np.ndarray) -> np.ndarray:
    if run.margins == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(margins, -500, 500)))
    raised = np.exp(margins - margins.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _weights(run: Boosting, label: np.ndarray) -> np.ndarray:
    return np.array(run.weights)[label] if run.weights else np.ones(len(label))


def gradients(run: Boosting, label: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted log loss by margin."""
    p, w = _probabilities(run, margins), _weights(run, label)[:, None]
    hit = label[:, None] == (np.array([1]) if run.margins == 1 else np.arange(run.classes))
    curve = 1.0 if run.margins == 1 else run.curvature
    return w * (p - hit), np.maximum(curve * w * p * (1 - p), 1e-16)


def log_loss(run: Boosting, label: np.ndarray, margins: np.ndarray) -> float:
    p = _probabilities(run, margins)
    own = np.where(label == 1, p[:, 0], 1 - p[:, 0]) if run.margins == 1 else p[np.arange(len(label)), label]
    return float(-(_weights(run, label) * np.log(np.maximum(own, 1e-15))).sum())


# --- one round ----------------------------------------------------------------------


@dataclass
class _Layout:
    """Places of all features' bins in a node's histogram."""

    sizes: list[int]

    def __post_init__(self):
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    @property
    def cells(self) -> int:
        return int(self.starts[-1])


def _learning(block, margins, run: Boosting, first: int, round_no: int, layout: _Layout):
    """Bins, histogram cells and derivatives of the rows that a run learns from in a round."""
    bins, label, fold, keys = block
    take = np.ones(len(label), dtype=bool) if run.held_fold is None else fold != run.held_fold
    if run.row_share < 1:
        take &= _drawn(keys, run.seed * 100_003 + round_no) < run.row_share
    g, h = gradients(run, label[take], margins[take, first : first + run.margins])
    rows = bins[take]
    return rows, rows + layout.starts[:-1].astype(np.int32), g, h


def _histograms(block, margins, runs, first, round_no, growing, layout: _Layout, measured: list[int], kept: dict | None = None) -> np.ndarray:
    """Sums of a block, flat: per growing tree (slots, cells, 3), then loss, weight and confusion of the runs to measure.

    ``kept`` carries what a round's levels have in common from call to call.
    """
    _, label, fold, _ = block
    kept = {} if kept is None else kept
    if kept.get("round") != round_no:
        kept.clear()
        kept["round"] = round_no
    out = []
    for r, models in growing:
        if r not in kept:
            kept[r] = _learning(block, margins, runs[r], first[r], round_no, layout)
        rows, cells, g, h = kept[r]
        width = rows.shape[1]
        for k, tree, slot_of, slots, depth in models:
            done, at = kept.get((r, k), (0, None))
            at = nodes_of(tree, rows, depth - done, at)
            kept[(r, k)] = (depth, at)
            slot = slot_of[at]
            inside = np.flatnonzero(slot >= 0)
            place = (cells[inside] + (slot[inside] * layout.cells)[:, None]).ravel()
            size = slots * layout.cells
            sums = np.empty((size, 3))
            for c, value in enumerate((g[inside, k], h[inside, k])):
                sums[:, c] = np.bincount(place, np.repeat(value, width), minlength=size)
            sums[:, 2] = np.bincount(place, minlength=size)
            out.append(sums.ravel())
    for r in measured:
        run = runs[r]
        held = fold == run.held_fold
        own, truth = margins[held, first[r] : first[r] + run.margins], label[held]
        called = (own[:, 0] > 0).astype(int) if run.margins == 1 else own.argmax(axis=1)
        hits = np.bincount(truth * run.classes + called, minlength=run.classes**2)
        out.append(np.concatenate([[log_loss(run, truth, own), _weights(run, truth).sum()], hits]))
    return np.concatenate(out) if out else np.zeros(0)


def best_splits(hist: np.ndarray, run: Boosting, layout: _Layout, columns: np.ndarray):
    """Per slot (gain, feature, bin, sums left of it): the greatest gain, ties to the first feature and bin.

    ``hist`` is (slots, cells, 3). Gain is half the growth of sum(G² / (H + l2)).
    """
    slots = len(hist)
    best = np.full(slots, 0.0)
    feature, at, left = np.full(slots, LEAF), np.zeros(slots, dtype=int), np.zeros((slots, 3))
    for f in np.flatnonzero(columns):
        part = hist[:, layout.starts[f] : layout.starts[f + 1]]
        if part.shape[1] < 2:
            continue
        below = part.cumsum(axis=1)
        total = below[:, -1:]
        lower, upper = below[:, :-1], total - below[:, :-1]
        gain = 0.5 * sum(
            sign * np.divide(side[..., 0] ** 2, side[..., 1] + run.l2, out=np.zeros(side.shape[:2]), where=side[..., 2] > 0)
            for sign, side in ((1, lower), (1, upper), (-1, total))
        )
        fit = (np.minimum(lower[..., 1], upper[..., 1]) >= run.min_hessian) & (
            np.minimum(lower[..., 2], upper[..., 2]) >= max(run.min_rows, 1)
        )
        gain = np.where(fit, gain, -np.inf)
        place = gain.argmax(axis=1)
        top = gain[np.arange(slots), place]
        better = top > np.maximum(best * (1 + 1e-12), 1e-9)
        best[better], feature[better], at[better] = top[better], f, place[better]
        left[better] = lower[better, place[better]]
    return best, feature, at, left


class _Growing:
    """One tree of one run while it grows."""

    def __init__(self, run: Boosting, columns: np.ndarray):
        self.run, self.columns, self.tree = run, columns, Tree()
        self.depth = 0
        self.asked = [0]  # nodes whose histogram the next level sums
        self.pairs: list[tuple[int, int, np.ndarray]] = []  # asked node, its sibling, parent's histogram
        self.leaves = 1

    def request(self, k: int):
        slot_of = np.full(len(self.tree.feature), -1)
        slot_of[self.asked] = np.arange(len(self.asked))
        return k, self.tree.arrays(), slot_of, len(self.asked), self.depth

    def level(self, hist: np.ndarray, layout: _Layout) -> None:
        """Take the sums of the asked nodes, split what gains, and ask for the next level."""
        nodes, hists = list(self.asked), list(hist)
        for (_, sibling, parent), own in zip(self.pairs, hist):
            nodes.append(sibling)
            hists.append(parent - own)
        stacked = np.stack(hists)
        if not self.depth:
            first = stacked[0, layout.starts[0] : layout.starts[1]].sum(axis=0)
            self._set(0, first)
        gain, feature, at, left = best_splits(stacked, self.run, layout, self.columns)
        order = [i for i in np.argsort(-gain, kind="stable") if feature[i] != LEAF]
        if self.run.max_leaves is not None:
            order = order[: max(self.run.max_leaves - self.leaves, 0)]
        self.asked, self.pairs = [], []
        self.depth += 1
        for i in sorted(order, key=lambda i: nodes[i]):
            child = self.tree.split(nodes[i], int(feature[i]), int(at[i]), float(gain[i]))
            total = stacked[i, layout.starts[0] : layout.starts[1]].sum(axis=0)
            self._set(child, left[i])
            self._set(child + 1, total - left[i])
            small, large = (child, child + 1) if left[i][2] <= total[2] - left[i][2] else (child + 1, child)
            self.asked.append(small)
            self.pairs.append((small, large, stacked[i]))
        self.leaves += len(order)
        if self.depth >= self.run.depth:
            self.asked, self.pairs = [], []

    def _set(self, node: int, sums: np.ndarray) -> None:
        self.tree.value[node] = float(-sums[0] / (sums[1] + self.run.l2) * self.run.rate)
        self.tree.rows[node] = int(round(sums[2]))


# --- training -----------------------------------------------------------------------


@dataclass
class Ensemble:
    """Trees by round and margin, the start margins, and what was measured on the held-out rows.

    With patience that is before every round and at the end, else at the end.
    """

    run: Boosting
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)
    grown: int = 0
    losses: list[float] = field(default_factory=list)
    confusions: list[np.ndarray] = field(default_factory=list)  # (truth, called) of the held-out rows

    @property
    def kept(self) -> int:
        """Rounds up to the least held-out loss, where patience was asked for; else all."""
        return self.grown if self.run.patience is None else best_round(self.losses)

    @property
    def confusion(self) -> np.ndarray:
        """Of the held-out rows by the rounds that are kept."""
        return self.confusions[-1] if self.run.patience is None else self.confusions[self.kept]

    def measured(self, sums: np.ndarray) -> None:
        self.losses.append(float(sums[0] / max(sums[1], 1e-300)))
        self.confusions.append(np.rint(sums[2:]).astype(int).reshape(self.run.classes, self.run.classes))


def best_round(losses: list[float]) -> int:
    """Trees before the first of the least losses; ``losses[i]`` is measured with i trees."""
    return int(np.argmin(losses))


def out_of_patience(losses: list[float], patience: int) -> bool:
    return len(losses) - 1 - best_round(losses) >= patience


def start_margins(run: Boosting, sizes: dict[int, int]) -> list[float]:
    """Log odds (or log shares) of the weighted classes, zero where a class is missing."""
    if not run.start:
        return [0.0] * run.margins
    weight = [sizes.get(c, 0) * (run.weights[c] if run.weights else 1.0) for c in range(run.classes)]
    total = sum(weight)
    if run.margins == 1:
        return [float(np.log(weight[1] / weight[0])) if weight[0] and weight[1] else 0.0]
    return [float(np.log(max(w, 1e-9 * total) / total)) if total else 0.0 for w in weight]


def _columns(run: Boosting, width: int, round_no: int) -> np.ndarray:
    if run.column_share >= 1:
        return np.ones(width, dtype=bool)
    draw = _drawn(np.arange(width, dtype=np.uint64), run.seed * 7_919 + round_no + 1)
    chosen = np.zeros(width, dtype=bool)
    chosen[np.argsort(draw)[: max(1, round(run.column_share * width))]] = True
    return chosen


def boost(rows: DataFrame, features: list[str], runs: list[Boosting], cuts: list[np.ndarray], keep_trees: bool = True) -> list[Ensemble]:
    """Train all ``runs`` on ``key, label, fold`` and the feature columns of ``rows``.

    Labels are whole numbers from 0, keys are unique longs; ``fold`` may be null
    where no run holds one out. Without ``keep_trees`` only what was measured
    on the held-out folds is returned. Results do not depend on how the rows
    are dealt out, but for the last digits of sums.
    """
    context = rows.sparkSession.sparkContext
    kept = rows.select("key", F.col("label").cast("int").alias("label"), F.coalesce("fold", F.lit(-1)).alias("fold"), *features)
    sizes = {(r["fold"], r["label"]): r["count"] for r in kept.groupBy("fold", "label").count().collect()}
    total = sum(sizes.values())
    if not total:
        raise ValueError("no rows to learn from")
    layout = _Layout([len(c) for c in cuts])
    ensembles = []
    for run in runs:
        own: dict[int, int] = {}
        for (fold, label), n in sizes.items():
            own[label] = own.get(label, 0) + n * (fold != run.held_fold)
        ensembles.append(Ensemble(run, start_margins(run, own)))
    if total <= SHARED_ROWS:
        parts = _blocks(kept, features, cuts).collect()  # a few bytes per row, of SHARED_ROWS at most
        block = tuple(np.concatenate(columns) for columns in zip(*parts))
        # By key, so that sums do not depend on the order of arrival.
        order = np.argsort(block[3], kind="stable")
        shared = context.broadcast(tuple(c[order] for c in block))

        def alone(ensemble: Ensemble) -> Ensemble:
            return _grown([ensemble], layout, len(features), _Shared(shared.value, [ensemble], layout), keep_trees)[0]

        return context.parallelize(ensembles, len(ensembles)).map(alone).collect()  # as large as the models
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{work_dir(rows.sparkSession)}/checkpoints")
    parts = max(-(-total // PARTITION_ROWS), min(context.defaultParallelism, -(-total // BLOCK_ROWS)))
    kept = materialise(kept.repartition(parts, "key"), "boosting-rows")
    # Ensembles do not need each other; a search of many would make rows of as many margins and levels of as many sums.
    grown = []
    for some in _groups(ensembles):
        grown += _grown(some, layout, len(features), _Dealt(_blocks(kept, features, cuts), some, layout), keep_trees)
    return grown


def _groups(ensembles: list[Ensemble]) -> list[list[Ensemble]]:
    """The ensembles in turn, with at most ``MARGINS_AT_ONCE`` margins together, one ensemble at least."""
    groups: list[list[Ensemble]] = []
    for e in ensembles:
        if not groups or sum(g.run.margins for g in groups[-1]) + e.run.margins > MARGINS_AT_ONCE:
            groups.append([])
        groups[-1].append(e)
    return groups


def _grown(ensembles: list[Ensemble], layout: _Layout, width: int, rows, keep_trees: bool) -> list[Ensemble]:
    """Grow all ensembles in step on ``rows``, which sums over rows and moves their margins."""
    runs = [e.run for e in ensembles]
    active = [r for r, run in enumerate(runs) if run.trees > 0]
    round_no = 0
    while active:
        growing = {r: [_Growing(runs[r], _columns(runs[r], width, round_no)) for _ in range(runs[r].margins)] for r in active}
        watched = [r for r in active if runs[r].patience is not None]
        while asked := [(r, models) for r in active if (models := [g.request(k) for k, g in enumerate(growing[r]) if g.asked])]:
            sums = rows.summed(round_no, asked, watched)
            at = 0
            for r, models in asked:
                for k, _, _, slots, _ in models:
                    size = slots * layout.cells * 3
                    growing[r][k].level(sums[at : at + size].reshape(slots, layout.cells, 3), layout)
                    at += size
            at = _take_measures(ensembles, watched, sums, at)
            active = [r for r in active if r not in watched or not out_of_patience(ensembles[r].losses, runs[r].patience)]
            watched = []
        made = [(r, [g.tree for g in growing[r]]) for r in active]
        for r, trees in made:
            ensembles[r].grown += 1
            if keep_trees:
                ensembles[r].rounds.append(trees)
        rows.advance(round_no, made)
        round_no += 1
        finished = [r for r in active if ensembles[r].grown >= runs[r].trees]
        held = [r for r in finished if runs[r].held_fold is not None]
        if held:
            _take_measures(ensembles, held, rows.summed(round_no, [], held), 0)
        active = [r for r in active if r not in finished]
    rows.close()
    return ensembles


def _take_measures(ensembles: list[Ensemble], of: list[int], sums: np.ndarray, at: int) -> int:
    for r in of:
        size = 2 + ensembles[r].run.classes ** 2
        ensembles[r].measured(sums[at : at + size])
        at += size
    return at


class _Rows:
    """Places of the ensembles' margins among the columns of a block's margins."""

    def __init__(self, ensembles: list[Ensemble], layout: _Layout):
        self.runs, self.layout = [e.run for e in ensembles], layout
        self.first = np.concatenate([[0], np.cumsum([run.margins for run in self.runs])]).astype(int)
        self.start = np.array([m for e in ensembles for m in e.start])

    def steps(self, made) -> list[tuple]:
        return [(int(self.first[r]) + k, self.runs[r].depth, t.arrays()) for r, trees in made for k, t in enumerate(trees)]


def _moved(bins: np.ndarray, margins: np.ndarray, steps: list[tuple]) -> np.ndarray:
    margins = margins.copy()
    for column, depth, tree in steps:
        margins[:, column] += tree[3][nodes_of(tree, bins, depth)]
    return margins


class _Shared(_Rows):
    """All rows in one block, held by the task that grows the ensemble."""

    def __init__(self, block, ensembles: list[Ensemble], layout: _Layout):
        super().__init__(ensembles, layout)
        self.block, self.margins, self.kept = block, np.tile(self.start, (len(block[1]), 1)), {}

    def summed(self, round_no: int, asked, measured) -> np.ndarray:
        return _histograms(self.block, self.margins, self.runs, self.first, round_no, asked, self.layout, measured, self.kept)

    def advance(self, round_no: int, made) -> None:
        self.margins = _moved(self.block[0], self.margins, self.steps(made))

    def close(self) -> None:
        self.kept = {}


class _Dealt(_Rows):
    """Blocks on the executors; a level is one job."""

    def __init__(self, blocks, ensembles: list[Ensemble], layout: _Layout):
        super().__init__(ensembles, layout)
        start = self.start
        self.state = blocks.map(lambda block: (block, np.tile(start, (len(block[1]), 1)))).persist(StorageLevel.MEMORY_AND_DISK)
        self.older = None

    def summed(self, round_no: int, asked, measured) -> np.ndarray:
        runs, first, layout = self.runs, self.first, self.layout

        def sums(pairs):
            total = None
            for block, margins in pairs:
                own = _histograms(block, margins, runs, first, round_no, asked, layout, measured)
                total = own if total is None else total + own
            if total is not None:
                yield total

        parts = self.state.getNumPartitions()
        slots = sum(model[3] for _, models in asked for model in models)
        few = parts <= 64 and parts * slots * layout.cells * 3 * 8 <= SUMS_AT_ONCE
        return self.state.mapPartitions(sums).treeReduce(np.add, depth=1 if few else 2)

    def advance(self, round_no: int, made) -> None:
        """Margins with the new trees; the state before stays until these are computed."""
        steps = self.steps(made)
        new = self.state.map(lambda pair: (pair[0], _moved(pair[0][0], pair[1], steps))).persist(StorageLevel.MEMORY_AND_DISK)
        if round_no % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
            new.checkpoint()
        if self.older is not None:
            self.older.unpersist()
        self.older, self.state = self.state, new

    def close(self) -> None:
        for rdd in (self.state, self.older):
            if rdd is not None:
                rdd.unpersist()


# --- a trained ensemble on rows -------------------------------------------------------


@dataclass
class BoostedTrees:
    """Scores rows with a ``features`` vector; thresholds are values again, not bins."""

    classes: int
    start: list[float]
    trees: list[list[tuple[list[int], list[float], list[int], list[float]]]]  # per margin: feature, threshold, left, value

    @classmethod
    def of(cls, ensemble: Ensemble, cuts: list[np.ndarray]) -> "BoostedTrees":
        per_margin = [
            [
                (t.feature, [float(cuts[f][b]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)], t.left, t.value)
                for t in (made[k] for made in ensemble.rounds[: ensemble.kept])
            ]
            for k in range(ensemble.run.margins)
        ]
        return cls(ensemble.run.classes, ensemble.start, per_margin)

    def margins(self, rows: np.ndarray) -> np.ndarray:
        out = np.tile(np.array(self.start), (len(rows), 1))
        index = np.arange(len(rows))
        for k, trees in enumerate(self.trees):
            for feature, threshold, left, value in trees:
                feature, threshold, left = np.asarray(feature), np.asarray(threshold), np.asarray(left)
                at = np.zeros(len(rows), dtype=np.int64)
                while (inner := feature[at] >= 0).any():
                    at = np.where(inner, left[at] + (rows[index, np.maximum(feature[at], 0)] > threshold[at]), at)
                out[:, k] += np.asarray(value)[at]
        return out

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Of class 1 alone for two classes, else of every class."""
        return _probabilities(Boosting(classes=self.classes), self.margins(rows))

    def with_scores(self, df: DataFrame, name: str) -> DataFrame:
        """Adds the probabilities as an array."""
        shared = df.sparkSession.sparkContext.broadcast(self)  # trees times leaves, whatever the rows

        @F.pandas_udf("array<double>")
        def score(vectors: pd.Series) -> pd.Series:
            if vectors.empty:
                return pd.Series([], dtype=object)
            return pd.Series(list(shared.value.probabilities(np.vstack(vectors.to_numpy()))))

        return df.withColumn(name, score(vector_to_array("features")))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (k, t, [int(v) for v in feature], [float(v) for v in threshold], [int(v) for v in left], [float(v) for v in value])
            for k, trees in enumerate(self.trees)
            for t, (feature, threshold, left, value) in enumerate(trees)
        ]
        schema = "margin int, tree int, feature array<int>, threshold array<double>, left array<int>, value array<double>"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/trees")
        meta = json.dumps({"classes": self.classes, "start": self.start})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/boosted")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedTrees":
        meta = json.loads(spark.read.text(f"{path}/boosted").first()["value"])
        trees: list[list] = [[] for _ in meta["start"]]
        for r in spark.read.parquet(f"{path}/trees").orderBy("margin", "tree").collect():  # as large as the model
            trees[r["margin"]].append((r["feature"], r["threshold"], r["left"], r["value"]))
        return cls(meta["classes"], meta["start"], trees)


def tree_rows(tree: Tree, features: list[str], cuts: list[np.ndarray], rate: float = 1.0) -> list[tuple]:
    """(path, feature, threshold, gain, row_count, value) of every node; rows up to the threshold go left.

    A path is the letters L and R from the root; ``value`` is without the learning ``rate``.
    """
    out, paths = [], {0: ""}
    for node, (f, at, left) in enumerate(zip(tree.feature, tree.bin, tree.left)):
        inner = f != LEAF
        if inner:
            paths[left], paths[left + 1] = paths[node] + "L", paths[node] + "R"
        name, threshold, gain = (features[f], float(cuts[f][at]), tree.gain[node]) if inner else (None, None, None)
        out.append((paths[node], name, threshold, gain, tree.rows[node], tree.value[node] / rate))
    return out
