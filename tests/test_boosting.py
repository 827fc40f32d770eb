"""Boosting on histograms against plain numpy on the same rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from toolpulse.operators import boosting as B

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(7)
    n = 600
    rows = [
        (int(i), float(rng.integers(0, 30)), float(rng.normal()), float(i % 3), None if i % 50 == 0 else float(rng.integers(0, 4)))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "key long, a double, b double, c double, d double")
    label = (F.col("a") * 0.1 + F.col("b") + F.when(F.col("c") == 1, 1.0).otherwise(0.0) > 2.3).cast("int")
    kind = F.when(F.col("a") < 8, 0).when(F.col("b") > 0.4, 1).otherwise(2)
    return df.withColumns({"label": label, "kind": kind, "fold": (F.col("key") % 3).cast("int")}).cache()


def dense(rows, cuts, run):
    """The same trees from whole columns: no blocks, no subtraction, recursion over nodes."""
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    bins = np.stack([np.minimum(np.searchsorted(c, x[:, j]), len(c) - 1) for j, c in enumerate(cuts)], axis=1)
    label, fold = np.array([r["label"] for r in rows]), np.array([r["fold"] for r in rows])
    learn = np.ones(len(rows), bool) if run.held_fold is None else fold != run.held_fold
    sizes = {c: int((label[learn] == c).sum()) for c in range(run.classes)}
    margins = np.tile(B.start_margins(run, sizes), (len(rows), 1))
    for _ in range(run.trees):
        g, h = B.gradients(run, label, margins)
        step = np.zeros_like(margins)
        for k in range(run.margins):

            def grow(inside, depth):
                gs, hs = g[inside & learn, k].sum(), h[inside & learn, k].sum()
                best = (1e-9, None)
                for f in range(len(FEATURES)) if depth < run.depth else ():
                    for cut in range(len(cuts[f]) - 1):
                        low = inside & learn & (bins[:, f] <= cut)
                        high = inside & learn & ~low
                        if min(low.sum(), high.sum()) < run.min_rows:
                            continue
                        hl, hr = h[low, k].sum(), h[high, k].sum()
                        if min(hl, hr) < run.min_hessian:
                            continue
                        gain = 0.5 * (g[low, k].sum() ** 2 / (hl + run.l2) + g[high, k].sum() ** 2 / (hr + run.l2) - gs**2 / (hs + run.l2))
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, (f, cut))
                if best[1] is None:
                    step[inside, k] = -gs / (hs + run.l2) * run.rate
                    return
                f, cut = best[1]
                grow(inside & (bins[:, f] <= cut), depth + 1)
                grow(inside & (bins[:, f] > cut), depth + 1)

            grow(np.ones(len(rows), bool), 0)
        margins += step
    return margins


@pytest.fixture(params=[0, B.SHARED_ROWS], ids=["dealt", "shared"])
def both_ways(request, monkeypatch):
    """Rows in blocks on executors, and rows as one shared block."""
    monkeypatch.setattr(B, "SHARED_ROWS", request.param)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)


@pytest.mark.parametrize(
    "run, target",
    [
        (B.Boosting(trees=2, depth=3, rate=0.5), "label"),
        (B.Boosting(trees=2, depth=2, l2=0.0, min_rows=20, weights=(1.0, 4.0), held_fold=1), "label"),
        (B.Boosting(classes=3, trees=2, depth=3, min_hessian=1.0, held_fold=2), "kind"),
        (B.Boosting(classes=3, trees=2, depth=2, curvature=1.25, start=False, weights=(2.0, 1.0, 0.5)), "kind"),
    ],
)
def test_margins_equal_dense_growing(table, run, target, both_ways):
    rows = table.withColumn("label", F.col(target))
    cuts = B.cut_points(rows, FEATURES, 16)
    found = rows.collect()
    ensemble = B.boost(rows, FEATURES, [run], cuts)[0]
    model = B.BoostedTrees.of(ensemble, cuts)
    got = model.margins(np.array([[r[f] for f in FEATURES] for r in found]))
    assert np.allclose(got, dense(found, cuts, run), atol=1e-9)
    assert ensemble.grown == ensemble.kept == run.trees


def test_runs_grown_together_equal_runs_alone(table, monkeypatch):
    monkeypatch.setattr(B, "SHARED_ROWS", 0)
    cuts = B.cut_points(table, FEATURES, 16)
    runs = [
        B.Boosting(trees=3, depth=2, held_fold=0),
        B.Boosting(trees=5, depth=4, row_share=0.6, column_share=0.7, max_leaves=5, held_fold=1),
        B.Boosting(trees=2, depth=3, rate=0.1),
    ]
    together = B.boost(table, FEATURES, runs, cuts)
    for run, own in zip(runs, together):
        alone = B.boost(table, FEATURES, [run], cuts)[0]
        with monkeypatch.context() as shared:
            shared.setattr(B, "SHARED_ROWS", 10_000)
            same = B.boost(table, FEATURES, [run], cuts)[0]
        assert [[t.feature for t in r] for r in same.rounds] == [[t.feature for t in r] for r in own.rounds]
        assert [[t.feature for t in r] for r in alone.rounds] == [[t.feature for t in r] for r in own.rounds]
        assert alone.losses == pytest.approx(own.losses) and len(own.losses) == (run.held_fold is not None)
    assert max(len(t.feature) for r in together[1].rounds for t in r) == 2 * 5 - 1


def test_runs_in_groups_equal_runs_grown_together(table, monkeypatch):
    """Few margins at once and sums added up on executors first change nothing but last digits."""
    monkeypatch.setattr(B, "SHARED_ROWS", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    cuts = B.cut_points(table, FEATURES, 16)
    runs = [B.Boosting(trees=2, depth=3, held_fold=f, rate=r) for f in (0, 1) for r in (0.1, 0.5)]
    together = B.boost(table, FEATURES, runs, cuts)
    assert [len(g) for g in B._groups(together)] == [4]
    monkeypatch.setattr(B, "MARGINS_AT_ONCE", 3)
    monkeypatch.setattr(B, "SUMS_AT_ONCE", 0)
    assert [len(g) for g in B._groups(together)] == [3, 1]
    for one, other in zip(together, B.boost(table, FEATURES, runs, cuts), strict=True):
        assert one.run == other.run and one.losses == pytest.approx(other.losses)
        assert [[t.feature for t in r] for r in one.rounds] == [[t.feature for t in r] for r in other.rounds]


def test_patience_keeps_the_best_of_the_recorded_losses(table):
    flipped = F.when(F.xxhash64("key") % 3 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    noisy = table.withColumn("label", flipped)
    cuts = B.cut_points(noisy, FEATURES, 32)
    runs = [B.Boosting(trees=25, depth=4, rate=0.5, held_fold=f, patience=5) for f in range(3)]
    longer = [B.Boosting(trees=25, depth=4, rate=0.5, held_fold=f, patience=25) for f in range(3)]
    for run, own, whole in zip(runs, B.boost(noisy, FEATURES, runs, cuts), B.boost(noisy, FEATURES, longer, cuts)):
        best, waited, kept = whole.losses[0], 0, 0
        for i, loss in enumerate(whole.losses[1:], 1):
            if loss < best:
                best, waited, kept = loss, 0, i
            else:
                waited += 1
                if waited == run.patience:
                    break
        assert (own.kept, own.grown) == (kept, kept + run.patience) and own.grown < 25
        assert own.losses == pytest.approx(whole.losses[: own.grown + 1])
        assert len(B.BoostedTrees.of(own, cuts).trees[0]) == kept


def test_held_out_confusion_is_that_of_the_kept_trees(table, both_ways):
    cuts = B.cut_points(table, FEATURES, 16)
    rows = table.withColumn("label", F.col("kind"))
    run = B.Boosting(classes=3, trees=12, depth=2, held_fold=1, patience=3)
    with_trees, without = B.boost(rows, FEATURES, [run], cuts)[0], B.boost(rows, FEATURES, [run], cuts, keep_trees=False)[0]
    held = rows.where("fold = 1").collect()
    called = B.BoostedTrees.of(with_trees, cuts).margins(np.array([[r[f] for f in FEATURES] for r in held])).argmax(axis=1)
    wanted = np.zeros((3, 3), int)
    np.add.at(wanted, ([r["label"] for r in held], called), 1)
    assert (with_trees.confusion == wanted).all() and (without.confusion == wanted).all() and not without.rounds


def test_bins_hold_equal_values_together(spark):
    df = spark.createDataFrame([(float(v),) for v in [5] * 80 + list(range(20)) + [None] * 3 if v is not None] + [(None,)], "x double")
    (cuts,) = B.cut_points(df, ["x"], 10)
    values = sorted([5.0] * 80 + [float(v) for v in range(20)])
    steps = {v: values.index(v) * 10 // 100 for v in values}
    assert cuts.tolist() == sorted({s: max(v for v in steps if steps[v] == s) for s in steps.values()}.values())
    (empty,) = B.cut_points(df.where("x > 99"), ["x"], 10)
    assert empty.tolist() == [0.0]


def test_saved_trees_score_the_same(spark, table, tmp_path):
    from pyspark.ml.functions import array_to_vector

    cuts = B.cut_points(table, FEATURES, 16)
    for run, target in ((B.Boosting(trees=3, depth=3), "label"), (B.Boosting(classes=3, trees=2, depth=2), "kind")):
        rows = table.withColumn("label", F.col(target))
        model = B.BoostedTrees.of(B.boost(rows, FEATURES, [run], cuts)[0], cuts)
        model.save(spark, f"{tmp_path}/{target}")
        again = B.BoostedTrees.load(spark, f"{tmp_path}/{target}")
        scored = again.with_scores(rows.withColumn("features", array_to_vector(F.array(*FEATURES))), "p").collect()
        wanted = model.probabilities(np.array([[r[f] for f in FEATURES] for r in scored]))
        assert np.allclose(np.array([r["p"] for r in scored]), wanted) and wanted.shape[1] == run.margins


def test_one_class_and_no_rows(table):
    cuts = B.cut_points(table, FEATURES, 8)
    only = B.boost(table.withColumn("label", F.lit(0)), FEATURES, [B.Boosting(trees=2, depth=2)], cuts)[0]
    assert only.start == [0.0] and only.grown == 2
    with pytest.raises(ValueError):
        B.boost(table.where("false"), FEATURES, [B.Boosting()], cuts)
