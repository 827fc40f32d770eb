import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators import drift as D
from toolpulse.operators import lifecycle, splits
from toolpulse.operators import metrics as M
from toolpulse.operators import ranking
from toolpulse.operators.ranking import newest_rows, prefix_sums, row_numbers


# --- ranking ------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_range", [10_000, 40])
def test_prefix_sums_match_plain_window(spark, rows_per_range):
    rng = random.Random(1)
    rows = {("a" if rng.random() < 0.9 else "b", rng.randint(0, 500)): rng.randint(1, 9) for _ in range(900)}
    df = spark.createDataFrame([(k, v, n) for (k, v), n in rows.items()], "k string, v long, n long")
    got = prefix_sums(df, "k", "v", ["n"], lead=True, rows_per_range=rows_per_range).toPandas()
    want = df.toPandas().sort_values(["k", "v"])
    want["cum_n"] = want.groupby("k")["n"].cumsum()
    want["next_v"] = want.groupby("k")["v"].shift(-1)
    got = got.sort_values(["k", "v"]).reset_index(drop=True)[["k", "v", "n", "cum_n", "next_v"]]
    pd.testing.assert_frame_equal(got, want.reset_index(drop=True), check_dtype=False)


@pytest.mark.parametrize("rows_per_range", [10_000, 30])
@pytest.mark.parametrize("by", [None, "k"])
def test_row_numbers(spark, rows_per_range, by):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 700)
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in ids], "id long, k string")
    got = row_numbers(df, "id", "n", start=5, by=by, rows_per_range=rows_per_range).toPandas().sort_values("id")
    groups = got.groupby("k")["id"] if by else got["id"]
    assert (got["n"] == groups.rank().astype(int) + 4).all()


def test_ranges_keep_the_window_parallel(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("x"), F.col("id") % 1).alias("k"), F.lit(1).alias("n"))
    out = prefix_sums(df, "k", "id", ["n"], rows_per_range=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[.*windowspecdefinition\((k#\d+, )(__range#\d+)?", plan)
    assert any(by_range for _, by_range in windows)
    assert "SinglePartition" not in plan and "Cartesian" not in plan
    assert out.where("cum_n = id + 1").count() == 5000


def test_many_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("id"))
    got = row_numbers(df, "id", "n", rows_per_range=8).toPandas().sort_values("id")
    assert (got["n"] == range(1, 3001)).all()
    inside = ranking.in_ranges(df, "id", rows_per_range=8).groupBy("__range").count()
    inside = inside.agg(F.count("*"), F.max("count")).first()
    assert inside[0] > 350 and inside[1] < 30


@pytest.mark.parametrize("few", [5, 1_000_000])
def test_newest_rows_keep_nulls_last(spark, monkeypatch, few):
    """Rows without a time fill up what the others leave, at both scales; so do all-null tables."""
    monkeypatch.setattr(ranking, "FEW_ROWS", few)
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.timestamp_seconds(F.col("id") + 10**9)).alias("timestamp"))
    got = [r["id"] for r in newest_rows(df, 500, "timestamp", "id").collect()]
    assert got == [i for i in range(999, -1, -1) if i % 10 == 0] + [i for i in range(999, -1, -1) if i % 10][:400]
    none = df.where("timestamp IS NULL")
    assert [r["id"] for r in newest_rows(none, 3, "timestamp", "id").collect()] == [999, 998, 997]
    assert newest_rows(none.limit(0), 3, "timestamp", "id").count() == 0


@pytest.mark.parametrize("rows_per_range", [10_000, 20])
def test_statistics_of_own_features(spark, rows_per_range):
    """Features beyond the product's nine work at every size."""
    df = spark.range(300).select((F.col("id") % 100).cast("double").alias("own"), F.lit("x").alias("kind"))
    counts = D.value_counts(df, df.limit(0), numeric=["own"], categorical=["kind"]).cache()
    running = prefix_sums(counts.where("value IS NOT NULL"), "feature", "value", ["n_ref"], rows_per_range=rows_per_range)
    assert running.where("cum_n_ref = 3 * (value + 1)").count() == 100
    assert {r["feature"]: r["p50"] for r in D.data_summary(counts, "n_ref").collect()}["own"] == 49.5


@pytest.mark.parametrize("few", [5, 40])
def test_newest_rows_by_cut_off(spark, monkeypatch, few):
    """A third of the rows share one timestamp; the cut-off falls among them."""
    monkeypatch.setattr(ranking, "FEW_ROWS", few)
    rng = random.Random(11)
    rows = [(i, 1_700_000_000 + (500 if i % 3 == 0 else rng.randint(0, 1000))) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, s long").select("id", F.timestamp_seconds("s").alias("timestamp"))
    order = sorted(rows, key=lambda r: (r[1], r[0]), reverse=True)
    for n in (1, 10, 400, 899, 900, 2000):
        got = [r["id"] for r in newest_rows(df, n, "timestamp", "id").collect()]
        assert got == [i for i, _ in order[:n]]


# --- splits -------------------------------------------------------------------------


def test_stratified_split_and_folds_are_exact(spark):
    df = spark.range(3000).select(F.col("id").alias("udi"), F.when(F.col("id") % 30 == 0, "rare").otherwise("common").alias("label"))
    split = splits.with_test_flag(df, "label").toPandas()
    for _, part in split.groupby("label"):
        assert part["is_test"].sum() == splits.test_rows(len(part), 0.2)
    folds = splits.with_folds(df, "label", 7).toPandas()
    for _, part in folds.groupby("label"):
        sizes = part["fold"].value_counts()
        assert len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    again = splits.with_test_flag(df.repartition(5), "label").toPandas().set_index("udi")["is_test"]
    assert (split.set_index("udi")["is_test"].sort_index() == again.sort_index()).all()


def test_cuts_refine_crowded_prefixes(spark, monkeypatch):

    df = spark.range(4000).select(F.lit("all").alias("label"), F.col("id").alias("udi"))
    monkeypatch.setattr("toolpulse.operators.ranking.ROWS_PER_RANGE", 1)
    split = splits.with_test_flag(df, "label").toPandas()
    assert split["is_test"].sum() == 800


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "udi long, label string")
    got = splits.with_folds(df, "label", 3)
    assert got.where("fold between 0 and 2").count() == 3
    assert splits.with_test_flag(df, "label").where("is_test").count() == 0


# --- drift --------------------------------------------------------------------------


def frame(spark, values: dict):
    rows = list(zip(*[values[f] for f in S.FEATURES]))
    return spark.createDataFrame(rows, "type string, " + ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES))


def sample(rng, n, shift=0.0):
    values = {c: [round(rng.gauss(50 + shift, 5), 1) for _ in range(n)] for c in S.NUMERIC_FEATURES}
    values["type"] = [rng.choice("LLLMMH") for _ in range(n)]
    return values


def brute_force(ref, cur):
    grid = np.array(sorted(set(ref) | set(cur)))
    f = np.searchsorted(np.sort(ref), grid, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), grid, side="right") / len(cur)
    gap = np.abs(f - g)
    return gap.max(), float((gap[:-1] * np.diff(grid)).sum()) / max(np.std(ref), 0.001)


def test_statistics_match_brute_force(spark):
    rng = random.Random(3)
    ref, cur = sample(rng, 1500), sample(rng, 400, shift=1.0)
    counts = D.value_counts(frame(spark, ref), frame(spark, cur)).cache()
    stats = {r["feature"]: r for r in D.feature_statistics(counts).collect()}
    assert set(stats) == set(S.FEATURES)
    for c in S.NUMERIC_FEATURES:
        d, w = brute_force(ref[c], cur[c])
        assert stats[c]["ks_d"] == pytest.approx(d)
        assert stats[c]["wasserstein"] == pytest.approx(w)
    p = np.array([ref["type"].count(t) for t in "LMH"]) / 1500
    q = np.array([cur["type"].count(t) for t in "LMH"]) / 400
    m = (p + q) / 2
    js = math.sqrt(((p * np.log(p / m)).sum() + (q * np.log(q / m)).sum()) / 2)
    assert stats["type"]["jensen_shannon"] == pytest.approx(js)
    chi = ((q * 400 - p * 400) ** 2 / (p * 400)).sum()
    assert stats["type"]["chi_square"] == pytest.approx(chi)
    assert stats["type"]["chi_square_p"] == pytest.approx(math.exp(-chi / 2))


def test_statistics_with_many_ranges(spark, monkeypatch):
    rng = random.Random(4)
    ref, cur = sample(rng, 800), sample(rng, 300, shift=0.5)
    counts = D.value_counts(frame(spark, ref), frame(spark, cur)).cache()
    running = prefix_sums(counts.where("value is not null"), "feature", "value", ["n_ref", "n_cur"], lead=True, rows_per_range=20)
    plain = D.ecdf(counts)
    columns = plain.columns
    assert running.select(columns).exceptAll(plain).isEmpty() and running.count() == plain.count()


@pytest.mark.parametrize(
    "x, df, p",
    [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (9.487729, 4, 0.05), (11.0705, 5, 0.05), (0.0, 3, 1.0), (100.0, 7, 0.0)],
)
def test_chi_square_tail(spark, x, df, p):
    row = spark.range(1).select(D.chi_square_p(f"{x}D", str(df)).alias("p")).first()
    assert row["p"] == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("scaled, p", [(0.1, 1.0), (0.5, 0.963945), (1.0, 0.270000), (1.3581, 0.05), (3.0, 3.046e-8)])
def test_kolmogorov_tail(spark, scaled, p):
    # sqrt(n * n / (n + n)) = 100 for n = 20,000, which takes the limiting distribution
    row = spark.range(1).select(D.kolmogorov_p(f"{scaled / 100}D", "20000", "20000").alias("p")).first()
    assert row["p"] == pytest.approx(p, abs=1e-5)


def test_report_verdicts_and_guards(spark):
    rng = random.Random(5)
    ref = frame(spark, sample(rng, 1500))
    features, verdict = D.drift_report(ref, frame(spark, sample(rng, 1000, shift=20.0)))
    assert verdict.first()["verdict"] == "DRIFT"
    assert {r["test"] for r in features.collect()} == {D.WASSERSTEIN, D.JENSEN_SHANNON}
    assert D.drift_report(ref, ref)[1].first()["verdict"] == "PASS"
    few = D.drift_report(ref, ref.limit(10))[1].first()
    assert few["status"] == "LOW_SAMPLE"
    none = D.drift_report(ref, ref.limit(0))[1].first()
    assert (none["status"], none["verdict"]) == ("NO_DATA", None)


def test_small_reference_uses_p_values(spark):
    rng = random.Random(6)
    ref = sample(rng, 200)
    ref["tool_wear_minutes"] = [float(i % 2) for i in range(200)]
    ref["torque_nm"] = [float(i % 4) for i in range(200)]
    features = D.drift_features(frame(spark, ref), frame(spark, ref))
    tests = {r["feature"]: (r["test"], r["drifted"]) for r in features.collect()}
    assert tests["power_kw"] == (D.KS, False)
    assert tests["tool_wear_minutes"] == (D.Z_TEST, False)
    assert tests["torque_nm"] == (D.CHI_SQUARE, False)
    assert tests["type"] == (D.CHI_SQUARE, False)


def test_unseen_category_is_drift(spark):
    rng = random.Random(7)
    ref, cur = sample(rng, 300), sample(rng, 300)
    ref["type"] = [t if t != "H" else "L" for t in ref["type"]]
    row = D.drift_features(frame(spark, ref), frame(spark, cur)).where("feature = 'type'").first()
    assert row["drifted"] and row["value"] == 0.0


def test_summary_quartiles(spark):
    rng = random.Random(8)
    values = sample(rng, 333)
    df = frame(spark, values)
    rows = {r["feature"]: r for r in D.data_summary(D.value_counts(df, df.limit(0)).cache(), "n_ref").collect()}
    for c in S.NUMERIC_FEATURES:
        s = pd.Series(values[c])
        got = rows[c]
        assert [got[k] for k in ("mean", "std", "p25", "p50", "p75")] == pytest.approx(
            [s.mean(), s.std(), s.quantile(0.25), s.quantile(0.5), s.quantile(0.75)]
        )
    assert rows["type"]["top_category"] == "L"


# --- metrics ------------------------------------------------------------------------


def test_auc_with_ties_matches_pairs(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 1), rng.randint(0, 6) / 6) for _ in range(200)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(want)
    assert M.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_scores_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = M.binary_scores(M.confusion(df, "y", "p")).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_macro_scores_count_classes_of_either_side(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "y string, p string")
    row = M.macro_scores(M.confusion(df, "y", "p")).first()
    assert row["precision"] == pytest.approx((0.5 + 0 + 0) / 3)
    assert row["recall"] == pytest.approx((0.5 + 0 + 0) / 3)


def test_brier_multiclass_is_halved(spark):
    df = spark.createDataFrame([(0, [0.0, 1.0]), (1, [0.0, 1.0])], "y int, p array<double>")
    assert df.agg(M.brier_multiclass(F.col("y"), F.col("p"))).first()[0] == pytest.approx(0.5)


def test_best_trial_prefers_earlier_of_equals(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.5), (2, 0.5)], "trial int, mean_f1 double")
    assert M.best_trial(df).first()["trial"] == 1


# --- lifecycle ----------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_range", [10_000, 15])
def test_tool_cycles_across_ranges(spark, rows_per_range):
    rng = random.Random(10)
    rows, wear = [], {"hot": 0, "b": 90, "c": 10}
    for i in range(300):
        m = "hot" if rng.random() < 0.8 else rng.choice("bc")
        rows.append((i, m, float(wear[m]), rng.randint(0, 1)))
        wear[m] = 0 if wear[m] >= 100 else wear[m] + rng.randint(1, 30)
    df = spark.createDataFrame(rows, "id long, machine_id string, tool_wear_minutes double, injected_failure int")
    got = lifecycle.tool_cycles(df, rows_per_range=rows_per_range).toPandas()
    want = df.toPandas().sort_values("id")
    want["cycle"] = want.groupby("machine_id")["tool_wear_minutes"].transform(lambda w: (w.diff() < 0).cumsum())
    want = want.groupby(["machine_id", "cycle"]).agg(readings=("id", "size"), max_wear=("tool_wear_minutes", "max"), failures=("injected_failure", "sum")).reset_index()
    order = ["machine_id", "cycle"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True), want.sort_values(order).reset_index(drop=True), check_dtype=False)


def test_resample_draws_whole_rows(spark, training):
    draws = spark.range(500).withColumnRenamed("id", "draw")
    got = lifecycle.resample(draws, "draw", training, ["type", "torque_nm"])
    assert got.count() == 500
    assert got.select("udi", "type", "torque_nm").distinct().join(training, ["udi", "type", "torque_nm"], "left_anti").isEmpty()


def test_kept_baseline_gives_the_same_counts_and_is_not_read_again(spark, tmp_path):
    columns = "type string, " + ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES)
    rng = random.Random(8)
    rows = [(rng.choice("HLM"), *(float(rng.randint(0, 9)) for _ in S.NUMERIC_FEATURES)) for _ in range(300)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/reference")
    reference = spark.read.parquet(f"{tmp_path}/reference")
    current = spark.createDataFrame(rows[:90], columns)
    D.baseline_counts(reference).write.parquet(f"{tmp_path}/counts")
    merged = D.with_current(spark.read.parquet(f"{tmp_path}/counts"), current)
    assert merged.exceptAll(D.value_counts(reference, current).select(merged.columns)).isEmpty()
    assert merged.count() == D.value_counts(reference, current).count()
    assert f"{tmp_path}/reference" not in merged._jdf.queryExecution().executedPlan().toString()
