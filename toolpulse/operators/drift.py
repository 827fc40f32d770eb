"""Distribution drift between a frozen reference and current readings.

Both sides are reduced once to counts per distinct feature value. That pass
combines on the map side, so a value that fills a third of the log costs no
more than any other. Everything else works on the counts.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators.ranking import prefix_sums
from toolpulse.sources.durable import materialise

WASSERSTEIN = "wasserstein_distance"
JENSEN_SHANNON = "jensen_shannon_distance"
KS = "ks_p_value"
CHI_SQUARE = "chi_square_p_value"
Z_TEST = "z_p_value"


# --- counts -------------------------------------------------------------------


def unpivot_features(
    df: DataFrame, *keep: str, numeric: list[str] = S.NUMERIC_FEATURES, categorical: list[str] = S.CATEGORICAL_FEATURES
) -> DataFrame:
    """One row per feature: ``f, category, value``; ``f`` is the place in ``categorical + numeric``."""
    parts = [f"`{c}`, cast(null as double)" for c in categorical]
    parts += [f"cast(null as string), cast(`{c}` as double)" for c in numeric]
    rows = ", ".join(f"{i}, {part}" for i, part in enumerate(parts, 1))
    return df.selectExpr(*keep, f"stack({len(parts)}, {rows}) as (f, category, value)")


def name_features(df: DataFrame, numeric=S.NUMERIC_FEATURES, categorical=S.CATEGORICAL_FEATURES) -> DataFrame:
    names = F.array(*[F.lit(c) for c in [*categorical, *numeric]])
    return df.select(F.element_at(names, F.col("f")).alias("feature"), *[c for c in df.columns if c != "f"])


def value_counts(reference: DataFrame, current: DataFrame, **features) -> DataFrame:
    """``feature, category, value, n_ref, n_cur`` for every distinct value of either side."""
    ref = unpivot_features(reference, "1 as r", "0 as c", **features)
    cur = unpivot_features(current, "0 as r", "1 as c", **features)
    counts = ref.union(cur).groupBy("f", "category", "value").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"))
    return name_features(counts, **features)


def baseline_counts(reference: DataFrame, **features) -> DataFrame:
    """``feature, category, value, n_ref`` of a frozen baseline, to be kept beside it."""
    rows = unpivot_features(reference, **features).groupBy("f", "category", "value").agg(F.count("*").alias("n_ref"))
    return name_features(rows, **features)


def with_current(baseline: DataFrame, current: DataFrame, **features) -> DataFrame:
    """Kept baseline counts and those of a current sample, as ``value_counts`` gives them; the baseline is not counted again."""
    own = name_features(unpivot_features(current, "cast(0 as long) as n_ref", "cast(1 as long) as n_cur", **features), **features)
    held = baseline.withColumn("n_cur", F.lit(0).cast("long"))
    keys = ["feature", "category", "value"]
    return own.unionByName(held).groupBy(*keys).agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def ecdf(counts: DataFrame) -> DataFrame:
    """Running counts of both samples over the distinct values of each numeric feature."""
    numeric = counts.where(F.col("value").isNotNull())
    return prefix_sums(numeric, "feature", "value", ["n_ref", "n_cur"], lead=True)


# --- p-values -----------------------------------------------------------------


# These take and combine SQL text: one parsed expression is far cheaper to build
# than hundreds of Column calls. A one-element transform() names a value once.


EXACT_CELLS = 10_000_000


def exact_kolmogorov_p(d: str, n_ref: str, n_cur: str) -> str:
    """SQL for the chance that two samples of one distribution are at least ``d`` apart.

    Merging two samples in order is a lattice path. ``p`` holds, for one number
    of steps and by steps of the smaller sample, the share of paths that have
    stayed closer than ``d`` so far; every step makes it from the one before.
    """
    inside = f"abs(i * big - (step - i) * small) < round(({d}) * small * big)"
    reached = "p[i] * (step - i) / step + if(i > 0, p[i - 1] * i / step, 0D)"
    follow = f"transform(sequence(0L, small), i -> if(step - i BETWEEN 0 AND big AND {inside}, {reached}, 0D))"
    start = "transform(sequence(0L, small), i -> if(i = 0, 1D, 0D))"
    paths = f"aggregate(sequence(1L, small + big), {start}, (p, step) -> {follow})[small]"
    return f"""transform(array(least({n_ref}, {n_cur})), small -> transform(array(greatest({n_ref}, {n_cur})),
        big -> if(round(({d}) * small * big) <= 0, 1D, greatest(0D, 1D - {paths})))[0])[0]"""


def kolmogorov_p(d: str, n_ref: str, n_cur: str) -> Column:
    """Two-sample KS p-value: exact for small samples, else from the limiting distribution (100 terms).

    The exact one takes as many steps as the product of the sizes, up to
    ``EXACT_CELLS``. Below 0.2 the limit is 1 to twelve digits and its series is slow.
    """
    scaled = f"({d}) * sqrt(try_divide(({n_ref}) * ({n_cur}), ({n_ref}) + ({n_cur})))"
    term = "if(k % 2 = 1, 1D, -1D) * exp(-2D * k * k * x * x)"
    series = f"2D * aggregate(sequence(1, 100), 0D, (total, k) -> total + {term})"
    small = f"({n_ref}) > 0 AND ({n_cur}) > 0 AND double({n_ref}) * ({n_cur}) <= {EXACT_CELLS}"
    long = [f"cast({n} AS bigint)" for n in (n_ref, n_cur)]
    return F.expr(
        f"""CASE WHEN ({d}) IS NOT NULL AND {small} THEN {exact_kolmogorov_p(d, *long)} ELSE
        transform(array({scaled}), x -> CASE WHEN x IS NULL THEN NULL WHEN x < 0.2 THEN 1D
        ELSE least(1D, greatest(0D, {series})) END)[0] END"""
    )


def _running_product(start: str, factor: str, terms: str) -> str:
    """SQL for start + start*f(1) + start*f(1)*f(2) + ... over the indices in ``terms``."""
    step = f"a.term * ({factor})"
    return f"""aggregate({terms}, named_struct('term', {start}, 'total', {start}),
        (a, i) -> named_struct('term', {step}, 'total', a.total + {step}), a -> a.total)"""


def chi_square_p(statistic: str, df: str) -> Column:
    """Upper tail of the chi-squared distribution for whole degrees of freedom.

    Closed forms: a finite sum for an even number, erfc plus a finite sum for
    an odd one. Far out the tail is zero in double precision.
    """
    root_pi = repr(2.0 / math.sqrt(math.pi)) + "D"
    below = "filter(sequence(0, int(s.k div 2)), i -> i >= 1 AND i < s.k div 2)"
    even = _running_product("1D", "s.h / i", below)
    odd = _running_product(f"{root_pi} * sqrt(s.h)", "s.h / (i + 0.5D)", below)
    erf = _running_product("sqrt(s.h)", "2D * s.h / (2D * i + 1D)", "sequence(1, 250)")
    erfc = f"if(s.h > 49, 0D, greatest(0D, 1D - {root_pi} * exp(-s.h) * {erf}))"
    return F.expr(
        f"""transform(array(named_struct('h', least({statistic}, 1400D) / 2D, 'k', {df}, 'x', {statistic})),
        s -> CASE WHEN s.k < 1 THEN 1D WHEN s.x > 1400 THEN 0D
          WHEN s.k % 2 = 0 THEN least(1D, exp(-s.h) * {even})
          WHEN s.k = 1 THEN {erfc}
          ELSE least(1D, {erfc} + exp(-s.h) * {odd}) END)[0]"""
    )


# --- statistics per feature ---------------------------------------------------


def _share_terms() -> list[Column]:
    """Aggregates that work on counts per value; ``big_r`` and ``big_c`` are the sample sizes."""
    p, q = "try_divide(n_ref, big_r)", "try_divide(n_cur, big_c)"
    middle = f"(({p} + {q}) / 2D)"
    divergence = f"if(n_ref > 0, {p} * ln({p} / {middle}), 0D) + if(n_cur > 0, {q} * ln({q} / {middle}), 0D)"
    expected = f"({p} * big_c)"
    miss = f"""CASE WHEN {expected} > 0 THEN (n_cur - {expected}) * (n_cur - {expected}) / {expected}
        WHEN n_cur > 0 THEN double('Infinity') ELSE 0D END"""
    pooled = "try_divide(n_ref + n_cur, big_r + big_c)"
    spread = f"({pooled} * (1D - {pooled}) * (try_divide(1D, big_r) + try_divide(1D, big_c)))"
    return [
        F.expr(f"sqrt(greatest(0D, sum({divergence}) / 2D))").alias("jensen_shannon"),
        F.expr(f"sum({miss})").alias("chi_square"),
        F.expr(f"max(try_divide(({p} - {q}) * ({p} - {q}), {spread}))").alias("z_square"),
    ]


def sample_sizes(counts: DataFrame) -> DataFrame:
    """Rows with a value, distinct values and reference mean, per feature."""
    present = F.col("category").isNotNull() | F.col("value").isNotNull()
    return (
        counts.where(present)
        .groupBy("feature")
        .agg(
            F.sum("n_ref").alias("big_r"),
            F.sum("n_cur").alias("big_c"),
            F.count("*").alias("distinct_all"),
            F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
            F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("mean_ref"),
        )
    )


SIZE_KEYS = ["feature", "big_r", "big_c", "distinct_all", "distinct_ref"]


def numeric_statistics(counts: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """KS, normalised Wasserstein and share statistics; one row per numeric feature."""
    running = ecdf(counts).join(F.broadcast(sizes or held_sizes(counts)), "feature")
    gap = "abs(try_divide(cum_n_ref, big_r) - try_divide(cum_n_cur, big_c))"
    area = f"coalesce(sum({gap} * (next_value - value)), 0D)"
    spread = "sqrt(try_divide(sum(n_ref * (value - mean_ref) * (value - mean_ref)), sum(n_ref)))"
    return running.groupBy(*SIZE_KEYS).agg(
        F.lit(True).alias("is_numeric"),
        F.expr(f"max({gap})").alias("ks_d"),
        F.expr(f"{area} / greatest({spread}, 0.001D)").alias("wasserstein"),
        *_share_terms(),
    )


def categorical_statistics(counts: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Jensen-Shannon, chi-squared and z statistics; one row per categorical feature."""
    nothing = F.lit(None).cast("double")
    return (
        counts.where(F.col("category").isNotNull())
        .join(F.broadcast(sizes or held_sizes(counts)), "feature")
        .groupBy(*SIZE_KEYS)
        .agg(F.lit(False).alias("is_numeric"), nothing.alias("ks_d"), nothing.alias("wasserstein"), *_share_terms())
    )


def held_sizes(counts: DataFrame) -> DataFrame:
    """The sizes, computed once and held as literal rows, one per feature."""
    frame = sample_sizes(counts)
    return counts.sparkSession.createDataFrame(frame.collect(), frame.schema)


def feature_statistics(counts: DataFrame) -> DataFrame:
    sizes = held_sizes(counts)
    both = numeric_statistics(counts, sizes).union(categorical_statistics(counts, sizes))
    return both.withColumns(
        {
            "ks_p": kolmogorov_p("ks_d", "big_r", "big_c"),
            "chi_square_p": chi_square_p("chi_square", "distinct_all - 1"),
            "z_p": chi_square_p("coalesce(z_square, 0D)", "1"),
        }
    )


# --- choosing the test and the verdict ------------------------------------------


def choose_test(n_ref: Column, is_numeric: Column, distinct_ref: Column, distinct_all: Column) -> Column:
    """p-value tests for a small reference, distances for a large one."""
    small = n_ref <= S.SMALL_SAMPLE_ROWS
    counted = F.when(distinct_all > 2, F.lit(CHI_SQUARE)).otherwise(F.lit(Z_TEST))
    return (
        F.when(small & is_numeric & (distinct_all > S.FEW_VALUES), F.lit(KS))
        .when(small, counted)
        .when(is_numeric & (distinct_ref > S.FEW_VALUES), F.lit(WASSERSTEIN))
        .otherwise(F.lit(JENSEN_SHANNON))
    )


def is_distance(test: Column) -> Column:
    return test.contains("distance")


def test_threshold(test: Column) -> Column:
    return F.when(is_distance(test), F.lit(S.DISTANCE_THRESHOLD)).otherwise(F.lit(S.P_VALUE_THRESHOLD))


def has_drifted(test: Column, value: Column, threshold: Column) -> Column:
    """A distance drifts above its threshold, a p-value below."""
    return F.when(is_distance(test), value > threshold).otherwise(value < threshold)


def feature_drift(statistics: DataFrame, tests: dict[str, str] | None = None) -> DataFrame:
    """``feature, test, value, threshold, drifted``; ``tests`` overrides the test of a feature."""
    test = choose_test(F.col("big_r"), F.col("is_numeric"), F.col("distinct_ref"), F.col("distinct_all"))
    for feature, forced in (tests or {}).items():
        test = F.when(F.col("feature") == feature, F.lit(forced)).otherwise(test)
    value = (
        F.when(F.col("test") == WASSERSTEIN, F.col("wasserstein"))
        .when(F.col("test") == JENSEN_SHANNON, F.col("jensen_shannon"))
        .when(F.col("test") == KS, F.col("ks_p"))
        .when(F.col("test") == CHI_SQUARE, F.col("chi_square_p"))
        .otherwise(F.col("z_p"))
    )
    return (
        statistics.withColumn("test", test)
        .withColumn("value", value)
        .withColumn("threshold", test_threshold(F.col("test")))
        .withColumn("drifted", has_drifted(F.col("test"), F.col("value"), F.col("threshold")))
        .select("feature", "test", "value", "threshold", "drifted", "big_r", "big_c")
    )


def drift_share(features: DataFrame) -> DataFrame:
    """Drifted and total feature counts, and the sample sizes, in one row."""
    drifted = F.coalesce(F.col("drifted").cast("int"), F.lit(0))
    return features.agg(
        F.sum(drifted).alias("drifted_count"),
        F.count("*").alias("feature_count"),
        F.avg(drifted).alias("drift_share"),
        F.max("big_r").alias("reference_rows"),
        F.max("big_c").alias("current_rows"),
    )


def sample_status(current_rows: Column) -> Column:
    rows = F.coalesce(current_rows, F.lit(0))
    return (
        F.when(rows == 0, F.lit("NO_DATA")).when(rows < S.LOW_SAMPLE_ROWS, F.lit("LOW_SAMPLE")).otherwise(F.lit("OK"))
    )


def verdict(features: DataFrame, share: float = S.DRIFT_SHARE) -> DataFrame:
    """One row: counts, share, sample status and DRIFT / PASS (null without data)."""
    status = sample_status(F.col("current_rows"))
    decision = F.when(F.col("drift_share") >= share, F.lit("DRIFT")).otherwise(F.lit("PASS"))
    return drift_share(features).withColumn("status", status).withColumn(
        "verdict", F.when(F.col("status") != "NO_DATA", decision)
    )


def drift_features(
    reference: DataFrame, current: DataFrame, tests: dict[str, str] | None = None, baseline: DataFrame | None = None
) -> DataFrame:
    """Per-feature result of a full check. The counts are written once and read from there.

    With ``baseline``, the kept counts of the reference, the reference is not read.
    """
    counts = value_counts(reference, current) if baseline is None else with_current(baseline, current)
    return feature_drift(feature_statistics(materialise(counts, "value-counts")), tests)


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    share: float = S.DRIFT_SHARE,
    tests: dict[str, str] | None = None,
    baseline: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(per feature, verdict)`` for two feature frames."""
    features = drift_features(reference, current, tests, baseline)
    return features, verdict(features, share)


# --- summaries behind the report ------------------------------------------------


def data_summary(counts: DataFrame, side: str) -> DataFrame:
    """Rows, missing, distinct, moments, quartiles and top category of one side (``n_ref`` or ``n_cur``).

    Quartiles are exact, with linear interpolation, read off the running counts.
    """
    own = counts.where(F.col(side) > 0)
    is_missing = F.col("category").isNull() & F.col("value").isNull()
    present = F.when(is_missing, 0).otherwise(F.col(side))
    weighted_mean = F.try_divide(F.sum(F.col("value") * F.col(side)), F.sum(F.when(F.col("value").isNotNull(), F.col(side))))
    base = own.groupBy("feature").agg(
        F.sum(side).alias("row_count"),
        F.sum(F.when(is_missing, F.col(side)).otherwise(0)).alias("missing"),
        F.sum(present).alias("__present"),
        F.sum(F.when(is_missing, 0).otherwise(1)).alias("distinct_values"),
        weighted_mean.alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max(F.when(F.col("category").isNotNull(), F.struct(F.col(side).alias("n"), F.col("category")))).alias("__top"),
    )
    running = prefix_sums(own.where(F.col("value").isNotNull()), "feature", "value", [side], lead=True)
    centred = F.col("value") - F.col("mean")
    below, upto = F.col(f"cum_{side}") - F.col(side), F.col(f"cum_{side}")
    picks = []
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        place = (F.col("__present") - 1) * F.lit(q)
        low, frac = F.floor(place), place - F.floor(place)
        step = F.when(low + 1 < upto, F.lit(0.0)).otherwise(F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0)))
        picks.append(F.max(F.when((low >= below) & (low < upto), F.col("value") + frac * step)).alias(name))
    spread = (
        running.join(F.broadcast(base.select("feature", "mean", "__present")), "feature")  # one row per feature
        .groupBy("feature")
        .agg(
            F.sqrt(F.try_divide(F.sum(F.col(side) * centred * centred), F.max("__present") - 1)).alias("std"),
            *picks,
        )
    )
    return base.join(spread, "feature", "left").select(
        "feature", "row_count", "missing", "distinct_values", "mean", "std", "min", "p25", "p50", "p75", "max",
        F.col("__top.category").alias("top_category"), F.col("__top.n").alias("top_count"),
    )


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bins 1..bins over [low, high]; 0 below and bins + 1 above."""
    inside = F.floor((value - low) * F.lit(bins) / F.nullif(high - low, F.lit(0.0))) + F.lit(1)
    return (
        F.when(value < low, F.lit(0))
        .when(value > high, F.lit(bins + 1))
        .otherwise(F.least(F.lit(bins), F.coalesce(inside, F.lit(1))))
        .cast("int")
    )


def feature_ranges(reference: DataFrame, numeric=S.NUMERIC_FEATURES) -> DataFrame:
    """Least and greatest value per numeric feature, from one pass without a shuffle of values."""
    limits = [
        F.struct(F.lit(c).alias("feature"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"))
        for c in numeric
    ]
    return reference.agg(F.array(*limits).alias("limits")).select(F.inline("limits"))


def binned_rows(frame: DataFrame, ranges: DataFrame, bins: int, n: str, *keys: Column, keep: tuple = ()) -> DataFrame:
    """Rows per numeric feature and bin; each row is binned where it lies, so only bins are shuffled.

    Rows meet their range and are counted by the place of the feature, a number; the few bins get its name.
    """
    places = F.array(*[F.lit(c) for c in S.NUMERIC_FEATURES])
    placed = ranges.select(F.array_position(places, F.col("feature")).cast("int").alias("f"), "low", "high")
    rows = unpivot_features(frame, *keep, categorical=[]).where(F.col("value").isNotNull())
    number = bin_number(F.col("value"), F.col("low"), F.col("high"), bins).alias("bin")
    counts = rows.join(F.broadcast(placed), "f").groupBy(*keys, "f", number).agg(F.count("*").alias(n))
    return name_features(counts, categorical=[])


def histograms(reference: DataFrame, current: DataFrame, bins: int = 10) -> DataFrame:
    """Rows per bin of the reference range, reference beside current."""
    ranges = feature_ranges(reference)  # one row per feature
    sides = [binned_rows(reference, ranges, bins, "n_ref"), binned_rows(current, ranges, bins, "n_cur")]
    joined = sides[0].join(sides[1], ["feature", "bin"], "full")
    return joined.select("feature", "bin", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_ref", "n_cur")])


def drift_trend(reference: DataFrame, readings: DataFrame, bins: int = 10, every: str = "1 day") -> DataFrame:
    """Per tumbling window and numeric feature: binned Jensen-Shannon distance to the reference.

    ``readings`` carries ``timestamp`` and the feature columns. Each window is
    reduced to a few bins before it meets the reference, so the number of
    windows may grow without multiplying the reference.
    """
    ranges = feature_ranges(reference)  # one row per feature
    start = F.window("timestamp", every)["start"].alias("window_start")
    windows = binned_rows(readings, ranges, bins, "n", start, keep=("timestamp",))
    return binned_distances(binned_rows(reference, ranges, bins, "n"), windows, "window_start", bins)


def binned_distances(reference: DataFrame, windows: DataFrame, window: str, bins: int = 10) -> DataFrame:
    """Jensen-Shannon distance per window and feature, from rows per bin: ``feature, bin, n`` of both sides."""
    by_bin = F.map_from_entries(F.collect_list(F.struct("bin", "n")))
    ref_bins = reference.groupBy("feature").agg(F.sum("n").alias("big_r"), by_bin.alias("ref_bins"))
    per_window = windows.groupBy(window, "feature").agg(F.sum("n").alias("big_c"), by_bin.alias("cur_bins"))
    joined = per_window.join(F.broadcast(ref_bins), "feature")  # one row of at most bins + 2 entries per feature

    def term(acc: Column, i: Column) -> Column:
        p = F.coalesce(F.try_element_at("ref_bins", i), F.lit(0)) / F.col("big_r")
        q = F.coalesce(F.try_element_at("cur_bins", i), F.lit(0)) / F.col("big_c")
        m = F.nullif((p + q) / F.lit(2.0), F.lit(0.0))
        return (
            acc
            + F.when(p > 0, p * F.ln(p / m)).otherwise(F.lit(0.0))
            + F.when(q > 0, q * F.ln(q / m)).otherwise(F.lit(0.0))
        )

    total = F.aggregate(F.sequence(F.lit(0), F.lit(bins + 1)), F.lit(0.0), term)
    return joined.select(
        window,
        "feature",
        F.col("big_c").alias("row_count"),
        F.sqrt(F.greatest(F.lit(0.0), total / F.lit(2.0))).alias("distance"),
    ).withColumn("drifted", F.col("distance") > S.DISTANCE_THRESHOLD)
