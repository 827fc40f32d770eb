"""The exact p-value of the KS distance against full enumeration and against counted merges."""

from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from toolpulse.operators import drift


def distance(places, n, m):
    """Of the merge of two samples in which the first has the given places."""
    i, worst = 0, 0.0
    for step in range(1, n + m + 1):
        i += step - 1 in places
        worst = max(worst, abs(i / n - (step - i) / m))
    return worst


def enumerated(n, m):
    """Share of merges at least as far apart, per possible distance."""
    every = [round(distance(set(p), n, m) * n * m) for p in combinations(range(n + m), n)]
    return {h: sum(e >= h for e in every) / len(every) for h in set(every)}


def counted(n, m, h):
    """Whole numbers: paths that stay inside, one column of the lattice after the other."""
    column = [0] * (m + 1)
    for i in range(n + 1):
        for j in range(m + 1):
            ways = 1 if i == j == 0 else (column[j] if i else 0) + (column[j - 1] if j else 0)
            column[j] = ways if abs(i * m - j * n) < h else 0
    return 1 - column[m] / comb(n + m, n)


def p_values(spark, rows):
    df = spark.createDataFrame(rows, "d double, n bigint, m bigint")
    return [r[0] for r in df.coalesce(1).select(drift.kolmogorov_p("d", "n", "m")).collect()]


@pytest.mark.parametrize("n, m", [(1, 1), (2, 5), (6, 4), (7, 7)])
def test_equals_every_merge(spark, n, m):
    wanted = enumerated(n, m)
    got = p_values(spark, [(h / (n * m), n, m) for h in wanted])
    assert got == pytest.approx(list(wanted.values()), abs=1e-12)


@pytest.mark.parametrize("n, m", [(200, 200), (30, 170), (199, 200)])
def test_equals_counted_paths(spark, n, m):
    steps = [int(share * n * m) for share in (0.05, 0.12, 0.2, 0.5)]
    got = p_values(spark, [(h / (n * m), n, m) for h in steps])
    assert got == pytest.approx([counted(n, m, h) for h in steps], abs=1e-9)


def test_the_verdict_that_the_limit_misses(spark):
    """1,000 against 30 rows, a quarter apart: on either side of the threshold."""
    exact, = p_values(spark, [(0.25, 1000, 30)])
    limit = 2 * sum((-1) ** (k - 1) * 2.718281828459045 ** (-2 * k * k * 0.25**2 * 1000 * 30 / 1030) for k in range(1, 101))
    assert exact == pytest.approx(counted(1000, 30, 7500), abs=1e-9)
    assert exact < 0.05 < limit


def test_large_samples_take_the_limit_and_odd_ones_are_defined(spark):
    large, = p_values(spark, [(0.01, 100_000, 100_000)])
    assert large == pytest.approx(9.08e-5, rel=0.01)
    assert p_values(spark, [(0.0, 5, 5), (1.0, 3, 3), (None, 5, 5), (0.5, 0, 5)]) == [1.0, pytest.approx(2 / comb(6, 3)), None, 1.0]


def test_small_report_uses_it(spark, training):
    from toolpulse.sources.readers import reference_features

    reference = reference_features(training)
    counts = drift.value_counts(reference, reference.where(F.col("torque_nm") > 40))
    row = drift.feature_statistics(counts).where("feature = 'torque_nm'").first()
    n, m = row["big_r"], row["big_c"]
    assert row["ks_p"] == pytest.approx(counted(int(n), int(m), round(row["ks_d"] * n * m)), abs=1e-9)
