"""Stratified train/test split and folds from a hash order.

Rows of a class are ordered by a salted digest of their id. The split point is
an exact order statistic of the digests, so assigning a row is a comparison
with a literal: the table is never shuffled or sorted for it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolpulse import schemas as S
from toolpulse.operators.ranking import hash_cuts


def split_digest(key: str, seed: int = S.SPLIT_SEED) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _beyond(cuts: dict, group: str, digest: str) -> Column:
    """How many of its class's cut digests a row lies beyond; null for an unknown class."""
    entries = []
    for value, points in cuts.items():
        # A cut before the first row is below every digest.
        entries += [F.lit(value), F.array(*[F.lit(point or "") for point in points])]
    if not entries:
        return F.lit(None).cast("int")
    own = F.try_element_at(F.create_map(*entries), F.col(group))
    return F.size(F.filter(own, lambda point: point < F.col(digest)))


def test_rows(n: int, test_size: float) -> int:
    """Nearest whole number of test rows, halves up."""
    return int(n * test_size + 0.5)


def with_test_flag(
    df: DataFrame, label: str, key: str = "udi", test_size: float = S.TEST_SIZE, seed: int = S.SPLIT_SEED
) -> DataFrame:
    """Adds ``is_test``: the first ``test_size`` of each class in hash order."""
    keyed = df.withColumn("__digest", split_digest(key, seed))
    cuts = hash_cuts(keyed, label, "__digest", lambda n: [test_rows(n, test_size)])
    return keyed.withColumn("is_test", _beyond(cuts, label, "__digest") == 0).drop("__digest")


def with_folds(
    df: DataFrame, label: str, folds: int, key: str = "udi", seed: int = S.SPLIT_SEED, name: str = "fold"
) -> DataFrame:
    """Adds a fold number 0..folds-1; sizes within a class differ by at most one."""

    def fold_ends(n: int) -> list[int]:
        small, extra = divmod(n, folds)
        ends, end = [], 0
        for i in range(folds - 1):
            end += small + (1 if i < extra else 0)
            ends.append(end)
        return ends

    keyed = df.withColumn("__digest", split_digest(key, seed))
    cuts = hash_cuts(keyed, label, "__digest", fold_ends)
    return keyed.withColumn(name, _beyond(cuts, label, "__digest")).drop("__digest")
