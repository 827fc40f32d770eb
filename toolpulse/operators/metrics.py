"""Classifier metrics as aggregations; no row of the scored table reaches the driver."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from toolpulse import schemas as S
from toolpulse.operators.ranking import prefix_sums, row_numbers
from toolpulse.sources.durable import materialise


def imbalance_ratio(label: Column) -> Column:
    """Negatives per positive of a 0/1 label."""
    return F.try_divide(F.count_if(label == 0), F.count_if(label == 1))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("class_rows"))
    all_classes = Window.partitionBy(F.lit(1))  # over one row per class
    weight = F.sum("class_rows").over(all_classes) / (F.count("*").over(all_classes) * F.col("class_rows"))
    return sizes.select(label, "class_rows", weight.alias("weight"))


def confusion(df: DataFrame, truth: str, predicted: str, *by: str) -> DataFrame:
    """Rows per (truth, predicted); as small as the square of the class count."""
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def binary_scores(counts: DataFrame, *by: str) -> DataFrame:
    """Precision, recall and F1 of class 1 from confusion counts; zero where undefined."""
    actual, called = F.col("truth") == 1, F.col("predicted") == 1

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return (
        counts.groupBy(*by)
        .agg(rows(actual & called).alias("tp"), rows(~actual & called).alias("fp"), rows(actual & ~called).alias("fn"))
        .select(
            *by,
            "tp",
            "fp",
            "fn",
            _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
            _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
            _ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")).alias("f1"),
        )
    )


def macro_scores(counts: DataFrame, *by: str) -> DataFrame:
    """Unweighted means over the classes that occur in truth or prediction."""
    sides = counts.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("called"),
                    F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("called"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ),
    )
    per_class = sides.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("actual", "called", "hit")])
    return per_class.groupBy(*by).agg(
        F.avg(_ratio(F.col("hit"), F.col("called"))).alias("precision"),
        F.avg(_ratio(F.col("hit"), F.col("actual"))).alias("recall"),
        F.avg(_ratio(F.col("hit") * 2, F.col("called") + F.col("actual"))).alias("f1"),
    )


def scores(counts: DataFrame, average: str, *by: str) -> DataFrame:
    frame = binary_scores(counts, *by) if average == "binary" else macro_scores(counts, *by)
    return frame.select(*by, "precision", "recall", "f1")


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve with ties counted half; null if a class is missing.

    Rows are first counted per distinct score, then ranked through running counts.
    """
    counts = (
        df.groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
        .withColumn("all", F.lit("all"))
    )
    running = prefix_sums(materialise(counts, "score-counts"), "all", "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    area = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return running.agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def brier_binary(label: Column, probability: Column) -> Column:
    miss = probability - label
    return F.avg(miss * miss)


def brier_multiclass(class_index: Column, shares: Column) -> Column:
    """Half the mean squared distance between the class indicator and the probabilities."""
    # sum((p - y)^2) with y = 1 at the true class only
    squares = F.aggregate(shares, F.lit(0.0), lambda total, p: total + p * p)
    hit = F.element_at(shares, (class_index + 1).cast("int"))
    return F.avg(squares - F.lit(2.0) * hit + F.lit(1.0)) / 2


def overfit(split_scores: DataFrame) -> DataFrame:
    """Train F1, test F1, their difference and a warning flag, from rows ``is_test, f1``."""
    return split_scores.agg(
        F.max(F.when(~F.col("is_test"), F.col("f1"))).alias("f1_train"),
        F.max(F.when(F.col("is_test"), F.col("f1"))).alias("f1_test"),
    ).select(
        "f1_train",
        "f1_test",
        (F.col("f1_train") - F.col("f1_test")).alias("overfit_delta"),
        (F.col("f1_train") - F.col("f1_test") > S.OVERFIT_LIMIT).alias("overfit_warning"),
    )


def evaluate(
    scored: DataFrame, truth: str, predicted: str, average: str, brier: Column, probability: str | None = None
) -> DataFrame:
    """All metrics of a run in one row; ``scored`` has ``is_test``.

    ``probability`` (of class 1) adds ``roc_auc_test``.
    """
    by_split = scores(confusion(scored, truth, predicted, "is_test"), average, "is_test")
    test = by_split.where("is_test").select(
        F.col("precision").alias("precision_test"), F.col("recall").alias("recall_test"), F.lit(1).alias("one")
    )
    held_out = scored.where("is_test")
    row = (
        overfit(by_split)
        .withColumn("one", F.lit(1))
        .join(F.broadcast(test), "one", "left")  # single rows
        .join(F.broadcast(held_out.agg(brier.alias("brier_score")).withColumn("one", F.lit(1))), "one", "left")
    )
    if probability is not None:
        auc = roc_auc(held_out, truth, probability).withColumnRenamed("roc_auc", "roc_auc_test")
        row = row.join(F.broadcast(auc.withColumn("one", F.lit(1))), "one", "left")
    return row.drop("one")


def mean_fold_score(fold_scores: DataFrame) -> DataFrame:
    """Mean score per trial from rows ``trial, fold, f1``."""
    return fold_scores.groupBy("trial").agg(F.avg("f1").alias("mean_f1"), F.count("*").alias("folds"))


def best_trial(trial_scores: DataFrame) -> DataFrame:
    """The trial with the highest mean; the earliest of equals."""
    best = F.max_by(F.struct("trial", "mean_f1"), F.struct(F.col("mean_f1"), -F.col("trial"))).alias("best")
    return trial_scores.agg(best).select("best.*")


def scaling_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per column, one row each."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")) for c in columns
    ]
    return df.agg(F.array(*pairs).alias("moments")).select(F.inline("moments"))


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Distinct categories in order, with their position."""
    return row_numbers(df.select(column).distinct(), column, "position", start=0).withColumn("position", F.col("position").cast("int"))
