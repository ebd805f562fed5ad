"""Model quality from scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardflow.functions.casts import known, quoted
from hazardflow.operators.order import ROWS_PER_RANGE, before_sums, ranged
from hazardflow.operators.selection import kept


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction), ordered."""
    return (
        df.where(quoted(label).isNotNull())
        .groupBy(
            quoted(label).cast("double").alias("label"),
            quoted(prediction).cast("double").alias("prediction"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("label", "prediction")
    )


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy, weighted precision, weighted recall, weighted F1.

    All four come from the confusion matrix, so the data is read once; the windows below see
    one row per pair of classes. A class never predicted has precision 0.
    """
    return _weighted(confusion_matrix(df, label, prediction), [])


def _weighted(pairs: DataFrame, by: list[str]) -> DataFrame:
    """The four metrics of confusion counts (by, label, prediction, n), one row per `by`."""
    total = F.sum("n").over(Window.partitionBy(*by or [F.lit(0)]))
    sized = pairs.select(
        *by,
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
        F.sum("n").over(Window.partitionBy(*by, "label")).alias("actual"),
        F.sum("n").over(Window.partitionBy(*by, "prediction")).alias("predicted"),
        total.alias("total"),
    )
    weight = F.col("actual") / F.col("total")
    # Only the diagonal contributes; elsewhere hit is 0 and so is every term.
    precision = F.col("hit") / F.col("predicted")
    recall = F.col("hit") / F.col("actual")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    metrics = [
        F.sum(F.col("hit") / F.col("total")).alias("accuracy"),
        F.sum(weight * precision).alias("weighted_precision"),
        F.sum(weight * recall).alias("weighted_recall"),
        F.sum(weight * f1).alias("weighted_f1"),
    ]
    return sized.groupBy(*by).agg(*metrics) if by else sized.agg(*metrics)


def _areas(counted: DataFrame, by: list[str], rows_per_range: int) -> DataFrame:
    """Area per `by` of stored counts (by, score, pos, neg), one row per score.

    Scores are sorted within value ranges whose number follows the rows; the ranges only spread
    the work. The rows are counted from the files, nothing is computed again.
    """
    cut = ranged(counted, [*by, "score"], counted.count(), rows_per_range)
    ranked = before_sums(cut, by, "score", ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    area = F.try_divide(wins, pairs).alias("auc")
    return ranked.groupBy(*by).agg(area) if by else ranked.agg(area)


def _classes(label: str, n: str | None = None) -> list[Column]:
    """Positive and negative rows. Rows without a score weigh nothing; filtering them would repeat
    the score."""
    weight = F.lit(1) if n is None else F.col(n)
    told = F.col("score").isNotNull()
    return [
        F.sum(F.when(told & (F.col(label) == 1), weight).otherwise(0)).alias("pos"),
        F.sum(F.when(told & (F.col(label) != 1), weight).otherwise(0)).alias("neg"),
    ]


def auc(
    df: DataFrame,
    score: str = "prob_flood",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Exact area under the ROC curve by rank sums, ties counted half.

    Rows collapse to one per distinct score before anything is ordered; these are stored, so the
    input, which may hold a model, is computed once. Null when one class is absent.
    """
    rows = df.select(known(score).alias("score"), quoted(label).cast("double").alias("label"))
    return _areas(kept(rows.groupBy("score").agg(*_classes("label")), "scores"), [], rows_per_range)


def evaluate_parts(
    scored: DataFrame,
    label: str,
    score: str | None = None,
    part: str = "part",
    prediction: str = "prediction",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(part, metric, value) of every part of the scored rows: the four metrics, and the AUC of a score.

    The rows are computed once, into counts per part, class, prediction and score, which are stored; metrics
    and areas of all parts come from those. Exact: the same numbers as part by part.
    """
    value = known(score) if score else F.lit(None).cast("double")
    rows = scored.select(
        quoted(part).alias("part"),
        quoted(label).cast("double").alias("label"),
        quoted(prediction).cast("double").alias("prediction"),
        value.alias("score"),
    )
    counted = kept(rows.groupBy("part", "label", "prediction", "score").agg(F.count("*").alias("n")), "counted")
    pairs = counted.where("label is not null").groupBy("part", "label", "prediction").agg(F.sum("n").alias("n"))
    measured = _weighted(pairs, ["part"])
    if score:
        by_score = kept(counted.groupBy("part", "score").agg(*_classes("label", "n")), "scores")
        measured = measured.join(_areas(by_score, ["part"], rows_per_range), "part", "left")
    return measured.unpivot(["part"], [c for c in measured.columns if c != "part"], "metric", "value")
