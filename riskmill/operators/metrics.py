"""Classifier metrics as aggregates over (label, prediction, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmill.sources.workspace import stage


def _count_cases(label: str, prediction: str, weight: Column) -> dict[str, Column]:
    cases = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return {
        name: F.coalesce(
            F.sum(F.when((F.col(label) == actual) & (F.col(prediction) == said), weight)),
            F.lit(0).cast("long"),
        )
        for name, (actual, said) in cases.items()
    }


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"))


def evaluate(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: Column | None = None
) -> DataFrame:
    """One row: accuracy, precision, recall, f1, n_classes and the four cells; empty denominators give 0.

    ``weight`` is a row count, for input that is already grouped.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    cells = df.agg(
        *[cell.alias(name) for name, cell in _count_cases(label, prediction, weight).items()],
        F.count_distinct(label).alias("n_classes"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return cells.select(
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "n_classes",
        "tn",
        "fp",
        "fn",
        "tp",
    )


def area_under_roc(
    df: DataFrame, label: str = "label", score: str = "score", weight: Column | None = None
) -> DataFrame:
    """One row with ``auc``: chance that a positive outscores a negative, ties counting half.

    NULL unless both labels occur; a NULL or NaN score is an error. Equal scores are merged first, then dealt
    out by ranges of scores and stored, so that the running count of negatives is a window inside each range
    plus an offset per range: balanced whatever the scores, with one row per range in the only unsplit window.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    value = F.col(score).cast("double")
    refused = F.raise_error(F.lit("a score is NULL or NaN")).cast("double")
    per_score = df.groupBy(F.when(value.isNull() | F.isnan(value), refused).otherwise(value).alias("_score")).agg(
        F.sum(F.when(F.col(label) == 1, weight).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(label) == 0, weight).otherwise(0)).alias("_neg"),
    )
    ranged = stage(per_score.repartitionByRange("_score").withColumn("_range", F.spark_partition_id()), "scores")
    per_range = ranged.groupBy("_range").agg(F.sum("_neg").alias("_range_neg"))
    offsets = per_range.select(
        "_range", (F.sum("_range_neg").over(Window.orderBy("_range")) - F.col("_range_neg")).alias("_offset")
    )
    below = F.sum("_neg").over(Window.partitionBy("_range").orderBy("_score")) - F.col("_neg")
    ranked = ranged.withColumn("_inside", below).join(offsets, "_range")
    wins = F.col("_pos") * (F.col("_offset") + F.col("_inside") + F.col("_neg") / 2)
    totals = ranked.agg(F.sum(wins).alias("w"), F.sum("_pos").alias("p"), F.sum("_neg").alias("n"))
    return totals.select(F.try_divide(F.col("w"), F.col("p") * F.col("n").cast("double")).alias("auc"))
