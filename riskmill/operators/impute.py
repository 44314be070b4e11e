"""Column means and mean imputation without leaving the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: feature, mean (NULLs skipped)."""
    return df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "mean")


def fill_with_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs in ``columns`` by the column's mean; the columns become doubles.

    The means are one scalar subquery: one struct of numbers, computed once with map-side reduction.
    ``df`` should be a stored table; it is read twice.
    """
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("_means").getField(c)) for c in columns}
    return df.withColumn("_means", means).withColumns(filled).drop("_means")
