"""Column profile: NULLs, distinct values and moments of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_columns(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """One row per column: column, n_null, n_distinct, mean, stddev, min, max.

    Columns become (column, value) rows. With a single distinct aggregate Spark first reduces by column
    and value, before and after a shuffle on both, so neither a wide column nor a frequent value fills
    one task.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column")
        .agg(
            F.count_if(F.col("value").isNull()).alias("n_null"),
            F.count_distinct("value").alias("n_distinct"),
            F.round(F.avg("value"), digits).alias("mean"),
            F.round(F.stddev("value"), digits).alias("stddev"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
