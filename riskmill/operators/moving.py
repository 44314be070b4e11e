"""Per-account movement over calendar days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def moving_amount(facts: DataFrame, days: int = 7) -> DataFrame:
    """customer_id, day, amount over the last ``days`` calendar days (the day itself included).

    Rows are summed per account and day first, so the window sees at most one row per day of an account.
    """
    daily = facts.groupBy("customer_id", F.to_date("transaction_timestamp").alias("day")).agg(
        F.sum("amount").alias("_amount")
    )
    window = Window.partitionBy("customer_id").orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    return daily.select("customer_id", "day", F.sum("_amount").over(window).alias(f"amount_{days}d"))
