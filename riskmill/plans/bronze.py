"""Bronze: raw transactions, partitioned by calendar day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.functions.features import event_time

DAY = "transaction_day"


def with_day(transactions: DataFrame) -> DataFrame:
    """Add the partition day. It has a name of its own, so the transaction keeps its time of day."""
    return transactions.withColumn(DAY, F.to_date(event_time(F.col("TransactionDate"))))


def count_days(bronze: DataFrame) -> DataFrame:
    """Number of day partitions."""
    return bronze.agg(F.count_distinct(DAY).alias("n_days"))


def daily_counts(bronze: DataFrame) -> DataFrame:
    """Rows and accounts per day; reduced by (day, account) first, so a busy day is not one task's work."""
    return bronze.groupBy(DAY).agg(F.count("*").alias("n"), F.count_distinct("AccountID").alias("n_accounts"))


def batch_runs(bronze: DataFrame) -> DataFrame:
    """Run log of the daily loads, one per channel and day: when it ended and whether amounts were complete."""
    complete = F.count_if(F.col("TransactionAmount").isNull()) == 0
    return bronze.groupBy(F.concat(F.lit("load_"), F.lower("Channel")).alias("dag_id"), DAY).agg(
        F.max("TransactionDate").alias("execution_date"),
        F.when(complete, "success").otherwise("failed").alias("state"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """State and date of the last run of every job."""
    return runs.groupBy("dag_id").agg(
        F.max_by("state", "execution_date").alias("state"), F.max("execution_date").alias("execution_date")
    )
