"""Analytical reports on Silver and on the Gold star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.plans.gold import with_channel_attributes
from riskmill.schemas import DIMENSIONS


def risk_by_channel(silver: DataFrame) -> DataFrame:
    """Transactions, mean score and share of flagged transactions per channel and risk level.

    One pass: rows are reduced to one per channel, and the channel's attributes follow from its id. The
    same report on stored tables, with joins, is ``GOLD_SQL["risk_by_channel"]``.
    """
    per_channel = silver.groupBy(F.col("Channel").alias("channel_id")).agg(
        F.count("*").alias("n"),
        F.round(F.avg(rules.fraud_risk_score()), 6).alias("mean_score"),
        F.round(F.avg(rules.fraud_label()), 6).alias("flagged_share"),
    )
    return with_channel_attributes(per_channel).drop("channel_description")


def score_distribution(silver: DataFrame) -> DataFrame:
    return silver.groupBy(rules.fraud_risk_score().alias("fraud_risk_score")).agg(F.count("*").alias("n"))


def star_join(gold: dict[str, DataFrame]) -> DataFrame:
    """Every transaction fact with the attributes of its four dimensions.

    No join is forced to broadcast: a dimension is broadcast when its known size allows it, and
    otherwise shuffled with AQE splitting keys that hold many facts.
    """
    facts = gold["fact_transactions"]
    dims = [gold[name] for name in DIMENSIONS]
    return reduce(lambda rows, pair: rows.join(pair[0], pair[1], "left"), zip(dims, DIMENSIONS.values()), facts)


def integrity_check(gold: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: keys that occur in facts without a row, and rows no fact uses.

    Fact keys of all dimensions are reduced to distinct (dimension, key) pairs together with the
    dimensions' own keys; one shuffle answers both questions for all four.
    """
    pairs = [
        F.struct(F.lit(dim).alias("dimension"), F.col(key).alias("key"))
        for dim, key in DIMENSIONS.items()
    ]
    used = gold["fact_transactions"].select(F.inline(F.array(*pairs))).withColumn("side", F.lit("fact"))
    known = reduce(
        DataFrame.unionByName,
        [
            gold[dim].select(F.lit(dim).alias("dimension"), F.col(key).alias("key"), F.lit("dim").alias("side"))
            for dim, key in DIMENSIONS.items()
        ],
    )
    per_key = (
        used.unionByName(known)
        .groupBy("dimension", "key")
        .agg(
            F.bool_or(F.col("side") == "fact").alias("in_facts"),
            F.bool_or(F.col("side") == "dim").alias("in_dim"),
        )
    )
    return per_key.groupBy("dimension").agg(
        F.count_if(F.col("in_facts") & ~F.col("in_dim")).alias("n_orphans"),
        F.count_if(F.col("in_dim") & ~F.col("in_facts")).alias("n_unused"),
    )


def _per_weekday_and_channel(silver: DataFrame) -> DataFrame:
    return silver.groupBy(
        F.col("TransactionDayOfWeek").alias("weekday"), F.col("Channel").alias("channel_id")
    ).agg(F.count("*").alias("_n"), F.sum("TransactionAmount").alias("_amount"))


def _subtotals(grouped) -> DataFrame:
    return grouped.agg(
        F.grouping_id().alias("gid"),
        F.sum("_n").alias("n"),
        F.round(F.sum("_amount"), 2).alias("sum_amount"),
    )


def risk_rollup(silver: DataFrame) -> DataFrame:
    """Totals by weekday and channel with subtotals, built on the few finest groups instead of on rows."""
    return _subtotals(_per_weekday_and_channel(silver).rollup("weekday", "channel_id"))


def risk_cube(silver: DataFrame) -> DataFrame:
    """As ``risk_rollup`` with the channel subtotals too."""
    return _subtotals(_per_weekday_and_channel(silver).cube("weekday", "channel_id"))


def top_risk_accounts(silver: DataFrame, k: int = 10) -> DataFrame:
    """The k accounts with the largest score sum in each channel; equal sums are ranked by account.

    The rank limit is applied per map task before the shuffle, so a channel's accounts never meet in
    one task.
    """
    per_account = silver.groupBy(
        F.col("Channel").alias("channel_id"), F.col("AccountID").alias("customer_id")
    ).agg(F.sum(rules.fraud_risk_score()).alias("score_sum"))
    order = Window.partitionBy("channel_id").orderBy(F.desc("score_sum"), "customer_id")
    return per_account.withColumn("rnk", F.dense_rank().over(order)).filter(F.col("rnk") <= k)


# Queries a user of the star schema writes; {db} is the Gold database.
GOLD_SQL = {
    "count": "SELECT count(*) AS n FROM {db}.fact_transactions",
    "risk_by_channel": """
        SELECT c.channel_id, c.risk_level, count(*) AS n,
               round(avg(r.fraud_risk_score), 6) AS mean_score,
               round(avg(CASE WHEN r.fraud_risk_score >= 2 THEN 1 ELSE 0 END), 6) AS flagged_share
        FROM {db}.fact_transactions t
        JOIN {db}.fact_fraud_risk r ON t.transaction_id = r.transaction_id
        LEFT JOIN {db}.dim_channels c ON t.channel_id = c.channel_id
        GROUP BY c.channel_id, c.risk_level""",
    "spend_by_occupation": """
        SELECT d.occupation, d.age_category, count(*) AS n, round(sum(t.amount), 2) AS sum_amount
        FROM {db}.fact_transactions t
        LEFT JOIN {db}.dim_customers d ON t.customer_id = d.customer_id
        GROUP BY d.occupation, d.age_category""",
    "day_and_channel_totals": """
        SELECT CAST(transaction_timestamp AS DATE) AS day, channel_id,
               grouping_id() AS gid, count(*) AS n, round(sum(amount), 2) AS sum_amount
        FROM {db}.fact_transactions
        GROUP BY GROUPING SETS ((CAST(transaction_timestamp AS DATE)), (channel_id), ())""",
    "moving_amount": """
        WITH daily AS (
            SELECT customer_id, CAST(transaction_timestamp AS DATE) AS day, sum(amount) AS amount
            FROM {db}.fact_transactions GROUP BY ALL)
        SELECT customer_id, day, round(sum(amount) OVER (
            PARTITION BY customer_id ORDER BY day
            RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2) AS amount_7d
        FROM daily""",
}


def gold_sql(spark: SparkSession, name: str, database: str) -> DataFrame:
    return spark.sql(GOLD_SQL[name].format(db=database))
