"""Gold: four dimensions and two fact tables over Silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.operators.dedup import latest_per_key

# The newest transaction decides a dimension row; ids are unique in Silver, so the order is total.
NEWEST_FIRST = ["TransactionDateTime", "TransactionID"]


# Which Silver column feeds which fact column.
TRANSACTION_FACT_COLUMNS = {
    "TransactionID": "transaction_id",
    "AccountID": "customer_id",
    "MerchantID": "merchant_id",
    "DeviceID": "device_id",
    "Channel": "channel_id",
    "TransactionAmount": "amount",
    "TransactionType": "transaction_type",
    "TransactionDateTime": "transaction_timestamp",
    "LoginAttempts": "login_attempts",
    "TransactionDuration": "duration_seconds",
    "IsHighRiskLocation": "is_high_risk_location",
    "IsHighRiskChannel": "is_high_risk_channel",
    "AmountToBalanceRatio": "amount_to_balance_ratio",
    "DaysSincePreviousTransaction": "days_since_previous",
}
RISK_FACT_COLUMNS = {
    "TransactionID": "transaction_id",
    "AccountID": "customer_id",
    "fraud_risk_score": "fraud_risk_score",
    "suspicious_login_flag": "suspicious_login_flag",
    "unusual_amount_flag": "unusual_amount_flag",
    "TransactionDateTime": "risk_assessment_timestamp",
}


@dataclass(frozen=True)
class Dimension:
    """One row per key: attributes of its newest transaction, and maxima over all of them."""

    key: str  # in Silver
    name: str  # in Gold
    keep: Callable[[], dict[str, Column]]  # attributes from Silver columns
    maxima: dict[str, str] = field(default_factory=dict)  # name -> Silver column

    def columns(self) -> list[str]:
        return [self.name, *self.keep(), *self.maxima]


DIMENSION_PLANS = {
    "dim_customers": Dimension(
        "AccountID",
        "customer_id",
        lambda: {
            "age": F.col("CustomerAge"),
            "occupation": F.col("CustomerOccupation"),
            "preferred_channel": F.col("Channel"),
            "account_balance": F.col("AccountBalance"),
            "age_category": rules.age_category(F.col("IsAbnormalAge")),
        },
        {"max_transaction_amount": "TransactionAmount"},
    ),
    "dim_devices": Dimension(
        "DeviceID",
        "device_id",
        lambda: {
            "device_prefix": F.col("DeviceIDPrefix"),
            "ip_first_octet": F.col("IPFirstOctet"),
            "ip_address": F.col("IP Address"),
        },
    ),
    "dim_merchants": Dimension("MerchantID", "merchant_id", lambda: {"merchant_location": F.col("Location")}),
}


def _dimension(silver: DataFrame, name: str) -> DataFrame:
    plan = DIMENSION_PLANS[name]
    maxima = {output: F.max(source) for output, source in plan.maxima.items()}
    latest = latest_per_key(silver, plan.key, NEWEST_FIRST, plan.keep(), maxima)
    return latest.withColumnRenamed(plan.key, plan.name)


def dim_customers(silver: DataFrame) -> DataFrame:
    return _dimension(silver, "dim_customers")


def dim_devices(silver: DataFrame) -> DataFrame:
    return _dimension(silver, "dim_devices")


def dim_merchants(silver: DataFrame) -> DataFrame:
    return _dimension(silver, "dim_merchants")


def with_channel_attributes(df: DataFrame) -> DataFrame:
    """Description and risk level, which follow from ``channel_id`` alone."""
    channel = F.col("channel_id")
    return df.withColumns(
        {
            "channel_description": rules.channel_description(channel),
            "risk_level": rules.channel_risk_level(channel),
        }
    )


def dim_channels(silver: DataFrame) -> DataFrame:
    return with_channel_attributes(silver.select(F.col("Channel").alias("channel_id")).distinct())


# --- States of days, which are merged instead of reading all of Silver again ---------------------------


def day_state(silver: DataFrame, table: str, day: str) -> DataFrame:
    """What a day contributes to a dimension: one row per day and key, merged by ``merged_states``.

    ``newest`` holds the order of the key's newest transaction and its attributes.
    """
    if table == "dim_channels":
        return silver.select(day, F.col("Channel").alias("channel_id")).distinct()
    plan = DIMENSION_PLANS[table]
    order = F.struct(*NEWEST_FIRST)
    kept = F.struct(order.alias("order"), *[value.alias(name) for name, value in plan.keep().items()])
    maxima = [F.max(source).alias(output) for output, source in plan.maxima.items()]
    states = silver.groupBy(day, F.col(plan.key).alias(plan.name)).agg(F.max_by(kept, order).alias("newest"), *maxima)
    return states


def merged_states(states: DataFrame, table: str) -> DataFrame:
    """The dimension of all days whose states these are; reduced on the map side."""
    if table == "dim_channels":
        return with_channel_attributes(states.select("channel_id").distinct())
    plan = DIMENSION_PLANS[table]
    maxima = [F.max(output).alias(output) for output in plan.maxima]
    newest = F.max_by("newest", "newest.order").alias("newest")
    found = states.groupBy(plan.name).agg(newest, *maxima)
    return found.select(plan.name, *[F.col(f"newest.{name}") for name in plan.keep()], *plan.maxima)


def fact_transactions(silver: DataFrame, *carry: str) -> DataFrame:
    columns = TRANSACTION_FACT_COLUMNS
    return silver.select(*columns, *carry).withColumnsRenamed(columns)


def fact_fraud_risk(silver: DataFrame, *carry: str) -> DataFrame:
    columns = RISK_FACT_COLUMNS
    scored = silver.withColumns(
        {
            "fraud_risk_score": rules.fraud_risk_score(),
            "suspicious_login_flag": rules.is_frequent_logins(F.col("LoginAttempts")),
            "unusual_amount_flag": rules.is_unusual_amount(F.col("AmountToBalanceRatio")),
        }
    )
    return scored.select(*columns, *carry).withColumnsRenamed(columns)


TABLES = {
    "dim_customers": dim_customers,
    "dim_devices": dim_devices,
    "dim_merchants": dim_merchants,
    "dim_channels": dim_channels,
    "fact_transactions": fact_transactions,
    "fact_fraud_risk": fact_fraud_risk,
}


def load_date_column(table: str) -> str:
    return "dim_load_date" if table.startswith("dim_") else "fact_load_date"


FACTS = ("fact_transactions", "fact_fraud_risk")


def with_load_date(df: DataFrame, table: str) -> DataFrame:
    return df.withColumn(load_date_column(table), F.current_timestamp())


def build(silver: DataFrame, table: str, *carry: str) -> DataFrame:
    """A Gold table with its load date; ``carry`` names columns of Silver that a fact keeps."""
    return with_load_date(TABLES[table](silver, *carry), table)
