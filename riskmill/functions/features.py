"""Derived Silver columns. Stateless per row, so the same code runs on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmill.functions import rules


def event_time(raw: Column) -> Column:
    """Timestamp without time zone from text, date or timestamp; NULL where the text is none."""
    return raw.try_cast("timestamp_ntz")


def amount_to_balance(amount: Column, balance: Column) -> Column:
    """Amount over balance plus one; NULL where the balance is exactly -1."""
    return F.try_divide(amount, balance + 1)


# Which Bronze columns each derived column is computed from.
FEATURE_SOURCES = {
    "TransactionDateTime": ["TransactionDate"],
    "TransactionHour": ["TransactionDate"],
    "TransactionDayOfWeek": ["TransactionDate"],
    "TransactionMonth": ["TransactionDate"],
    "DaysSincePreviousTransaction": ["TransactionDate", "PreviousTransactionDate"],
    "AmountToBalanceRatio": ["TransactionAmount", "AccountBalance"],
    "IsLargeTransaction": ["TransactionAmount"],
    "IsSmallTransaction": ["TransactionAmount"],
    "DeviceIDPrefix": ["DeviceID"],
    "IPFirstOctet": ["IP Address"],
    "IsHighRiskLocation": ["Location"],
    "IsFrequentLogins": ["LoginAttempts"],
    "IsAbnormalAge": ["CustomerAge"],
    "IsHighRiskChannel": ["Channel"],
    "TransactionDateOnly": ["TransactionDate"],
}


def feature_columns() -> dict[str, Column]:
    amount = F.col("TransactionAmount")
    when = event_time(F.col("TransactionDate"))
    return {
        "TransactionDateTime": when,
        "TransactionHour": F.hour(when),
        "TransactionDayOfWeek": F.dayofweek(when),
        "TransactionMonth": F.month(when),
        "DaysSincePreviousTransaction": F.datediff(when, event_time(F.col("PreviousTransactionDate"))),
        "AmountToBalanceRatio": amount_to_balance(amount, F.col("AccountBalance")),
        "IsLargeTransaction": rules.is_large(amount),
        "IsSmallTransaction": rules.is_small(amount),
        "DeviceIDPrefix": F.substring("DeviceID", 1, 4),
        "IPFirstOctet": F.split_part(F.col("IP Address"), F.lit("."), F.lit(1)),
        "IsHighRiskLocation": rules.is_high_risk_location(F.col("Location")),
        "IsFrequentLogins": rules.is_frequent_logins(F.col("LoginAttempts")),
        "IsAbnormalAge": rules.is_abnormal_age(F.col("CustomerAge")),
        "IsHighRiskChannel": rules.is_high_risk_channel(F.col("Channel")),
        "TransactionDateOnly": F.to_date(when),
    }


def derive_features(df: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Add the 14 derived columns and the day the layer is partitioned by, or only the named ones."""
    columns = feature_columns()
    return df.withColumns({name: columns[name] for name in (columns if only is None else only)})
