"""Business rules as Column expressions.

One definition of each rule serves batch, streaming, Gold, training and the quality report. All of
them are built-in functions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskmill.schemas import LABEL_FLAGS

# Fixed values of the risk model and of the channel dimension.
VALID_TYPES = ["Debit", "Credit", "Transfer", "Withdrawal"]
HIGH_RISK_LOCATIONS = ["Unknown", ""]
HIGH_RISK_CHANNELS = ["ATM", "Online"]
LARGE_AMOUNT = 5000
SMALL_AMOUNT = 10
MAX_LOGINS = 3
ADULT_AGE = 18
OLDEST_AGE = 100
UNUSUAL_RATIO = 0.5
FRAUD_SCORE = 2
CHANNEL_DESCRIPTIONS = {
    "ATM": "Automated Teller Machine",
    "Online": "Online Banking",
    "Mobile": "Mobile Application",
}
OTHER_CHANNEL = "Other"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def quality_rules() -> dict[str, Column]:
    """What a row must satisfy to enter Silver, by rule name; never NULL."""
    checks = {
        "has_transaction_id": F.col("TransactionID").isNotNull(),
        "has_account_id": F.col("AccountID").isNotNull(),
        "has_amount": F.col("TransactionAmount").isNotNull(),
        "has_date": F.col("TransactionDate").isNotNull(),
        "positive_amount": F.col("TransactionAmount") > 0,
        "valid_type": F.col("TransactionType").isin(VALID_TYPES),
        "valid_ip": F.col("IP Address") != "",
    }
    return {name: F.coalesce(check, F.lit(False)) for name, check in checks.items()}


def is_large(amount: Column) -> Column:
    return flag(amount > LARGE_AMOUNT)


def is_small(amount: Column) -> Column:
    return flag(amount < SMALL_AMOUNT)


def is_high_risk_location(location: Column) -> Column:
    return flag(location.isin(HIGH_RISK_LOCATIONS))


def is_frequent_logins(logins: Column) -> Column:
    return flag(logins > MAX_LOGINS)


def is_abnormal_age(age: Column) -> Column:
    return flag(~age.between(ADULT_AGE, OLDEST_AGE))


def is_high_risk_channel(channel: Column) -> Column:
    return flag(channel.isin(HIGH_RISK_CHANNELS))


def is_unusual_amount(ratio: Column) -> Column:
    return flag(ratio > UNUSUAL_RATIO)


def age_category(abnormal_age: Column) -> Column:
    return F.when(abnormal_age == 1, "High Risk").otherwise("Normal")


def channel_description(channel: Column) -> Column:
    known = F.create_map(*[F.lit(text) for pair in CHANNEL_DESCRIPTIONS.items() for text in pair])
    return F.coalesce(F.try_element_at(known, channel), F.lit(OTHER_CHANNEL))


def channel_risk_level(channel: Column) -> Column:
    return F.when(channel.isin(HIGH_RISK_CHANNELS), "High").otherwise("Medium")


def fraud_risk_score() -> Column:
    """Number of the four risk factors present, 0 to 4, from the Silver flags."""
    return reduce(add, map(F.col, LABEL_FLAGS))


def fraud_label() -> Column:
    """1 where at least two risk factors are present."""
    return (fraud_risk_score() >= FRAUD_SCORE).cast("int")


def action(prediction: Column) -> Column:
    """What to do with a scored transaction."""
    return F.when(prediction == 1, "block").otherwise("allow")
