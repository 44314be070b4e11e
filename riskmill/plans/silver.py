"""Silver: one valid row per transaction, with derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.functions.features import derive_features
from riskmill.functions.rules import quality_rules
from riskmill.operators.dedup import keep_latest

# Which copy of a transaction survives: the newest, with most logins, with the largest amount; the other columns
# break ties, first those that the quality rules read, last those that cost most to make. A query that reads some
# of the columns also reads all that come before them here, so every query sees the same survivor.
NEWEST_FIRST = [
    "TransactionDate",
    "LoginAttempts",
    "TransactionAmount",
    "AccountID",
    "TransactionType",
    "IP Address",
    "Channel",
    "CustomerAge",
    "CustomerOccupation",
    "DeviceID",
    "MerchantID",
    "TransactionDuration",
    "AccountBalance",
    "Location",
    "PreviousTransactionDate",
]
# Columns deduplication and the quality rules read.
REQUIRED = ["TransactionID", *NEWEST_FIRST[:6]]


def with_ties(columns: Iterable[str]) -> list[str]:
    """The Bronze columns to read when these are wanted of the survivors."""
    last = max([NEWEST_FIRST.index(c) for c in columns if c in NEWEST_FIRST], default=0)
    return [*REQUIRED, *NEWEST_FIRST[6 : last + 1]]


def deduplicate(bronze: DataFrame) -> DataFrame:
    """The newest row of every TransactionID (rows without id count as one id)."""
    return keep_latest(bronze, "TransactionID", NEWEST_FIRST)


def apply_rules(df: DataFrame) -> DataFrame:
    """Rows that satisfy every quality rule."""
    return df.filter(reduce(lambda a, b: a & b, quality_rules().values()))


def clean(bronze: DataFrame) -> DataFrame:
    """Deduplicate, then filter. The order matters: a newest copy that breaks a rule removes its id.

    Only the check on the id itself may run earlier, since it holds for all copies or none; it keeps
    rows without id out of the shuffle.
    """
    return apply_rules(deduplicate(bronze.filter(F.col("TransactionID").isNotNull())))


def silver(bronze: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The Silver layer as a plan over Bronze; ``only`` names the derived columns wanted."""
    return derive_features(clean(bronze), only)
