from __future__ import annotations

from datetime import datetime

from riskmill.schemas import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA

GOOD = {
    "TransactionID": "TX1",
    "AccountID": "AC1",
    "TransactionAmount": 100.0,
    "TransactionDate": datetime(2024, 3, 5, 16, 29, 14),
    "TransactionType": "Debit",
    "Location": "Lille",
    "DeviceID": "D000380",
    "IP Address": "162.198.218.92",
    "MerchantID": "M015",
    "Channel": "Branch",
    "CustomerAge": 40,
    "CustomerOccupation": "Doctor",
    "TransactionDuration": 81,
    "LoginAttempts": 1,
    "AccountBalance": 999.0,
    "PreviousTransactionDate": datetime(2024, 3, 1, 8, 0, 0),
}


def frame(spark, *changes):
    """Transactions that are good but for the given changes, one row per argument."""
    rows = [{**GOOD, "TransactionID": f"TX{i}", **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(r[c] for c in TRANSACTION_COLUMNS) for r in rows], TRANSACTION_SCHEMA)


def by_id(df, column):
    return {r["TransactionID"]: r[column] for r in df.collect()}


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
