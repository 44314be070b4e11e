"""Transactions derived from the ``events``, ``customer`` and ``nation`` test tables (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmill.operators.skew import with_previous_time
from riskmill.schemas import TRANSACTION_COLUMNS

# Declared, so that planning a query opens no file.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def _padded(prefix: str, number: str, width: int) -> str:
    """Prefix and number, zero-padded to at least ``width`` digits; longer numbers keep all digits."""
    text = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({text}, greatest({width}, length({text})), '0'))"


COLUMN_SQL = {
    "TransactionID": f"CASE WHEN event_id % 401 != 3 THEN {_padded('TX', 'event_id', 7)} END",
    "AccountID": _padded("AC", "user_id", 5),
    "TransactionAmount": "CASE WHEN event_id % 97 != 5 THEN IF(event_id % 41 = 0, -value, value * 20) END",
    "TransactionDate": "ts",
    "TransactionType": """CASE WHEN copy_no = 2 AND event_id % 100 = 9 THEN 'Withdrawn' ELSE CASE event_type WHEN 'purchase' THEN 'Debit' WHEN 'click' THEN 'Credit'
        WHEN 'view' THEN 'Transfer' WHEN 'signup' THEN 'Withdrawal' ELSE 'Refund' END END""",
    "Location": "CASE event_id % 9 WHEN 0 THEN 'Unknown' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE n_name END",
    "DeviceID": _padded("D", "(event_id % 681)", 6),
    "IP Address": """CASE WHEN event_id % 37 = 1 THEN '' WHEN event_id % 53 = 2 THEN NULL
        ELSE concat(1 + event_id % 223, '.', event_id % 251, '.0.', user_id % 250) END""",
    "MerchantID": _padded("M", "((event_id + copy_no div 2) * 7 % 100)", 3),
    "Channel": "CASE event_id % 4 WHEN 0 THEN 'ATM' WHEN 1 THEN 'Online' WHEN 2 THEN 'Branch' ELSE 'Mobile' END",
    "CustomerAge": "CAST(10 + user_id % 95 AS INT)",
    "CustomerOccupation": """CASE user_id % 4 WHEN 0 THEN 'Student' WHEN 1 THEN 'Doctor'
        WHEN 2 THEN 'Engineer' ELSE 'Retired' END""",
    "TransactionDuration": "CAST(10 + event_id % 290 AS INT)",
    "LoginAttempts": "CAST(1 + event_id % 6 + copy_no % 2 AS INT)",
    "AccountBalance": "CASE WHEN user_id % 149 = 1 THEN CAST(-1.0 AS DOUBLE) ELSE c_acctbal END",
    "PreviousTransactionDate": "prev_ts",
}
# Some events arrive twice: with one more login attempt, or (number 2) with the same date, logins and amount but
# another merchant and perhaps an invalid type.
COPIES_SQL = """explode(CASE event_id % 50 WHEN 7 THEN array(0, 1) WHEN 9 THEN array(0, 2) ELSE array(0) END)
    AS copy_no"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = TRANSACTION_COLUMNS
) -> DataFrame:
    """The Bronze input with the wanted columns.

    Joins and the look-back are left out when no wanted column needs them. No side of a join is forced
    to be broadcast: Spark does so only for a table it knows to be small, and otherwise shuffles both
    sides, splitting skewed accounts at run time.
    """
    rows = read_table(spark, sf_dir, "events")
    if "PreviousTransactionDate" in columns:
        rows = with_previous_time(rows, "user_id", "ts", "event_id", "prev_ts")
    if {"AccountBalance", "Location"} & set(columns):
        rows = rows.join(read_table(spark, sf_dir, "customer"), F.expr("user_id = c_custkey"), "left")
    if "Location" in columns:
        rows = rows.join(read_table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"), "left")
    return rows.selectExpr("*", COPIES_SQL).selectExpr(*[f"{COLUMN_SQL[c]} AS `{c}`" for c in columns])
