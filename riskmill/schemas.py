"""Declared schemas of the layers and of the scoring payload."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.StringType()),
        T.StructField("AccountID", T.StringType()),
        T.StructField("TransactionAmount", T.DoubleType()),
        T.StructField("TransactionDate", T.TimestampNTZType()),
        T.StructField("TransactionType", T.StringType()),
        T.StructField("Location", T.StringType()),
        T.StructField("DeviceID", T.StringType()),
        T.StructField("IP Address", T.StringType()),
        T.StructField("MerchantID", T.StringType()),
        T.StructField("Channel", T.StringType()),
        T.StructField("CustomerAge", T.IntegerType()),
        T.StructField("CustomerOccupation", T.StringType()),
        T.StructField("TransactionDuration", T.IntegerType()),
        T.StructField("LoginAttempts", T.IntegerType()),
        T.StructField("AccountBalance", T.DoubleType()),
        T.StructField("PreviousTransactionDate", T.TimestampNTZType()),
    ]
)
TRANSACTION_COLUMNS = TRANSACTION_SCHEMA.fieldNames()

# Model inputs, in the fixed order both training and scoring use.
FEATURES = [
    "TransactionAmount",
    "LoginAttempts",
    "TransactionDuration",
    "AccountBalance",
    "CustomerAge",
    "TransactionHour",
    "TransactionDayOfWeek",
    "TransactionMonth",
    "DaysSincePreviousTransaction",
    "AmountToBalanceRatio",
    "IsLargeTransaction",
    "IsSmallTransaction",
    "IsHighRiskLocation",
    "IsFrequentLogins",
    "IsAbnormalAge",
    "IsHighRiskChannel",
]
# The four features the label is computed from (see plans/training.py).
LABEL_FLAGS = ["IsFrequentLogins", "IsHighRiskLocation", "IsHighRiskChannel", "IsLargeTransaction"]

# Fixed values, the scoring payload: external field name, type and the feature it feeds, in FEATURES order.
PAYLOAD_FIELDS = [
    ("transaction_amount", "double"),
    ("login_attempts", "int"),
    ("transaction_duration", "double"),
    ("account_balance", "double"),
    ("customer_age", "int"),
    ("transaction_hour", "int"),
    ("transaction_day_of_week", "int"),
    ("transaction_month", "int"),
    ("days_since_previous_transaction", "double"),
    ("amount_to_balance_ratio", "double"),
    ("is_large_transaction", "int"),
    ("is_small_transaction", "int"),
    ("is_high_risk_location", "int"),
    ("is_frequent_logins", "int"),
    ("is_abnormal_age", "int"),
    ("is_high_risk_channel", "int"),
]

DIMENSIONS = {
    "dim_customers": "customer_id",
    "dim_devices": "device_id",
    "dim_merchants": "merchant_id",
    "dim_channels": "channel_id",
}
GOLD_TABLES = [*DIMENSIONS, "fact_transactions", "fact_fraud_risk"]
