from __future__ import annotations

from datetime import datetime

import pytest
from helpers import by_id, frame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmill.functions import rules
from riskmill.functions.features import derive_features
from riskmill.operators.quality import count_rejects, split_by_contract
from riskmill.plans.gold import dim_channels, fact_fraud_risk
from riskmill.plans.silver import apply_rules
from riskmill.schemas import PAYLOAD_FIELDS

CASES = [
    ("IsLargeTransaction", {"TransactionAmount": 5000.0}, 0),
    ("IsLargeTransaction", {"TransactionAmount": 5000.01}, 1),
    ("IsLargeTransaction", {"TransactionAmount": None}, 0),
    ("IsSmallTransaction", {"TransactionAmount": 10.0}, 0),
    ("IsSmallTransaction", {"TransactionAmount": 9.99}, 1),
    ("IsHighRiskLocation", {"Location": "Unknown"}, 1),
    ("IsHighRiskLocation", {"Location": ""}, 1),
    ("IsHighRiskLocation", {"Location": None}, 0),
    ("IsFrequentLogins", {"LoginAttempts": 3}, 0),
    ("IsFrequentLogins", {"LoginAttempts": 4}, 1),
    ("IsFrequentLogins", {"LoginAttempts": None}, 0),
    ("IsAbnormalAge", {"CustomerAge": 17}, 1),
    ("IsAbnormalAge", {"CustomerAge": 18}, 0),
    ("IsAbnormalAge", {"CustomerAge": 100}, 0),
    ("IsAbnormalAge", {"CustomerAge": 101}, 1),
    ("IsAbnormalAge", {"CustomerAge": None}, 0),
    ("IsHighRiskChannel", {"Channel": "ATM"}, 1),
    ("IsHighRiskChannel", {"Channel": "Online"}, 1),
    ("IsHighRiskChannel", {"Channel": "Mobile"}, 0),
    ("AmountToBalanceRatio", {"TransactionAmount": 50.0, "AccountBalance": 99.0}, 0.5),
    ("AmountToBalanceRatio", {"AccountBalance": -1.0}, None),
    ("AmountToBalanceRatio", {"AccountBalance": None}, None),
    ("DeviceIDPrefix", {"DeviceID": "D000380"}, "D000"),
    ("DeviceIDPrefix", {"DeviceID": "D0"}, "D0"),
    ("IPFirstOctet", {"IP Address": "162.198.218.92"}, "162"),
    ("IPFirstOctet", {"IP Address": "nodots"}, "nodots"),
    ("TransactionHour", {}, 16),
    ("TransactionDayOfWeek", {"TransactionDate": datetime(2024, 3, 3, 0, 0)}, 1),
    ("TransactionMonth", {}, 3),
    ("DaysSincePreviousTransaction", {}, 4),
    ("DaysSincePreviousTransaction", {"PreviousTransactionDate": datetime(2024, 3, 6)}, -1),
    ("DaysSincePreviousTransaction", {"PreviousTransactionDate": None}, None),
]


def test_feature_edges(spark):
    derived = derive_features(frame(spark, *[change for _, change, _ in CASES])).collect()
    rows = {r["TransactionID"]: r for r in derived}
    for i, (column, change, want) in enumerate(CASES):
        assert rows[f"TX{i}"][column] == want, (column, change)


def test_quality_filter_edges(spark):
    changes = [
        ({}, True),
        ({"TransactionAmount": 0.0}, False),
        ({"TransactionAmount": 0.01}, True),
        ({"TransactionAmount": -5.0}, False),
        ({"TransactionAmount": None}, False),
        ({"TransactionType": "Refund"}, False),
        ({"TransactionType": None}, False),
        ({"IP Address": ""}, False),
        ({"IP Address": None}, False),
        ({"IP Address": "  "}, True),
        ({"AccountID": None}, False),
        ({"TransactionDate": None}, False),
        ({"TransactionID": None}, False),
    ]
    kept = {r[0] for r in apply_rules(frame(spark, *[c for c, _ in changes])).select("TransactionID").collect()}
    assert kept == {f"TX{i}" for i, (_, keep) in enumerate(changes) if keep}


def test_text_dates_do_not_raise(spark):
    raw = frame(spark, {}, {}).withColumn(
        "TransactionDate", F.when(F.col("TransactionID") == "TX0", "2023-04-11 16:29:14").otherwise("not a date")
    )
    hours = by_id(derive_features(raw), "TransactionHour")
    assert hours == {"TX0": 16, "TX1": None}


def test_score_and_label(spark):
    rows = frame(
        spark,
        {},
        {"LoginAttempts": 4},
        {"LoginAttempts": 4, "Channel": "ATM"},
        {"LoginAttempts": 4, "Channel": "ATM", "Location": ""},
        {"LoginAttempts": 4, "Channel": "ATM", "Location": "", "TransactionAmount": 6000.0},
    )
    silver = derive_features(rows)
    assert by_id(silver.withColumn("s", rules.fraud_risk_score()), "s") == {f"TX{i}": i for i in range(5)}
    assert by_id(silver.withColumn("l", rules.fraud_label()), "l") == {f"TX{i}": int(i >= 2) for i in range(5)}


def test_unusual_amount_is_strict(spark):
    rows = frame(
        spark,
        {"TransactionAmount": 50.0, "AccountBalance": 99.0},
        {"TransactionAmount": 51.0, "AccountBalance": 99.0},
        {"AccountBalance": -1.0},
    )
    got = {r["transaction_id"]: r["unusual_amount_flag"] for r in fact_fraud_risk(derive_features(rows)).collect()}
    assert got == {"TX0": 0, "TX1": 1, "TX2": 0}


def test_channel_dimension(spark):
    rows = frame(spark, *[{"Channel": c} for c in ("ATM", "Online", "Mobile", "Branch", "Branch", None)])
    got = {r["channel_id"]: (r["channel_description"], r["risk_level"]) for r in dim_channels(rows).collect()}
    assert got == {
        "ATM": ("Automated Teller Machine", "High"),
        "Online": ("Online Banking", "High"),
        "Mobile": ("Mobile Application", "Medium"),
        "Branch": ("Other", "Medium"),
        None: ("Other", "Medium"),
    }


def test_action(spark):
    df = spark.createDataFrame([(0,), (1,)], "prediction int").withColumn("action", rules.action(F.col("prediction")))
    assert {r["prediction"]: r["action"] for r in df.collect()} == {0: "allow", 1: "block"}


@pytest.fixture
def payload(spark):
    names = [name for name, _ in PAYLOAD_FIELDS]
    good = dict.fromkeys(names, "1")
    rows = [good, {**good, "customer_age": "old"}, {**good, "login_attempts": None, "customer_age": "1.5x"}]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def test_contract(spark, payload):
    counts = {r["reason"]: r["n"] for r in count_rejects(payload, PAYLOAD_FIELDS).collect()}
    assert counts == {"malformed:customer_age": 2, "missing:login_attempts": 1}
    good, rejected = split_by_contract(payload, PAYLOAD_FIELDS)
    assert good.dtypes == [(n, t) for n, t in PAYLOAD_FIELDS]
    assert (good.count(), rejected.count()) == (1, 2)
