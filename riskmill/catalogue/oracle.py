"""The queries' results in SQL (DuckDB dialect), independent of the Spark code."""

from __future__ import annotations

RAW = """
base AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, c.c_acctbal, n.n_name,
         lag(e.ts) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) AS prev_ts
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
arrivals AS (
  SELECT *, 0 AS copy_no FROM base
  UNION ALL
  SELECT *, 1 AS copy_no FROM base WHERE event_id % 50 = 7
  UNION ALL
  SELECT *, 2 AS copy_no FROM base WHERE event_id % 50 = 9),
raw AS (
  SELECT
    CASE WHEN event_id % 401 = 3 THEN NULL
         ELSE concat('TX', lpad(CAST(event_id AS VARCHAR),
                                CAST(greatest(7, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0'))
    END AS TransactionID,
    concat('AC', lpad(CAST(user_id AS VARCHAR),
                      CAST(greatest(5, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0')) AS AccountID,
    CASE WHEN event_id % 97 = 5 THEN NULL
         WHEN event_id % 41 = 0 THEN -value ELSE value * 20 END AS TransactionAmount,
    ts AS TransactionDate,
    CASE WHEN copy_no = 2 AND event_id % 100 = 9 THEN 'Withdrawn' WHEN event_type = 'purchase' THEN 'Debit' WHEN event_type = 'click' THEN 'Credit' WHEN event_type = 'view' THEN 'Transfer'
                    WHEN event_type = 'signup' THEN 'Withdrawal' ELSE 'Refund' END AS TransactionType,
    CASE event_id % 9 WHEN 0 THEN 'Unknown' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE n_name END AS Location,
    concat('D', lpad(CAST(event_id % 681 AS VARCHAR), 6, '0')) AS DeviceID,
    CASE WHEN event_id % 37 = 1 THEN '' WHEN event_id % 53 = 2 THEN NULL
         ELSE concat(CAST(1 + event_id % 223 AS VARCHAR), '.', CAST(event_id % 251 AS VARCHAR), '.0.',
                     CAST(user_id % 250 AS VARCHAR)) END AS "IP Address",
    concat('M', lpad(CAST((event_id + copy_no // 2) * 7 % 100 AS VARCHAR), 3, '0')) AS MerchantID,
    CASE event_id % 4 WHEN 0 THEN 'ATM' WHEN 1 THEN 'Online' WHEN 2 THEN 'Branch' ELSE 'Mobile' END AS Channel,
    CAST(10 + user_id % 95 AS INTEGER) AS CustomerAge,
    CASE user_id % 4 WHEN 0 THEN 'Student' WHEN 1 THEN 'Doctor' WHEN 2 THEN 'Engineer'
                     ELSE 'Retired' END AS CustomerOccupation,
    CAST(10 + event_id % 290 AS INTEGER) AS TransactionDuration,
    CAST(1 + event_id % 6 + copy_no % 2 AS INTEGER) AS LoginAttempts,
    CASE WHEN user_id % 149 = 1 THEN CAST(-1.0 AS DOUBLE) ELSE c_acctbal END AS AccountBalance,
    prev_ts AS PreviousTransactionDate
  FROM arrivals)"""

DEDUP = """,
dedup AS (
  SELECT * EXCLUDE (pos) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY TransactionID
      ORDER BY TransactionDate DESC NULLS LAST, LoginAttempts DESC NULLS LAST,
               TransactionAmount DESC NULLS LAST, AccountID DESC NULLS LAST, TransactionType DESC NULLS LAST,
               "IP Address" DESC NULLS LAST, Channel DESC NULLS LAST, CustomerAge DESC NULLS LAST,
               CustomerOccupation DESC NULLS LAST, DeviceID DESC NULLS LAST, MerchantID DESC NULLS LAST,
               TransactionDuration DESC NULLS LAST, AccountBalance DESC NULLS LAST, Location DESC NULLS LAST,
               PreviousTransactionDate DESC NULLS LAST) AS pos
    FROM raw)
  WHERE pos = 1)"""

FILTERS = """
TransactionID IS NOT NULL AND AccountID IS NOT NULL AND TransactionAmount IS NOT NULL
AND TransactionDate IS NOT NULL AND TransactionAmount > 0
AND TransactionType IN ('Debit', 'Credit', 'Transfer', 'Withdrawal') AND "IP Address" <> ''"""

CLEAN = f""",
clean AS (SELECT * FROM dedup WHERE {FILTERS})"""

# Feature columns over rows that have the 16 Bronze columns.
FEATURES_OF = """
  SELECT *,
    TransactionDate AS TransactionDateTime,
    CAST(hour(TransactionDate) AS INTEGER) AS TransactionHour,
    CAST(dayofweek(TransactionDate) + 1 AS INTEGER) AS TransactionDayOfWeek,
    CAST(month(TransactionDate) AS INTEGER) AS TransactionMonth,
    CAST(date_diff('day', CAST(PreviousTransactionDate AS DATE), CAST(TransactionDate AS DATE)) AS INTEGER)
      AS DaysSincePreviousTransaction,
    TransactionAmount / NULLIF(AccountBalance + 1, 0) AS AmountToBalanceRatio,
    CAST(CASE WHEN TransactionAmount > 5000 THEN 1 ELSE 0 END AS INTEGER) AS IsLargeTransaction,
    CAST(CASE WHEN TransactionAmount < 10 THEN 1 ELSE 0 END AS INTEGER) AS IsSmallTransaction,
    substr(DeviceID, 1, 4) AS DeviceIDPrefix,
    split_part("IP Address", '.', 1) AS IPFirstOctet,
    CAST(CASE WHEN Location IN ('Unknown', '') THEN 1 ELSE 0 END AS INTEGER) AS IsHighRiskLocation,
    CAST(CASE WHEN LoginAttempts > 3 THEN 1 ELSE 0 END AS INTEGER) AS IsFrequentLogins,
    CAST(CASE WHEN CustomerAge < 18 OR CustomerAge > 100 THEN 1 ELSE 0 END AS INTEGER) AS IsAbnormalAge,
    CAST(CASE WHEN Channel IN ('ATM', 'Online') THEN 1 ELSE 0 END AS INTEGER) AS IsHighRiskChannel,
    CAST(TransactionDate AS DATE) AS TransactionDateOnly
  FROM """

SILVER = f""",
silver AS ({FEATURES_OF} clean)"""

SCORED = """,
scored AS (
  SELECT *, CAST(fraud_risk_score >= 2 AS INTEGER) AS fraud_label FROM (
    SELECT *, CAST(IsFrequentLogins + IsHighRiskLocation + IsHighRiskChannel + IsLargeTransaction AS INTEGER)
              AS fraud_risk_score
    FROM silver))"""

_LATEST = "ORDER BY TransactionDateTime DESC NULLS LAST, TransactionID DESC NULLS LAST"

GOLD = f""",
dim_customers AS (
  SELECT AccountID AS customer_id, CustomerAge AS age, CustomerOccupation AS occupation,
         Channel AS preferred_channel, AccountBalance AS account_balance,
         CASE WHEN IsAbnormalAge = 1 THEN 'High Risk' ELSE 'Normal' END AS age_category,
         max_transaction_amount
  FROM (SELECT *, row_number() OVER (PARTITION BY AccountID {_LATEST}) AS pos,
               max(TransactionAmount) OVER (PARTITION BY AccountID) AS max_transaction_amount FROM scored)
  WHERE pos = 1),
dim_devices AS (
  SELECT DeviceID AS device_id, DeviceIDPrefix AS device_prefix, IPFirstOctet AS ip_first_octet,
         "IP Address" AS ip_address
  FROM (SELECT *, row_number() OVER (PARTITION BY DeviceID {_LATEST}) AS pos FROM scored) WHERE pos = 1),
dim_merchants AS (
  SELECT MerchantID AS merchant_id, Location AS merchant_location
  FROM (SELECT *, row_number() OVER (PARTITION BY MerchantID {_LATEST}) AS pos FROM scored) WHERE pos = 1),
dim_channels AS (
  SELECT DISTINCT Channel AS channel_id,
         CASE Channel WHEN 'ATM' THEN 'Automated Teller Machine' WHEN 'Online' THEN 'Online Banking'
                      WHEN 'Mobile' THEN 'Mobile Application' ELSE 'Other' END AS channel_description,
         CASE WHEN Channel IN ('ATM', 'Online') THEN 'High' ELSE 'Medium' END AS risk_level
  FROM scored),
fact_transactions AS (
  SELECT TransactionID AS transaction_id, AccountID AS customer_id, MerchantID AS merchant_id,
         DeviceID AS device_id, Channel AS channel_id, TransactionAmount AS amount,
         TransactionType AS transaction_type, TransactionDateTime AS transaction_timestamp,
         LoginAttempts AS login_attempts, TransactionDuration AS duration_seconds,
         IsHighRiskLocation AS is_high_risk_location, IsHighRiskChannel AS is_high_risk_channel,
         AmountToBalanceRatio AS amount_to_balance_ratio,
         DaysSincePreviousTransaction AS days_since_previous
  FROM scored),
fact_fraud_risk AS (
  SELECT TransactionID AS transaction_id, AccountID AS customer_id, fraud_risk_score,
         CAST(CASE WHEN LoginAttempts > 3 THEN 1 ELSE 0 END AS INTEGER) AS suspicious_login_flag,
         CAST(CASE WHEN AmountToBalanceRatio > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS unusual_amount_flag,
         TransactionDateTime AS risk_assessment_timestamp
  FROM scored)"""

STAND_IN = """,
judged AS (
  SELECT fraud_label AS label, CAST(IsFrequentLogins + IsHighRiskChannel >= 2 AS INTEGER) AS prediction,
         round(IsFrequentLogins + IsHighRiskChannel + TransactionHour / 24.0::DOUBLE, 6) AS score
  FROM scored)"""

# Fixed values, kept apart from the code they check: names of features, payload fields, tables and columns.
_FEATURE_NAMES = [
    "TransactionAmount", "LoginAttempts", "TransactionDuration", "AccountBalance", "CustomerAge",
    "TransactionHour", "TransactionDayOfWeek", "TransactionMonth", "DaysSincePreviousTransaction",
    "AmountToBalanceRatio", "IsLargeTransaction", "IsSmallTransaction", "IsHighRiskLocation",
    "IsFrequentLogins", "IsAbnormalAge", "IsHighRiskChannel",
]
_PAYLOAD_NAMES = [
    "transaction_amount", "login_attempts", "transaction_duration", "account_balance", "customer_age",
    "transaction_hour", "transaction_day_of_week", "transaction_month", "days_since_previous_transaction",
    "amount_to_balance_ratio", "is_large_transaction", "is_small_transaction", "is_high_risk_location",
    "is_frequent_logins", "is_abnormal_age", "is_high_risk_channel",
]
_GOLD_TABLES = [
    "dim_customers", "dim_devices", "dim_merchants", "dim_channels", "fact_transactions", "fact_fraud_risk",
]
_PROFILED = ["TransactionAmount", "CustomerAge", "TransactionDuration", "LoginAttempts", "AccountBalance"]
_BRONZE_NAMES = [
    "TransactionID", "AccountID", "TransactionAmount", "TransactionDate", "TransactionType", "Location",
    "DeviceID", "IP Address", "MerchantID", "Channel", "CustomerAge", "CustomerOccupation",
    "TransactionDuration", "LoginAttempts", "AccountBalance", "PreviousTransactionDate",
]


def _over_raw(select: str) -> str:
    return f"WITH {RAW}\n{select}"


def _over_dedup(select: str) -> str:
    return f"WITH {RAW}{DEDUP}\n{select}"


def _over_clean(select: str) -> str:
    return f"WITH {RAW}{DEDUP}{CLEAN}\n{select}"


def _over_silver(select: str) -> str:
    return f"WITH {RAW}{DEDUP}{CLEAN}{SILVER}\n{select}"


def _over_scored(select: str) -> str:
    return f"WITH {RAW}{DEDUP}{CLEAN}{SILVER}{SCORED}\n{select}"


def _over_gold(select: str) -> str:
    return f"WITH {RAW}{DEDUP}{CLEAN}{SILVER}{SCORED}{GOLD}\n{select}"


def _over_judged(select: str) -> str:
    return f"WITH {RAW}{DEDUP}{CLEAN}{SILVER}{SCORED}{STAND_IN}\n{select}"


def _over_payloads(select: str) -> str:
    nulls = " OR ".join(f"{f} IS NULL" for f in _FEATURE_NAMES)
    return f"""WITH {RAW}{DEDUP}{CLEAN}{SILVER},
payloads AS (
  SELECT *, TransactionDuration % 13 = 5 AS bad_logins, TransactionHour = 7 AS bad_amount, {nulls} AS incomplete
  FROM silver)
{select}"""


# The first valid copy to arrive: fewest logins, then the smallest merchant (the test streams deliver them so).
_FIRST_VALID = f"""WITH {RAW},
first_valid AS (
  SELECT * EXCLUDE (pos, nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY nth) AS pos FROM (
      SELECT *, row_number() OVER (PARTITION BY TransactionID
                                   ORDER BY LoginAttempts, MerchantID, TransactionType) AS nth FROM raw)
    WHERE {FILTERS})
  WHERE pos = 1)"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_WEEKDAY_TOTALS = """
SELECT TransactionDayOfWeek AS weekday, Channel AS channel_id,
       GROUPING(TransactionDayOfWeek, Channel) AS gid, count(*) AS n,
       round(sum(TransactionAmount), 2) AS sum_amount
FROM silver GROUP BY {grouping}(TransactionDayOfWeek, Channel)"""

_RULES = {
    "has_transaction_id": "TransactionID IS NOT NULL",
    "has_account_id": "AccountID IS NOT NULL",
    "has_amount": "TransactionAmount IS NOT NULL",
    "has_date": "TransactionDate IS NOT NULL",
    "positive_amount": "TransactionAmount > 0",
    "valid_type": "TransactionType IN ('Debit', 'Credit', 'Transfer', 'Withdrawal')",
    "valid_ip": "\"IP Address\" <> ''",
}

ORACLE = {
    "csv_roundtrip": _over_raw(
        "SELECT "
        + ", ".join(
            f"nullif(\"{c}\", '') AS \"{c}\"" if c in ("Location", "IP Address") else f'"{c}"' for c in _BRONZE_NAMES
        )
        + " FROM raw"
    ),
    "bronze_partitioned": _over_raw(
        """SELECT CAST(TransactionDate AS DATE) AS transaction_day, count(*) AS n,
           round(sum(TransactionAmount), 2) AS sum_amount, CAST(sum(hour(TransactionDate)) AS BIGINT) AS sum_hour
           FROM raw GROUP BY 1"""
    ),
    "partition_count": _over_raw("SELECT count(DISTINCT CAST(TransactionDate AS DATE)) AS n_days FROM raw"),
    "daily_counts": _over_raw(
        """SELECT CAST(TransactionDate AS DATE) AS transaction_day, count(*) AS n,
           count(DISTINCT AccountID) AS n_accounts FROM raw GROUP BY 1"""
    ),
    "schema_evolution": _over_raw(
        """SELECT count(*) AS n, count(*) FILTER (
             WHERE day(TransactionDate) <= 15 OR LoginAttempts IS NULL) AS n_new_null FROM raw"""
    ),
    "layer_check": _over_clean(
        """SELECT 'bronze' AS layer, count(*) AS rows, CAST(0 AS INTEGER) AS columns_missing FROM raw
           UNION ALL SELECT 'silver', count(*), CAST(0 AS INTEGER) FROM clean"""
    ),
    "contract_rejects": _over_payloads(
        "SELECT * FROM ("
        + _union(
            [
                f"SELECT 'missing:{p}' AS reason, count(*) AS n FROM silver WHERE {f} IS NULL"
                for f, p in zip(_FEATURE_NAMES, _PAYLOAD_NAMES)
            ]
            + [
                "SELECT 'malformed:login_attempts', count(*) FROM payloads WHERE bad_logins",
                "SELECT 'malformed:transaction_amount', count(*) FROM payloads WHERE bad_amount",
            ]
        )
        + ") WHERE n > 0"
    ),
    "contract_split": _over_payloads(
        """SELECT CASE WHEN incomplete OR bad_logins OR bad_amount THEN 'rejected' ELSE 'good' END AS part,
           count(*) AS n FROM payloads GROUP BY 1"""
    ),
    "payload_stream": _over_payloads(
        """SELECT CASE WHEN reasons = '' THEN 'decided' ELSE reasons END AS outcome, count(*) AS n
           FROM (SELECT concat_ws(',', """
        + ", ".join(
            {
                "LoginAttempts": "CASE WHEN bad_logins THEN 'malformed:login_attempts' END",
                "TransactionAmount": "CASE WHEN bad_amount THEN 'malformed:transaction_amount' END",
            }.get(f, f"CASE WHEN {f} IS NULL THEN 'missing:{p}' END")
            for f, p in zip(_FEATURE_NAMES, _PAYLOAD_NAMES)
        )
        + """) AS reasons FROM payloads) GROUP BY 1"""
    ),
    "csv_by_name": _over_raw("SELECT TransactionID, AccountID, TransactionAmount, TransactionDate FROM raw"),
    "csv_rejects": _over_raw(
        """SELECT count(*) AS n, count(*) FILTER (WHERE TransactionDuration % 7 = 3) AS n_rejected,
           count(*) FILTER (WHERE TransactionDuration % 7 = 3) AS n_unknown FROM raw"""
    ),
    "source_rows": _union(
        [f"SELECT '{t}.parquet' AS file, count(*) AS rows FROM {t}" for t in ("events", "customer", "nation")]
    ),
    "gold_publish": _over_gold(
        _union([f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in _GOLD_TABLES])
    ),
    "gold_check": _over_gold(
        _union([f"SELECT '{t}' AS \"table\", count(*) AS rows, true AS \"exists\", true AS listed FROM {t}" for t in _GOLD_TABLES])
    ),
    "catalog_tables": _over_gold(
        _union([f"SELECT '{t}' AS \"table\" FROM {t} HAVING count(*) > 0" for t in _GOLD_TABLES])
    ),
    "latest_run": _over_raw(
        """SELECT dag_id, state, execution_date FROM (
             SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY execution_date DESC) AS pos FROM (
               SELECT 'load_' || lower(Channel) AS dag_id, max(TransactionDate) AS execution_date,
                 CASE WHEN count(*) = count(TransactionAmount) THEN 'success' ELSE 'failed' END AS state
               FROM raw GROUP BY Channel, CAST(TransactionDate AS DATE)))
           WHERE pos = 1"""
    ),
    "dedup_latest": _over_dedup("SELECT * FROM dedup"),
    "silver_clean": _over_clean("SELECT * FROM clean"),
    "silver_features": _over_silver("SELECT * FROM silver"),
    "quality_report": _over_clean(
        """SELECT i AS initial_rows, f AS final_rows, i - f AS removed, round(100.0::DOUBLE * (i - f) / i, 4) AS removed_pct,
           CAST(15 AS INTEGER) AS new_features
           FROM (SELECT (SELECT count(*) FROM raw) AS i, (SELECT count(*) FROM clean) AS f)"""
    ),
    "quality_by_rule": _over_dedup(
        _union(
            [
                f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({check}, false)) AS n_failed FROM dedup"
                for name, check in _RULES.items()
            ]
        )
    ),
    "column_profile": _over_raw(
        _union(
            [
                f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
                round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
                CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" FROM raw"""
                for c in _PROFILED
            ]
        )
    ),
    "window_max_per_account": _over_clean(
        """SELECT TransactionID, AccountID,
           max(TransactionAmount) OVER (PARTITION BY AccountID) AS max_transaction_amount FROM clean"""
    ),
    **{f"gold_{t}": _over_gold(f"SELECT * FROM {t}") for t in _GOLD_TABLES},
    "risk_score": _over_scored("SELECT fraud_risk_score, count(*) AS n FROM scored GROUP BY 1"),
    "gold_count": _over_gold("SELECT count(*) AS n FROM fact_transactions"),
    "star_join": _over_gold(
        """SELECT * FROM fact_transactions LEFT JOIN dim_customers USING (customer_id)
           LEFT JOIN dim_devices USING (device_id) LEFT JOIN dim_merchants USING (merchant_id)
           LEFT JOIN dim_channels USING (channel_id)"""
    ),
    "risk_by_channel": _over_gold(
        """SELECT c.channel_id, c.risk_level, count(*) AS n, round(avg(s.fraud_risk_score), 6) AS mean_score,
           round(avg(s.fraud_label), 6) AS flagged_share
           FROM scored s LEFT JOIN dim_channels c ON s.Channel = c.channel_id GROUP BY ALL"""
    ),
    "sql_risk_by_channel": _over_gold(
        """SELECT c.channel_id, c.risk_level, count(*) AS n, round(avg(r.fraud_risk_score), 6) AS mean_score,
           round(avg(CASE WHEN r.fraud_risk_score >= 2 THEN 1 ELSE 0 END), 6) AS flagged_share
           FROM fact_transactions t JOIN fact_fraud_risk r USING (transaction_id)
           LEFT JOIN dim_channels c ON t.channel_id = c.channel_id GROUP BY ALL"""
    ),
    "sql_spend_by_occupation": _over_gold(
        """SELECT d.occupation, d.age_category, count(*) AS n, round(sum(t.amount), 2) AS sum_amount
           FROM fact_transactions t LEFT JOIN dim_customers d ON t.customer_id = d.customer_id GROUP BY ALL"""
    ),
    "sql_day_and_channel_totals": _over_gold(
        """SELECT CAST(transaction_timestamp AS DATE) AS day, channel_id,
           GROUPING(CAST(transaction_timestamp AS DATE), channel_id) AS gid, count(*) AS n,
           round(sum(amount), 2) AS sum_amount FROM fact_transactions
           GROUP BY GROUPING SETS ((CAST(transaction_timestamp AS DATE)), (channel_id), ())"""
    ),
    "integrity_check": _over_gold(
        _union(
            [
                f"""SELECT '{dim}' AS dimension,
                (SELECT count(DISTINCT f.{key}) FROM fact_transactions f
                 WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})) AS n_orphans,
                (SELECT count(*) FROM {dim} d
                 WHERE NOT EXISTS (SELECT 1 FROM fact_transactions f WHERE f.{key} = d.{key})) AS n_unused"""
                for dim, key in [
                    ("dim_customers", "customer_id"),
                    ("dim_devices", "device_id"),
                    ("dim_merchants", "merchant_id"),
                    ("dim_channels", "channel_id"),
                ]
            ]
        )
    ),
    "risk_rollup": _over_silver(_WEEKDAY_TOTALS.format(grouping="ROLLUP")),
    "risk_cube": _over_silver(_WEEKDAY_TOTALS.format(grouping="CUBE")),
    "top_risk_accounts": _over_scored(
        """SELECT * FROM (
             SELECT channel_id, customer_id, score_sum, CAST(dense_rank() OVER (
               PARTITION BY channel_id ORDER BY score_sum DESC, customer_id) AS INTEGER) AS rnk
             FROM (SELECT Channel AS channel_id, AccountID AS customer_id,
                   CAST(sum(fraud_risk_score) AS BIGINT) AS score_sum FROM scored GROUP BY 1, 2))
           WHERE rnk <= 10"""
    ),
    "ml_features": _over_silver(f"SELECT TransactionID, {', '.join(_FEATURE_NAMES)} FROM silver"),
    "feature_means": _over_silver(
        _union([f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean FROM silver" for c in _FEATURE_NAMES])
    ),
    "impute_mean": _over_silver(
        "SELECT TransactionID, "
        + ", ".join(
            f"round(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM silver)), 6) AS {c}" for c in _FEATURE_NAMES
        )
        + " FROM silver"
    ),
    "fraud_label": _over_scored("SELECT TransactionID, fraud_risk_score, fraud_label FROM scored"),
    "label_distribution": _over_scored(
        """SELECT fraud_label, count(*) AS n,
           round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM scored), 6) AS share FROM scored GROUP BY 1"""
    ),
    "stratified_split": _over_scored(
        """SELECT TransactionID, fraud_label, CASE WHEN pos <= round(n * 0.2) THEN 'test' ELSE 'train' END AS part
           FROM (SELECT *, row_number() OVER (PARTITION BY fraud_label ORDER BY md5(TransactionID)) AS pos,
                 count(*) OVER (PARTITION BY fraud_label) AS n FROM scored)"""
    ),
    "hash_split": _over_scored(
        """SELECT fraud_label, CASE WHEN CAST('0x' || substr(md5(TransactionID), 1, 8) AS BIGINT) % 100 < 20
           THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM scored GROUP BY ALL"""
    ),
    "class_weights": _over_scored(
        """SELECT fraud_label, round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6)
           AS weight FROM scored GROUP BY 1"""
    ),
    "confusion_matrix": _over_judged("SELECT label, prediction, count(*) AS n FROM judged GROUP BY ALL"),
    "eval_metrics": _over_judged(
        """SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, n_classes
           FROM (SELECT CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
                 CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
                 CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
                 CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
                 count(DISTINCT label) AS n_classes FROM judged)"""
    ),
    "auc_rank": _over_judged(
        """SELECT round(CAST((sum(CASE WHEN label = 1 THEN mean_rank END) - n_pos * (n_pos + 1) / 2.0)
                     AS DOUBLE) / (n_pos * n_neg), 6) AS auc
           FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0
                   AS mean_rank,
                 count(*) FILTER (WHERE label = 1) OVER () AS n_pos,
                 count(*) FILTER (WHERE label = 0) OVER () AS n_neg FROM judged)
           GROUP BY n_pos, n_neg"""
    ),
    "stream_features": f"{_FIRST_VALID}\n{FEATURES_OF} first_valid",
    "stream_ids_scored": f"{_FIRST_VALID}\nSELECT TransactionID, CAST(1 AS BIGINT) AS n FROM first_valid",
    "batch_ids_scored": _over_clean("SELECT TransactionID, true AS decided FROM clean"),
    "train_counts": _over_scored(
        """SELECT count(*) AS total_samples, round(avg(fraud_label), 6) AS fraud_rate, CAST(16 AS INTEGER) AS n_features
           FROM scored"""
    ),
    "split_counts": _over_scored(
        """SELECT fraud_label, part, count(*) AS n FROM (
             SELECT fraud_label, CASE WHEN pos <= round(n * 0.2) THEN 'test' ELSE 'train' END AS part
             FROM (SELECT fraud_label, row_number() OVER (PARTITION BY fraud_label) AS pos,
                   count(*) OVER (PARTITION BY fraud_label) AS n FROM scored)) GROUP BY ALL"""
    ),
    "stream_dedup": _over_raw("SELECT DISTINCT TransactionID FROM raw WHERE TransactionID IS NOT NULL"),
}

# Gold of all days but the 30th.
ORACLE["gold_days_customers"], ORACLE["gold_days_facts"] = (
    _over_gold(f"SELECT * FROM {name}").replace("FROM silver))", "FROM silver WHERE day(TransactionDate) <> 30))")
    for name in ("dim_customers", "fact_transactions")
)
ORACLE["published_versions"] = _over_raw(
    """SELECT version, count(DISTINCT CAST(TransactionDate AS DATE)) AS n_days, CAST(count(*) AS BIGINT) AS n
       FROM raw, (VALUES (1, 10), (2, 20), (3, 31), (0, 20)) AS t(version, last)
       WHERE day(TransactionDate) <= last GROUP BY version"""
)
ORACLE["stream_survivors"] = ORACLE["silver_features"]
ORACLE["stream_dedup_expiring"] = ORACLE["stream_dedup"]
ORACLE["forest_equals_model"] = _over_clean("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM clean")
ORACLE["forest_pruned"] = _over_clean("SELECT count(*) AS n_decided, CAST(0 AS BIGINT) AS n_small_splits FROM clean")
ORACLE["forest_scores"] = f"""WITH {RAW}{DEDUP}{CLEAN}{SILVER},
nodes(tree, node, feature, threshold, lft, rgt, w0, w1) AS (VALUES
  (0, 0, 1, 2500.0, 1, 2, 120, 80), (0, 1, 2, 3.0, 3, 4, 110, 40), (0, 2, NULL, NULL, NULL, NULL, 10, 40),
  (0, 3, NULL, NULL, NULL, NULL, 81, 9), (0, 4, NULL, NULL, NULL, NULL, 29, 31),
  (1, 0, 4, 1000.5, 1, 2, 120, 80), (1, 1, NULL, NULL, NULL, NULL, 32, 32), (1, 2, 6, 11.0, 3, 4, 88, 48),
  (1, 3, NULL, NULL, NULL, NULL, 64, 16), (1, 4, NULL, NULL, NULL, NULL, 24, 32),
  (2, 0, 10, 0.5, 1, 2, 120, 80), (2, 1, NULL, NULL, NULL, NULL, 96, 24), (2, 2, NULL, NULL, NULL, NULL, 24, 56)),
inputs AS (SELECT TransactionID, [{", ".join(f"CAST({c} AS DOUBLE)" for c in _FEATURE_NAMES)}] AS x FROM silver),
steps AS (SELECT *, CASE WHEN feature IS NULL THEN node END AS stay FROM nodes),
one AS (
  SELECT TransactionID, x, tree, coalesce(stay, CASE WHEN x[feature] <= threshold THEN lft ELSE rgt END) AS node
  FROM inputs, steps WHERE node = 0),
two AS (
  SELECT TransactionID, tree, coalesce(stay, CASE WHEN x[feature] <= threshold THEN lft ELSE rgt END) AS node
  FROM one JOIN steps USING (tree, node)),
chances AS (
  SELECT TransactionID, avg(CAST(w1 AS DOUBLE) / (w0 + w1)) AS p FROM two JOIN nodes USING (tree, node) GROUP BY 1)
SELECT TransactionID, round(p, 6) AS probability, CAST(p > 0.5 AS INTEGER) AS prediction,
       CASE WHEN p > 0.5 THEN 'block' ELSE 'allow' END AS action
FROM chances"""

_MOVING = _over_clean(
    """SELECT customer_id, day, round(sum(amount) OVER (
         PARTITION BY customer_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2)
         AS amount_7d
       FROM (SELECT AccountID AS customer_id, CAST(TransactionDate AS DATE) AS day, sum(TransactionAmount) AS amount
             FROM clean GROUP BY 1, 2)"""
)
ORACLE["moving_amount"] = _MOVING
ORACLE["sql_moving_amount"] = _MOVING
