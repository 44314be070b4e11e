from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import as_set, by_id, frame, plan_text
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskmill import jobs
from riskmill.operators import dedup, impute, metrics, moving, quality, skew, split
from riskmill.plans import gold
from riskmill.plans import silver as silver_plan
from riskmill.plans.bronze import DAY, with_day
from riskmill.sources import workspace
from riskmill.sources.driver_tables import read_table, transactions
from riskmill.sources.files import write_by_day


@pytest.fixture(scope="module")
def events(spark):
    """Accounts of very different size; the largest holds most rows, with many in one minute."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        account = rng.choice(["hot"] * 6 + ["warm"] * 2 + [f"a{rng.randrange(200)}", None])
        rows.append((i, account, start + timedelta(seconds=rng.randrange(4000) // 7 * 7), float(rng.randrange(500))))
    return spark.createDataFrame(rows, "id long, account string, ts timestamp_ntz, amount double").repartition(5)


def _plain_lag(df):
    plain = F.lag("ts").over(Window.partitionBy("account").orderBy("ts", "id"))
    return df.withColumn("prev", F.when(F.col("account").isNotNull(), plain))


@pytest.mark.parametrize("hot_rows", [skew.HOT_ROWS, 500, 0])
def test_previous_time_equals_lag(events, hot_rows):
    got = skew.with_previous_time(events, "account", "ts", "id", "prev", hot_rows)
    assert as_set(got) == as_set(_plain_lag(events))


def test_previous_time_with_one_busy_minute_and_nulls(spark):
    """Nine rows in ten in one minute of one key, many at one time; NULL keys and NULL times."""
    rng = random.Random(8)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        account = "hot" if i % 10 else rng.choice(["a", "b", None])
        seconds = rng.choice([0, 0, 0, rng.randrange(60)]) if i % 10 else rng.randrange(90_000)
        rows.append((i, account, None if i % 97 == 0 else start + timedelta(seconds=seconds)))
    df = spark.createDataFrame(rows, "id long, account string, ts timestamp_ntz").repartition(7)
    for hot_rows in (skew.HOT_ROWS, 100):
        got = skew.with_previous_time(df, "account", "ts", "id", "prev", hot_rows)
        assert as_set(got) == as_set(_plain_lag(df))


def test_previous_time_over_many_batches_and_empty_ranges(spark):
    """Ranges of several Arrow batches, ranges without rows, a key that ends where a range does."""
    rows = [(i, f"k{i // 4000}", datetime(2024, 1, 1) + timedelta(seconds=i // 3)) for i in range(9000)]
    df = spark.createDataFrame(rows, "id long, account string, ts timestamp_ntz")
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": "100", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for partitions in ("3", "50"):
        for k, v in {**settings, "spark.sql.shuffle.partitions": partitions}.items():
            spark.conf.set(k, v)
        try:
            got = as_set(skew.with_previous_time(df, "account", "ts", "id", "prev", 500))
            few = as_set(skew.with_previous_time(df.filter("id < 4"), "account", "ts", "id", "prev", 0))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            for k, v in old.items():
                spark.conf.set(k, v)
        assert got == as_set(_plain_lag(df)) and few == as_set(_plain_lag(df.filter("id < 4")))


def test_previous_time_moves_rows_once(spark, events):
    """Without a hot key there is one exchange; with one, its rows are in no window and no join but with one row per range."""
    plan = plan_text(skew.with_previous_time(events, "account", "ts", "id", "prev"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert skew.frequent_keys(events, "account", 500) == ["hot"] or set(skew.frequent_keys(events, "account", 500)) == {"hot", "warm"}
    ranged = plan_text(skew.with_previous_time(events, "account", "ts", "id", "prev", 500))
    assert "SortMergeJoin" not in ranged and ranged.count("BroadcastHashJoin") == 1
    assert ranged.count("Window [lag(ts") == 1


def test_key_maximum_equals_window(events):
    want = events.withColumn("top", F.max("amount").over(Window.partitionBy("account")))
    got = skew.with_key_maximum(events, "account", "amount", "top")
    assert as_set(got) == as_set(want)


def test_hot_key_is_split_at_run_time(spark):
    """With broadcasts off and thresholds sized to the test, AQE splits the partition of the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        number = F.col("id")
        key = F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), number % 5000))
        rows = workspace.stage(spark.range(0, 200_000, 1, 16).select("id", key.alias("k"), (number % 977).alias("v")), "s")
        got = skew.with_key_maximum(rows, "k", "v", "top")
        assert len(got.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan_text(got)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_declared_table_schemas_hold(spark, sf_dir):
    for name in ("events", "customer", "nation"):
        assert read_table(spark, sf_dir, name).schema == spark.read.parquet(f"{sf_dir}/{name}.parquet").schema


def test_dedup_keeps_latest_then_filters(spark):
    late, early = datetime(2024, 3, 5), datetime(2024, 3, 4)
    rows = frame(
        spark,
        {"TransactionID": "A", "TransactionDate": early, "LoginAttempts": 9},
        {"TransactionID": "A", "TransactionDate": late, "LoginAttempts": 1},
        {"TransactionID": "A", "TransactionDate": late, "LoginAttempts": 2},
        {"TransactionID": "B", "TransactionDate": early},
        {"TransactionID": "B", "TransactionDate": late, "TransactionType": "Refund"},
        {"TransactionID": None},
        {"TransactionID": None, "LoginAttempts": 7},
    )
    assert by_id(silver_plan.deduplicate(rows), "LoginAttempts") == {"A": 2, "B": 1, None: 7}
    # The newest copy of B is invalid, so B is gone although an older copy is valid.
    assert by_id(silver_plan.clean(rows), "LoginAttempts") == {"A": 2}


def test_dedup_order_is_total(spark):
    rows = frame(spark, *[{"TransactionID": "A", "MerchantID": f"M{i}"} for i in range(20)])
    for parts in (1, 7):
        assert by_id(silver_plan.deduplicate(rows.repartition(parts)), "MerchantID") == {"A": "M9"}


TYING = [
    {"TransactionID": "A", "TransactionType": "Debit", "MerchantID": "M1"},
    {"TransactionID": "A", "TransactionType": "Refund", "MerchantID": "M2"},
    {"TransactionID": "B", "Channel": "Web", "MerchantID": "M8", "AccountBalance": 1.0},
    {"TransactionID": "B", "Channel": "ATM", "MerchantID": "M9", "AccountBalance": None},
    {"TransactionID": "C"},
    {"TransactionID": "C"},
]


@pytest.mark.parametrize("parts", [1, 13])
def test_reports_describe_the_silver_that_is_written(spark, tmp_path, parts):
    rows = frame(spark, *TYING).repartition(parts)
    write_by_day(with_day(rows), f"{tmp_path}/bronze", DAY)
    written = jobs.run_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver")
    report = quality.quality_report(rows, silver_plan.NEWEST_FIRST).first()
    assert (report["initial_rows"], report["final_rows"]) == (written["initial_rows"], written["final_rows"]) == (6, 2)
    required = rows.select(silver_plan.REQUIRED)
    assert quality.quality_report(required, silver_plan.NEWEST_FIRST).first() == report
    assert by_id(spark.read.parquet(f"{tmp_path}/silver"), "MerchantID") == {"B": "M8", "C": "M015"}


@pytest.mark.parametrize("wanted", [["Channel"], ["MerchantID", "CustomerAge"], ["AccountBalance"], []])
def test_pruned_queries_see_the_same_survivors(spark, wanted):
    rows = frame(spark, *TYING)
    whole = silver_plan.clean(rows)
    pruned = silver_plan.clean(rows.select(silver_plan.with_ties(wanted)).repartition(3))
    assert as_set(pruned) == as_set(whole.select(pruned.columns))
    with pytest.raises(ValueError, match="beginning of the order"):
        silver_plan.deduplicate(rows.drop("Channel"))


def test_latest_per_key_ignores_nulls_in_values(spark):
    rows = spark.createDataFrame([("k", 1, "old", 5.0), ("k", 2, None, 1.0)], "key string, t int, v string, x double")
    got = dedup.latest_per_key(rows, "key", ["t"], {"v": F.col("v")}, {"top": F.max("x")}).collect()
    assert [tuple(r) for r in got] == [("k", None, 5.0)]


def test_quality_reports_agree_with_silver(spark, sf_dir):
    bronze = transactions(spark, sf_dir)
    report = quality.quality_report(bronze, silver_plan.NEWEST_FIRST).first()
    assert report["initial_rows"] == bronze.count()
    assert report["final_rows"] == silver_plan.clean(bronze).count()
    assert report["removed"] + report["final_rows"] == report["initial_rows"]


def test_quality_report_of_nothing(spark):
    empty = frame(spark, {}).filter("false")
    assert tuple(quality.quality_report(empty, silver_plan.NEWEST_FIRST).first()) == (0, 0, 0, None, 15)


def test_silver_does_not_depend_on_partitioning(spark, sf_dir):
    bronze = transactions(spark, sf_dir)
    results = [as_set(silver_plan.silver(bronze.repartition(n))) for n in (1, 13)]
    assert results[0] == results[1]
    silver = silver_plan.silver(bronze)
    assert silver.count() == silver.select("TransactionID").distinct().count()


def test_customer_dimension_matches_window_form(spark, sf_dir):
    silver = silver_plan.silver(transactions(spark, sf_dir))
    w = Window.partitionBy("AccountID")
    newest = w.orderBy(F.desc("TransactionDateTime"), F.desc("TransactionID"))
    want = (
        silver.withColumn("max_transaction_amount", F.max("TransactionAmount").over(w))
        .withColumn("pos", F.row_number().over(newest))
        .filter("pos = 1")
        .select("AccountID", "CustomerAge", "Channel", "max_transaction_amount")
        .toDF("customer_id", "age", "preferred_channel", "max_transaction_amount")
    )
    got = gold.dim_customers(silver).select(want.columns)
    assert as_set(got) == as_set(want)


def test_stratified_split_is_exact(spark):
    rows = spark.range(5000).select(F.concat(F.lit("T"), "id").alias("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    got = split.stratified_split(rows, "id", "y", 0.2)
    by_hash = Window.partitionBy("y").orderBy(F.md5("id"))
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    want = {
        (r["id"], "test" if r["pos"] <= round(counts[r["y"]] * 0.2) else "train")
        for r in rows.withColumn("pos", F.row_number().over(by_hash)).collect()
    }
    assert {(r["id"], r["part"]) for r in got.collect()} == want


def test_split_of_tiny_class(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", 0), ("e", 0), ("f", 0)], "id string, y int")
    got = split.stratified_split(rows, "id", "y", 0.2).groupBy("y", "part").count().collect()
    assert {(r["y"], r["part"]): r["count"] for r in got} == {(1, "train"): 1, (0, "train"): 4, (0, "test"): 1}


def test_auc_equals_pair_counting_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(3)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2)) for _ in range(400)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double").repartition(4)
    assert metrics.area_under_roc(df).first()["auc"] == pytest.approx(pairs, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))) == pytest.approx(pairs, abs=1e-9)
    grouped = df.groupBy("label", "score").agg(F.count("*").alias("n"))
    assert metrics.area_under_roc(grouped, weight=F.col("n")).first()["auc"] == pytest.approx(pairs, abs=1e-12)


@pytest.mark.parametrize("form", ["crowded", "wide"])
def test_auc_of_crowded_and_wide_scores(spark, form):
    """Nearly all scores far below the width of any fixed bin, or spread beyond a million."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(4)
    small = lambda: rng.random() / 1e5 if rng.random() < 0.95 else rng.random()
    score = small if form == "crowded" else lambda: rng.uniform(-3e6, 3e6)
    rows = [(float(rng.random() < 0.3), score()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(5)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.area_under_roc(df).first()["auc"] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_auc_refuses_missing_scores(spark, bad):
    df = spark.createDataFrame([(1, 0.5), (0, 0.1), (0, bad)], "label int, score double")
    with pytest.raises(Exception, match="NULL or NaN"):
        metrics.area_under_roc(df).collect()


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, score double")
    got = metrics.evaluate(df).first()
    assert (got["accuracy"], got["precision"], got["recall"], got["f1"], got["n_classes"]) == (1, 0, 0, 0, 1)
    assert metrics.area_under_roc(df).first()["auc"] is None


def test_imputation(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, 4), (3, 4.0, 5)], "id int, a double, b int")
    got = {r["id"]: (r["a"], r["b"]) for r in impute.fill_with_means(df, ["a", "b"]).collect()}
    assert got == {1: (2.0, 4.5), 2: (3.0, 4.0), 3: (4.0, 5.0)}


def test_moving_amount_counts_calendar_days(spark):
    rows = [("c", datetime(2024, 1, d, 9), a) for d, a in ((1, 1.0), (1, 2.0), (7, 4.0), (8, 8.0), (20, 16.0))]
    facts = spark.createDataFrame(rows, "customer_id string, transaction_timestamp timestamp_ntz, amount double")
    got = {r["day"].day: r["amount_7d"] for r in moving.moving_amount(facts).collect()}
    assert got == {1: 3.0, 7: 7.0, 8: 12.0, 20: 16.0}
