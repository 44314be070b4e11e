"""The jobs end to end, from CSV to scores, and the plans they run."""

from __future__ import annotations

import json

import pytest
from helpers import as_set, plan_text
from pyspark.sql import functions as F

from riskmill import __main__ as command_line
from riskmill import jobs
from riskmill.catalogue.queries import QUERIES
from riskmill.plans import reports
from riskmill.plans import silver as silver_plan
from riskmill.plans.scoring import from_payload, score, to_payload
from riskmill.plans.bronze import DAY, with_day
from riskmill.plans.training import failed_checks, train
from riskmill.schemas import FEATURES, GOLD_TABLES, LABEL_FLAGS, PAYLOAD_FIELDS
from riskmill.operators.quality import split_by_contract
from riskmill.sources.driver_tables import transactions
from riskmill.sources import files
from riskmill.sources.files import CSV_TIME, write_csv
from riskmill.sources.registry import ModelRegistry
from riskmill.streaming.transactions import dedup_stream, read_transactions, run_available, score_stream, silver_stream


@pytest.fixture(scope="module")
def root(spark, sf_dir, tmp_path_factory):
    """All layers, built by the jobs."""
    root = str(tmp_path_factory.mktemp("lake"))
    write_csv(transactions(spark, sf_dir), f"{root}/csv", CSV_TIME)
    bronze = jobs.run_bronze(spark, f"{root}/csv", f"{root}/bronze")
    assert bronze == {"rows": transactions(spark, sf_dir).count(), "days": 30, "rejected": 0}
    jobs.run_silver(spark, f"{root}/bronze", f"{root}/silver")
    jobs.run_gold(spark, f"{root}/silver", f"{root}/gold", "lake_gold", fact_buckets=4)
    return root


@pytest.fixture(scope="module")
def models(spark, root):
    """A registry with one small model."""
    registry = ModelRegistry(spark, f"{root}/models")
    result = train(spark.read.parquet(f"{root}/silver"), registry.new_path(), num_trees=5, max_depth=4)
    metrics = {r["metric"]: r["value"] for r in result.metrics.collect()}
    registry.register(result.path, result.model, result.inputs, metrics)
    return registry


def test_silver_job_reports_and_repeats(spark, root):
    before = as_set(spark.read.parquet(f"{root}/silver"))
    report = jobs.run_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert report["removed"] == report["initial_rows"] - report["final_rows"] > 0
    assert as_set(spark.read.parquet(f"{root}/silver")) == before
    assert spark.read.parquet(f"{root}/silver").agg(F.sum("TransactionHour")).first()[0] > 0


def test_gold_tables(spark, root):
    silver = spark.read.parquet(f"{root}/silver")
    for name in GOLD_TABLES:
        table = spark.table(f"lake_gold.{name}")
        assert table.count() > 0
        assert table.columns[-1] == ("dim_load_date" if name.startswith("dim") else "fact_load_date")
    risk = spark.table("lake_gold.fact_fraud_risk")
    assert risk.count() == silver.count()
    assert risk.filter(~F.col("fraud_risk_score").between(0, 4)).isEmpty()
    assert as_set(reports.gold_sql(spark, "risk_by_channel", "lake_gold")) == as_set(reports.risk_by_channel(silver))


def test_bucketed_facts_join_without_shuffle(spark, root):
    t, r = spark.table("lake_gold.fact_transactions"), spark.table("lake_gold.fact_fraud_risk")
    joined = t.join(r.hint("merge"), "transaction_id")
    assert "Exchange" not in plan_text(joined)


def test_registry(spark, root, models):
    entry = models.entries().first()
    assert entry["n_features"] == 16 and entry["features"] == FEATURES
    assert entry["test_accuracy"] > 0.7 and 0 < entry["fraud_rate"] < 1
    assert models.latest_path() == entry["path"]
    with pytest.raises(FileNotFoundError):
        ModelRegistry(spark, f"{root}/nowhere").load_latest()


def test_training_is_repeatable_and_can_leave_flags_out(spark, root):
    silver = spark.read.parquet(f"{root}/silver")
    runs = [train(silver, f"{root}/again{i}", num_trees=3, max_depth=3) for i in range(2)]
    assert as_set(runs[0].metrics) == as_set(runs[1].metrics)
    reduced = train(silver, f"{root}/reduced", without_label_flags=True, num_trees=3, max_depth=3)
    assert not set(reduced.inputs) & set(LABEL_FLAGS)
    assert reduced.model.stages[-1].numFeatures == 12


def test_training_needs_positives(spark, root):
    silver = spark.read.parquet(f"{root}/silver").withColumns({c: F.lit(0) for c in LABEL_FLAGS})
    with pytest.raises(ValueError, match="no positive label"):
        train(silver, f"{root}/never")


def test_scoring_job_and_payload(spark, root, models):
    silver = spark.read.parquet(f"{root}/silver")
    assert jobs.run_scoring(spark, f"{root}/silver", models.root, f"{root}/scored") == silver.count()
    scored = spark.read.parquet(f"{root}/scored")
    assert scored.filter((F.col("action") == "block") != (F.col("prediction") == 1)).isEmpty()
    assert scored.filter(~F.col("probability").between(0, 1)).isEmpty()
    good, _ = split_by_contract(to_payload(silver), PAYLOAD_FIELDS)
    through_payload = score(from_payload(good), models.load_latest())
    assert as_set(through_payload) == as_set(scored.join(good, "TransactionID", "left_semi"))


def test_models_that_fail_their_checks_are_refused(models):
    assert models.load_latest(failed_checks) is not None
    with pytest.raises(ValueError, match="n_trees"):
        models.load_latest(lambda model: ["n_trees"])


def test_payload_jobs(spark, root, models, tmp_path):
    payloads = to_payload(spark.read.parquet(f"{root}/silver"))
    broken = payloads.withColumn("login_attempts", F.when(F.col("transaction_hour") == "3", "x").otherwise(F.col("login_attempts")))
    broken.repartition(3).write.json(f"{tmp_path}/in")
    total = payloads.count()
    once = jobs.run_payload_scoring(spark, f"{tmp_path}/in", models.root, f"{tmp_path}/scored", f"{tmp_path}/rejected")
    assert once["scored"] > 0 and once["rejected"] > 0 and sum(once.values()) == total
    reasons = spark.read.parquet(f"{tmp_path}/rejected").select(F.explode("reasons").alias("r")).distinct().collect()
    assert "malformed:login_attempts" in {r["r"] for r in reasons}
    paths = (f"{tmp_path}/s2", f"{tmp_path}/r2", f"{tmp_path}/c2")
    assert jobs.run_payload_stream(spark, f"{tmp_path}/in", models.root, *paths, max_files=1) == once
    columns = ["TransactionID", "prediction", "action"]
    streamed = spark.read.parquet(f"{tmp_path}/s2").select(columns)
    assert as_set(streamed) == as_set(spark.read.parquet(f"{tmp_path}/scored").select(columns))


def first_valid(rows):
    """One valid copy of each transaction; here valid copies of an id differ in no column."""
    return silver_plan.apply_rules(rows).dropDuplicates(["TransactionID"])


def test_stream_equals_batch(spark, root, models, tmp_path):
    bronze = spark.read.parquet(f"{root}/bronze").drop("transaction_day")
    unique = first_valid(bronze)
    unique.unionByName(unique).repartition(6).write.parquet(f"{tmp_path}/in")
    stream = read_transactions(spark, f"{tmp_path}/in", max_files_per_batch=1)
    valid = silver_plan.derive_features(unique)
    stored = spark.read.parquet(f"{tmp_path}/in").dropDuplicates()
    features = run_available(silver_stream(stream), f"{tmp_path}/features", f"{tmp_path}/c1")
    assert as_set(features) == as_set(silver_plan.derive_features(stored))
    model = models.load_latest()
    scored = run_available(score_stream(stream, model), f"{tmp_path}/scored", f"{tmp_path}/c2")
    assert as_set(scored) == as_set(score(silver_plan.derive_features(stored), model)) and scored.count() == valid.count()


def test_stream_reads_the_day_partitioned_layer(spark, root, models, tmp_path):
    args = (f"{root}/bronze", models.root, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    valid = first_valid(spark.read.parquet(f"{root}/bronze"))
    assert jobs.run_stream_scoring(spark, *args) == valid.count()


def test_stream_resumes_without_repeating(spark, root, models, tmp_path):
    days = spark.read.parquet(f"{root}/bronze")
    args = (f"{tmp_path}/in", models.root, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    rows = days.drop("transaction_day")
    rows.filter(F.dayofmonth("TransactionDate") <= 10).write.parquet(f"{tmp_path}/in")
    first = jobs.run_stream_scoring(spark, *args)
    rows.filter(F.dayofmonth("TransactionDate") > 10).write.mode("append").parquet(f"{tmp_path}/in")
    second = jobs.run_stream_scoring(spark, *args)
    assert 0 < first < second == first_valid(rows).count()


def test_stream_dedup_loses_nothing(spark, root, tmp_path):
    """Files whose times overlap and run backwards, one per micro-batch, and a second run."""
    rows = spark.read.parquet(f"{root}/bronze").drop("transaction_day")
    for k in (4, 0, 5, 2, 3, 1):
        some = rows.filter(F.dayofmonth("TransactionDate") % 6 == k)
        some.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: run_available(
        dedup_stream(read_transactions(spark, f"{tmp_path}/in", 1)), f"{tmp_path}/out", f"{tmp_path}/c"
    )
    ids = rows.filter("TransactionID IS NOT NULL").select("TransactionID").distinct()
    assert as_set(run().select("TransactionID")) == as_set(ids)
    rows.limit(50).write.mode("append").parquet(f"{tmp_path}/in")
    assert as_set(run().select("TransactionID")) == as_set(ids)


def test_incremental_silver_equals_a_full_run(spark, root, tmp_path):
    """A new day, a changed day, a day that loses its last row, and copies that arrive on another day."""
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    rows = spark.read.parquet(f"{root}/bronze").drop("transaction_day").filter("day(TransactionDate) <= 8")
    start = rows.filter("day(TransactionDate) NOT IN (3, 6)")
    lonely = rows.filter("day(TransactionDate) = 6").orderBy("TransactionID").filter("TransactionID IS NOT NULL").limit(1)
    files.write_by_day(with_day(start.unionByName(lonely)), bronze, DAY)
    jobs.run_silver(spark, bronze, silver)
    moved = start.filter("TransactionID IS NOT NULL AND day(TransactionDate) = 2").limit(20).unionByName(lonely)
    newer = moved.withColumns({"TransactionDate": F.expr("TransactionDate + INTERVAL 9 DAYS"), "MerchantID": F.lit("late")})
    invalid = moved.limit(5).withColumns({"TransactionDate": F.expr("TransactionDate + INTERVAL 99 DAYS"), "TransactionType": F.lit("no")})
    arrived = with_day(rows.filter("day(TransactionDate) = 3").unionByName(newer).unionByName(invalid))
    files.write_by_day(arrived, bronze, DAY, replace_all=False)
    days = [str(r[0]) for r in arrived.select(DAY).distinct().collect()]
    report = jobs.run_silver(spark, bronze, silver, days)
    full = jobs.run_silver(spark, bronze, f"{tmp_path}/full")
    assert report == full
    columns = spark.read.parquet(silver).columns
    assert as_set(spark.read.parquet(silver)) == as_set(spark.read.parquet(f"{tmp_path}/full").select(columns))


def test_command_line(spark, root, tmp_path, capsys):
    (tmp_path / "nothing").mkdir()
    log = ["--run-log", f"{tmp_path}/log"]
    with pytest.raises(RuntimeError, match="bronze is missing"):
        command_line.main([*log, "silver", f"{tmp_path}/bronze", f"{tmp_path}/silver"])
    command_line.main([*log, "bronze", f"{root}/csv", f"{tmp_path}/bronze"])
    command_line.main([*log, "silver", f"{tmp_path}/bronze", f"{tmp_path}/silver"])
    done = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert done[0]["days"] == 30
    assert done[1]["final_rows"] == spark.read.parquet(f"{root}/silver").count()
    command_line.main(["gold", f"{tmp_path}/silver", f"{tmp_path}/gold", "--database", "typed_gold", "--by-days", "all"])
    command_line.main(["gold", f"{tmp_path}/silver", f"{tmp_path}/gold", "--database", "typed_gold", "--by-days", "2024-01-02,2024-01-03"])
    command_line.main(["merge-stream", f"{tmp_path}/merged", f"{tmp_path}/c", "--source", f"{tmp_path}/nothing", "--buckets", "2"])
    done = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert done[0] == done[1] and done[0]["fact_transactions"] == spark.read.parquet(f"{root}/silver").count()
    assert done[2] == {"rows": 0}


def test_gold_of_days_equals_a_full_run(spark, root, tmp_path):
    """New days, a day that has changed, one that is gone, and one that never was; facts of other days are not written."""
    source, target = f"{tmp_path}/silver", f"{tmp_path}/gold"
    silver = spark.read.parquet(f"{root}/silver").cache()
    day = F.dayofmonth("TransactionDateOnly")
    files.write_by_day(silver.filter((day < 9) & ~((day == 4) & (F.col("TransactionDuration") % 2 == 0))), source, "TransactionDateOnly")
    first = jobs.run_gold_days(spark, source, target, "by_days")
    untouched = sorted((tmp_path / "gold/days/fact_transactions/_day=2024-01-02").glob("*.parquet"))
    newer = silver.filter(day.isin(4, 10, 11)).withColumn("CustomerOccupation", F.lit("changed"))
    files.write_by_day(silver.filter((day < 9) & ~day.isin(4, 6)).unionByName(newer), source, "TransactionDateOnly")
    done = jobs.run_gold_days(spark, source, target, "by_days", ["2024-01-04", "2024-01-06", "2024-01-10", "2024-01-11", "2024-02-20"])
    jobs.run_gold(spark, source, f"{tmp_path}/full", "all_at_once")
    assert untouched == sorted((tmp_path / "gold/days/fact_transactions/_day=2024-01-02").glob("*.parquet")) and untouched
    assert not (tmp_path / "gold/days/fact_transactions/_day=2024-01-06").exists() and done != first
    for name in GOLD_TABLES:
        got, want = spark.table(f"by_days.{name}"), spark.table(f"all_at_once.{name}")
        assert got.columns == want.columns and done[name] == want.count()
        assert as_set(got.drop(got.columns[-1])) == as_set(want.drop(want.columns[-1]))
    assert {r["table"] for r in spark.sql("SHOW TABLES IN by_days").selectExpr("tableName AS table").collect()} >= set(GOLD_TABLES)
    silver.unpersist()


# --- Plans ------------------------------------------------------------------------------------------

PLANNED = sorted(
    {name for name in QUERIES}
    - {"train_rf", "feature_importance", "model_registry", "model_check", "score_batch", "stream_score"}
    - {"gold_publish", "gold_check", "catalog_tables", "gold_count", "stream_features", "stream_dedup", "stream_ids_scored"}
    - {"payload_stream", "batch_ids_scored", "train_counts", "forest_equals_model", "forest_pruned", "stream_dedup_expiring"}
    - {"gold_days_customers", "gold_days_facts", "published_versions"}
)


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan_text(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_dedup_reduces_before_the_shuffle(spark, sf_dir):
    text = plan_text(QUERIES["risk_by_channel"](spark, sf_dir))
    assert "row_number(), 1, Partial" in text


def test_top_accounts_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan_text(QUERIES["top_risk_accounts"](spark, sf_dir))
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line and "dense_rank(" in line]
    assert any("10, Partial" in line for line in limits)


def test_scans_read_only_what_is_used(spark, sf_dir):
    text = plan_text(QUERIES["partition_count"](spark, sf_dir))
    assert "customer" not in text and "nation" not in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text or (
        "ReadSchema: struct<ts:timestamp_ntz,event_id:bigint>" in text
    )


def test_filters_reach_the_scan(spark, root):
    silver = spark.read.parquet(f"{root}/silver").filter(
        (F.col("TransactionDateOnly") == "2024-01-05") & (F.col("TransactionAmount") > 5000)
    )
    text = plan_text(silver.select("TransactionID"))
    assert "GreaterThan(TransactionAmount,5000.0)" in text
    assert "PartitionFilters: [isnotnull(TransactionDateOnly" in text
    assert "ReadSchema: struct<TransactionID:string,TransactionAmount:double>" in text
