"""Every operator as a named query over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.functions.features import FEATURE_SOURCES
from riskmill.jobs import run_gold, run_gold_days, train_and_register
from riskmill.operators import impute, metrics, moving, profile, quality, skew, split
from riskmill.plans import bronze as bronze_plan
from riskmill.plans import forest, gold, reports, training
from riskmill.plans import silver as silver_plan
from riskmill.plans.scoring import score, to_payload
from riskmill.schemas import (
    DIMENSIONS,
    FEATURES,
    GOLD_TABLES,
    LABEL_FLAGS,
    PAYLOAD_FIELDS,
    TRANSACTION_COLUMNS,
)
from riskmill.sources import catalog, files
from riskmill.sources.driver_tables import read_table, transactions
from riskmill.sources.registry import ModelRegistry
from riskmill.sources.workspace import application_folder, fresh_path, stage
from riskmill.streaming import survivors
from riskmill.streaming import transactions as streaming

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

PROFILED = [
    "TransactionAmount",
    "CustomerAge",
    "TransactionDuration",
    "LoginAttempts",
    "AccountBalance",
]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Inputs -----------------------------------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str, columns: Sequence[str] = TRANSACTION_COLUMNS) -> DataFrame:
    return transactions(spark, sf_dir, [c for c in TRANSACTION_COLUMNS if c in columns])


def _silver(
    spark: SparkSession, sf_dir: str, features: Sequence[str] | None = None, columns: Sequence[str] = ()
) -> DataFrame:
    """Silver with the named features and Bronze columns; all of them by default."""
    if features is None:
        return silver_plan.silver(_bronze(spark, sf_dir))
    sources = {source for feature in features for source in FEATURE_SOURCES[feature]}
    bronze = _bronze(spark, sf_dir, silver_plan.with_ties([*sources, *columns]))
    return silver_plan.silver(bronze, only=features)


def _staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a stored layer, for queries that read it several times."""
    return stage(_silver(spark, sf_dir), "silver")


def _published_gold(
    spark: SparkSession,
    sf_dir: str,
    names: Sequence[str] = GOLD_TABLES,
    features: Sequence[str] | None = None,
    columns: Sequence[str] = (),
    fact_buckets: int | None = None,
) -> str:
    """Publish Gold tables from a stored Silver layer with the named features and Bronze columns (by default
    all); gives the database's name."""
    source = fresh_path(spark, "silver")
    _silver(spark, sf_dir, features, columns).write.parquet(source)
    target = fresh_path(spark, "gold")
    database = "gold_" + target.rsplit("-", 1)[1]
    run_gold(spark, source, target, database, fact_buckets=fact_buckets, names=names)
    return database


def _large_bucket_count(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for facts of this input: one per million events, so that a bucket fits a task at any size."""
    return max(2, -(-read_table(spark, sf_dir, "events").count() // 1_000_000))


# --- Sources, sinks, catalog ------------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.write_csv(_bronze(spark, sf_dir), path)
    return files.read_csv(spark, path, files.CSV_TIME_MICROS)


@query
def bronze_partitioned(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    wanted = ["TransactionID", "TransactionAmount", "TransactionDate"]
    files.write_by_day(bronze_plan.with_day(_bronze(spark, sf_dir, wanted)), path, bronze_plan.DAY)
    return files.read_parquet(spark, path).groupBy(bronze_plan.DAY).agg(
        F.count("*").alias("n"),
        F.round(F.sum("TransactionAmount"), 2).alias("sum_amount"),
        F.sum(F.hour("TransactionDate")).alias("sum_hour"),
    )


@query
def partition_count(spark, sf_dir):
    return bronze_plan.count_days(bronze_plan.with_day(_bronze(spark, sf_dir, ["TransactionDate"])))


@query
def daily_counts(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, ["TransactionDate", "AccountID"])
    return bronze_plan.daily_counts(bronze_plan.with_day(bronze))


@query
def schema_evolution(spark, sf_dir):
    """Days up to the 15th are stored without the login column, later ones with it; read as one table."""
    path = fresh_path(spark, "evolving")
    rows = _bronze(spark, sf_dir, ["TransactionID", "TransactionDate", "LoginAttempts"])
    early = F.dayofmonth("TransactionDate") <= 15
    rows.filter(early).drop("LoginAttempts").write.parquet(f"{path}/part=1")
    rows.filter(~early).write.parquet(f"{path}/part=2")
    return files.read_parquet(spark, path, merge_schema=True).agg(
        F.count("*").alias("n"), F.count_if(F.col("LoginAttempts").isNull()).alias("n_new_null")
    )


@query
def csv_by_name(spark, sf_dir):
    """Columns in another order than the declared one, and one more."""
    path = fresh_path(spark, "csv")
    rows = _bronze(spark, sf_dir, ["TransactionID", "AccountID", "TransactionAmount", "TransactionDate"])
    others = [F.lit(None).cast("string").alias(c) for c in TRANSACTION_COLUMNS if c not in rows.columns]
    wide = rows.select(*reversed(rows.columns), F.lit("more").alias("Comment"), *others)
    files.write_csv(wide, path)
    return files.read_csv(spark, path, files.CSV_TIME_MICROS).select(rows.columns)


@query
def csv_rejects(spark, sf_dir):
    """Rows read, and raw lines of those with a value that does not parse, by what stands in its place."""
    path = fresh_path(spark, "csv")
    rows = _bronze(spark, sf_dir)
    duration = F.col("TransactionDuration")
    broken = F.when(duration % 7 == 3, "unknown").otherwise(duration.cast("string"))
    files.write_csv(rows.withColumn("TransactionDuration", broken), path)
    read = stage(files.read_csv(spark, path, files.CSV_TIME_MICROS, keep_corrupt=True), "csv-rows")
    raw = F.col(files.CORRUPT)
    return read.select("TransactionID", raw.alias("raw")).agg(
        F.count("*").alias("n"), F.count("raw").alias("n_rejected"), F.count_if(F.contains("raw", F.lit("unknown"))).alias("n_unknown")
    )


@query
def source_files(spark, sf_dir):
    """Size in bytes and rows of the files of the tables read here."""
    names = ["events", "customer", "nation"]
    rows = [
        read_table(spark, sf_dir, name).select(F.col("_metadata.file_name").alias("file")).groupBy("file").agg(F.count("*").alias("rows"))
        for name in names
    ]
    listed = files.list_files(spark, sf_dir, "*.parquet")
    return listed.join(reduce(DataFrame.unionAll, rows), "file")


@query
def source_rows(spark, sf_dir):
    return source_files(spark, sf_dir).select("file", "rows")


@query
def layer_check(spark, sf_dir):
    bronze_path, silver_path = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    files.write_by_day(bronze_plan.with_day(_bronze(spark, sf_dir)), bronze_path, bronze_plan.DAY)
    bronze = files.read_parquet(spark, bronze_path).drop(bronze_plan.DAY)
    files.write_by_day(silver_plan.silver(bronze), silver_path, "TransactionDateOnly")
    return catalog.check_layers(
        spark,
        {
            "bronze": (bronze_path, [*TRANSACTION_COLUMNS, bronze_plan.DAY]),
            "silver": (silver_path, [*TRANSACTION_COLUMNS, *FEATURE_SOURCES]),
        },
    )


def _text_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as text payloads, some with fields that are not numbers."""
    texts = to_payload(_silver(spark, sf_dir))
    seconds, hour = F.col("transaction_duration").cast("int"), F.col("transaction_hour").cast("int")
    return texts.withColumns(
        {
            "login_attempts": F.when(seconds % 13 == 5, "two").otherwise(F.col("login_attempts")),
            "transaction_amount": F.when(hour == 7, F.concat("transaction_amount", F.lit(" EUR"))).otherwise(
                F.col("transaction_amount")
            ),
        }
    )


@query
def contract_rejects(spark, sf_dir):
    return quality.count_rejects(_text_payloads(spark, sf_dir), PAYLOAD_FIELDS)


@query
def contract_split(spark, sf_dir):
    """Payloads accepted and rejected; together they are all of them."""
    good, bad = quality.split_by_contract(stage(_text_payloads(spark, sf_dir), "payloads"), PAYLOAD_FIELDS)
    named = [good.select(F.lit("good").alias("part")), bad.select(F.lit("rejected").alias("part"))]
    return named[0].unionByName(named[1]).groupBy("part").agg(F.count("*").alias("n"))


@query
def gold_publish(spark, sf_dir):
    database = _published_gold(spark, sf_dir)
    return catalog.check_tables(spark, database, GOLD_TABLES).drop("exists")


@query
def gold_check(spark, sf_dir):
    """Expected tables with rows, and whether the catalog lists them."""
    database = _published_gold(spark, sf_dir)
    listed = catalog.list_tables(spark, database).withColumn("listed", F.lit(True))
    return catalog.check_tables(spark, database, GOLD_TABLES).join(listed, "table", "left")


def _gold_by_days(spark: SparkSession, sf_dir: str) -> str:
    """Gold from the first 20 days of Silver, then from those that are new, changed (the 4th) or gone (the 30th)."""
    silver = _staged_silver(spark, sf_dir)
    day = F.dayofmonth("TransactionDateOnly")
    source, target = fresh_path(spark, "silver-days"), fresh_path(spark, "gold-days")
    database = "days_" + target.rsplit("-", 1)[1]
    half = (day == 4) & (F.col("TransactionDuration") % 2 == 0)
    files.write_by_day(silver.filter((day <= 20) & ~half | (day == 30)), source, "TransactionDateOnly")
    run_gold_days(spark, source, target, database)
    files.write_by_day(silver.filter(day != 30), source, "TransactionDateOnly")
    changed = [f"2024-01-{d:02d}" for d in (4, *range(21, 31))]
    run_gold_days(spark, source, target, database, changed)
    return database


@query
def gold_days_customers(spark, sf_dir):
    return spark.table(f"{_gold_by_days(spark, sf_dir)}.dim_customers").drop("dim_load_date")


@query
def gold_days_facts(spark, sf_dir):
    return spark.table(f"{_gold_by_days(spark, sf_dir)}.fact_transactions").drop("fact_load_date")


@query
def catalog_tables(spark, sf_dir):
    return catalog.list_tables(spark, _published_gold(spark, sf_dir))


@query
def published_versions(spark, sf_dir):
    """Daily counts published three times, over more and more days: each version as of its time, and, as version 0,
    what is shown after a step back."""
    days = stage(bronze_plan.with_day(_bronze(spark, sf_dir, ["TransactionDate"])), "days")
    target = fresh_path(spark, "versions")
    database = "versions_" + target.rsplit("-", 1)[1]
    for last in (10, 20, 31):
        so_far = days.filter(F.dayofmonth(bronze_plan.DAY) <= last).groupBy(bronze_plan.DAY).agg(F.count("*").alias("n"))
        catalog.publish_all(spark, {"daily": lambda so_far=so_far: so_far}, database, target)
    moments = [r["published_at"] for r in catalog.version_list(spark, database, "daily").collect()]
    shown = [catalog.read_as_of(spark, database, "daily", moment) for moment in moments]
    kept = [df.select(F.lit(k + 1).alias("version"), "n") for k, df in enumerate(shown[:2])]
    kept.append(stage(shown[2].select(F.lit(3).alias("version"), "n"), "newest"))
    catalog.roll_back(spark, database, "daily")
    kept.append(spark.table(f"{database}.daily").select(F.lit(0).alias("version"), "n"))
    counts = reduce(DataFrame.unionByName, kept)
    return counts.groupBy("version").agg(F.count("*").alias("n_days"), F.sum("n").alias("n"))


@query
def latest_run(spark, sf_dir):
    bronze = _bronze(spark, sf_dir, ["TransactionDate", "TransactionAmount", "Channel"])
    return bronze_plan.latest_run(bronze_plan.batch_runs(bronze_plan.with_day(bronze)))


# --- Silver -----------------------------------------------------------------------------------------


@query
def dedup_latest(spark, sf_dir):
    return silver_plan.deduplicate(_bronze(spark, sf_dir))


@query
def silver_clean(spark, sf_dir):
    return silver_plan.clean(_bronze(spark, sf_dir))


@query
def silver_features(spark, sf_dir):
    return silver_plan.silver(_bronze(spark, sf_dir))


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(_bronze(spark, sf_dir, silver_plan.REQUIRED), silver_plan.NEWEST_FIRST)


@query
def quality_by_rule(spark, sf_dir):
    return quality.quality_by_rule(_bronze(spark, sf_dir, silver_plan.REQUIRED), silver_plan.NEWEST_FIRST)


@query
def column_profile(spark, sf_dir):
    return profile.profile_columns(_bronze(spark, sf_dir, PROFILED), PROFILED)


@query
def window_max_per_account(spark, sf_dir):
    rows = stage(_silver(spark, sf_dir, []).select("TransactionID", "AccountID", "TransactionAmount"), "amounts")
    largest = skew.with_key_maximum(rows, "AccountID", "TransactionAmount", "max_transaction_amount")
    return largest.drop("TransactionAmount")


# --- Gold -------------------------------------------------------------------------------------------


@query
def gold_dim_customers(spark, sf_dir):
    columns = ["CustomerAge", "CustomerOccupation", "Channel", "AccountBalance"]
    return gold.dim_customers(_silver(spark, sf_dir, ["TransactionDateTime", "IsAbnormalAge"], columns))


@query
def gold_dim_devices(spark, sf_dir):
    return gold.dim_devices(
        _silver(spark, sf_dir, ["TransactionDateTime", "DeviceIDPrefix", "IPFirstOctet"], ["DeviceID"])
    )


@query
def gold_dim_merchants(spark, sf_dir):
    return gold.dim_merchants(_silver(spark, sf_dir, ["TransactionDateTime"], ["MerchantID", "Location"]))


@query
def gold_dim_channels(spark, sf_dir):
    return gold.dim_channels(_silver(spark, sf_dir, [], ["Channel"]))


@query
def gold_fact_transactions(spark, sf_dir):
    return gold.fact_transactions(_silver(spark, sf_dir))


@query
def gold_fact_fraud_risk(spark, sf_dir):
    return gold.fact_fraud_risk(
        _silver(spark, sf_dir, ["TransactionDateTime", "AmountToBalanceRatio", *LABEL_FLAGS])
    )


@query
def risk_score(spark, sf_dir):
    return reports.score_distribution(_silver(spark, sf_dir, LABEL_FLAGS))


@query
def gold_count(spark, sf_dir):
    return reports.gold_sql(spark, "count", _published_gold(spark, sf_dir, ["fact_transactions"]))


@query
def star_join(spark, sf_dir):
    names = [*DIMENSIONS, "fact_transactions"]
    database = _published_gold(spark, sf_dir, names)
    return reports.star_join(
        {name: spark.table(f"{database}.{name}").drop(gold.load_date_column(name)) for name in names}
    )


@query
def risk_by_channel(spark, sf_dir):
    return reports.risk_by_channel(_silver(spark, sf_dir, LABEL_FLAGS))


@query
def sql_risk_by_channel(spark, sf_dir):
    """SQL on published Gold tables whose facts are bucketed alike."""
    names = ["fact_transactions", "fact_fraud_risk", "dim_channels"]
    return reports.gold_sql(spark, "risk_by_channel", _published_gold(spark, sf_dir, names, fact_buckets=_large_bucket_count(spark, sf_dir)))


@query
def sql_spend_by_occupation(spark, sf_dir):
    database = _published_gold(spark, sf_dir, ["fact_transactions", "dim_customers"])
    return reports.gold_sql(spark, "spend_by_occupation", database)


@query
def sql_day_and_channel_totals(spark, sf_dir):
    database = _published_gold(spark, sf_dir, ["fact_transactions"])
    return reports.gold_sql(spark, "day_and_channel_totals", database)


@query
def sql_moving_amount(spark, sf_dir):
    return reports.gold_sql(spark, "moving_amount", _published_gold(spark, sf_dir, ["fact_transactions"]))


@query
def integrity_check(spark, sf_dir):
    silver = _staged_silver(spark, sf_dir)
    return reports.integrity_check({name: gold.TABLES[name](silver) for name in [*DIMENSIONS, "fact_transactions"]})


@query
def risk_rollup(spark, sf_dir):
    return reports.risk_rollup(_silver(spark, sf_dir, ["TransactionDayOfWeek"], ["Channel"]))


@query
def risk_cube(spark, sf_dir):
    return reports.risk_cube(_silver(spark, sf_dir, ["TransactionDayOfWeek"], ["Channel"]))


@query
def top_risk_accounts(spark, sf_dir):
    return reports.top_risk_accounts(_silver(spark, sf_dir, LABEL_FLAGS))


@query
def moving_amount(spark, sf_dir):
    silver = _silver(spark, sf_dir, ["TransactionDateTime"])
    facts = silver.select(
        F.col("AccountID").alias("customer_id"),
        F.col("TransactionDateTime").alias("transaction_timestamp"),
        F.col("TransactionAmount").alias("amount"),
    )
    return moving.moving_amount(facts).withColumn("amount_7d", F.round("amount_7d", 2))


# --- Training and scoring ---------------------------------------------------------------------------


def _with_stand_in(silver: DataFrame) -> DataFrame:
    """Label, and a rule in place of the forest, so that metrics can be checked in SQL."""
    stand_in = F.col("IsFrequentLogins") + F.col("IsHighRiskChannel")
    return silver.select(
        rules.fraud_label().alias("label"),
        (stand_in >= 2).cast("int").alias("prediction"),
        F.round(stand_in + F.col("TransactionHour") / 24, 6).alias("score"),
    )


def _labelled_silver(spark, sf_dir):
    return _silver(spark, sf_dir, LABEL_FLAGS).withColumn("fraud_label", rules.fraud_label())


@query
def ml_features(spark, sf_dir):
    return training.features(_silver(spark, sf_dir))


@query
def feature_means(spark, sf_dir):
    means = impute.column_means(training.features(_silver(spark, sf_dir)), FEATURES)
    return means.withColumn("mean", F.round("mean", 6))


@query
def impute_mean(spark, sf_dir):
    filled = impute.fill_with_means(stage(training.features(_silver(spark, sf_dir)), "features"), FEATURES)
    return filled.withColumns({c: F.round(c, 6) for c in FEATURES})


@query
def fraud_label(spark, sf_dir):
    return _silver(spark, sf_dir, LABEL_FLAGS).select(
        "TransactionID", rules.fraud_risk_score().alias("fraud_risk_score"), rules.fraud_label().alias("fraud_label")
    )


@query
def label_distribution(spark, sf_dir):
    return training.label_distribution(_silver(spark, sf_dir, LABEL_FLAGS))


@query
def stratified_split(spark, sf_dir):
    rows = stage(_labelled_silver(spark, sf_dir).select("TransactionID", "fraud_label"), "labels")
    return split.stratified_split(rows, "TransactionID", "fraud_label")


@query
def hash_split(spark, sf_dir):
    rows = _labelled_silver(spark, sf_dir).withColumn("part", split.hash_part(F.col("TransactionID")))
    return rows.groupBy("fraud_label", "part").agg(F.count("*").alias("n"))


@query
def class_weights(spark, sf_dir):
    weights = training.class_weights(_labelled_silver(spark, sf_dir))
    return weights.withColumn("weight", F.round("weight", 6))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_with_stand_in(_silver(spark, sf_dir, [*LABEL_FLAGS, "TransactionHour"])))


@query
def eval_metrics(spark, sf_dir):
    rows = _with_stand_in(_silver(spark, sf_dir, [*LABEL_FLAGS, "TransactionHour"]))
    return metrics.evaluate(rows).select(
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n_classes"
    )


@query
def auc_rank(spark, sf_dir):
    rows = _with_stand_in(_silver(spark, sf_dir, [*LABEL_FLAGS, "TransactionHour"]))
    return metrics.area_under_roc(rows).withColumn("auc", F.round("auc", 6))


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ModelRegistry]:
    """Silver as a stored layer, and a registry with the model of its content; trains it if there is none yet.

    The folder is named by a fingerprint of all Silver rows, so a model is used again only for equal rows, and
    what a query returns does not depend on those that ran before it.
    """
    silver = _staged_silver(spark, sf_dir)
    rows, mixed = silver.agg(F.count("*"), F.bit_xor(F.xxhash64(*silver.columns))).first()
    root = f"{application_folder(spark)}/models-{rows}-{(mixed or 0) & (2**64 - 1):016x}"
    registry = ModelRegistry(spark, root)
    try:
        registry.latest_path()
    except FileNotFoundError:
        train_and_register(spark, silver, root)
    return silver, registry


def _registry(spark: SparkSession, sf_dir: str) -> ModelRegistry:
    return _trained(spark, sf_dir)[1]


def _model(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return _registry(spark, sf_dir).load_latest(training.failed_checks)


@query
def train_rf(spark, sf_dir):
    """Metrics of a newly trained model."""
    return training.train(_staged_silver(spark, sf_dir), fresh_path(spark, "model")).metrics


@query
def train_counts(spark, sf_dir):
    """What of a model's metrics follows from the exact split alone."""
    rows = _registry(spark, sf_dir).entries().select("total_samples", F.round("fraud_rate", 6).alias("fraud_rate"))
    return rows.withColumn("n_features", F.lit(len(FEATURES)))


@query
def split_counts(spark, sf_dir):
    """Rows by label and part of the split that training uses."""
    rows = stage(_labelled_silver(spark, sf_dir).select("TransactionID", "fraud_label"), "labels")
    parts = split.stratified_split(rows, "TransactionID", "fraud_label", training.TEST_SHARE)
    return parts.groupBy("fraud_label", "part").agg(F.count("*").alias("n"))


@query
def batch_ids_scored(spark, sf_dir):
    return score_batch(spark, sf_dir).select("TransactionID", F.col("action").isin("block", "allow").alias("decided"))


@query
def feature_importance(spark, sf_dir):
    return training.feature_importance(spark, _model(spark, sf_dir))


@query
def model_registry(spark, sf_dir):
    return _registry(spark, sf_dir).entries()


@query
def model_check(spark, sf_dir):
    return training.check_model(spark, _model(spark, sf_dir))


@query
def score_batch(spark, sf_dir):
    silver, registry = _trained(spark, sf_dir)
    return score(silver, registry.load_latest(training.failed_checks))


# --- The forest as a table of nodes -------------------------------------------------------------------

# A small forest over the model's inputs, as (tree, node, feature, threshold, left, right, rows, weights).
SMALL_FOREST = [
    (0, 0, 0, 2500.0, 1, 2, 200, [120.0, 80.0]),
    (0, 1, 1, 3.0, 3, 4, 150, [110.0, 40.0]),
    (0, 2, None, None, None, None, 50, [10.0, 40.0]),
    (0, 3, None, None, None, None, 90, [81.0, 9.0]),
    (0, 4, None, None, None, None, 60, [29.0, 31.0]),
    (1, 0, 3, 1000.5, 1, 2, 200, [120.0, 80.0]),
    (1, 1, None, None, None, None, 64, [32.0, 32.0]),
    (1, 2, 5, 11.0, 3, 4, 136, [88.0, 48.0]),
    (1, 3, None, None, None, None, 80, [64.0, 16.0]),
    (1, 4, None, None, None, None, 56, [24.0, 32.0]),
    (2, 0, 9, 0.5, 1, 2, 200, [120.0, 80.0]),
    (2, 1, None, None, None, None, 120, [96.0, 24.0]),
    (2, 2, None, None, None, None, 80, [24.0, 56.0]),
]


@query
def forest_scores(spark, sf_dir):
    """Probability and action of every transaction under a small fixed forest."""
    nodes = spark.createDataFrame(SMALL_FOREST, forest.NODES)
    scored = forest.score_plain(_silver(spark, sf_dir, [c for c in FEATURES if c in FEATURE_SOURCES], ["CustomerAge", "TransactionDuration", "AccountBalance"]), nodes, depth=2)
    return scored.withColumn("probability", F.round("probability", 6))


@query
def forest_equals_model(spark, sf_dir):
    """Rows whose probability or action by the trained forest's node table differ from the model's own."""
    silver, registry = _trained(spark, sf_dir)
    model = registry.load_latest(training.failed_checks)
    nodes = stage(forest.stored_nodes(spark, registry.latest_path()), "nodes")
    own = score(silver, model).select("TransactionID", F.col("probability").alias("own"), F.col("action").alias("own_action"))
    both = forest.score_by_nodes(silver, model, nodes).join(own, "TransactionID")
    apart = F.abs(F.col("probability") - F.col("own"))
    tied = F.abs(F.col("own") - 0.5) < 1e-9
    differs = (apart > 1e-9) | ((F.col("action") != F.col("own_action")) & ~tied)
    return both.agg(F.count("*").alias("n"), F.count_if(differs).alias("n_different"))


@query
def forest_pruned(spark, sf_dir):
    """The trained forest without small splits: inner nodes under the least size, and rows that it decides."""
    silver, registry = _trained(spark, sf_dir)
    model = registry.load_latest(training.failed_checks)
    nodes = stage(forest.stored_nodes(spark, registry.latest_path()), "nodes")
    small = stage(forest.pruned(nodes), "pruned-nodes")
    inner = small.filter("feature IS NOT NULL").agg(F.count_if(F.col("rows") < forest.MIN_ROWS_TO_SPLIT).alias("n_small_splits"))
    decided = forest.score_by_nodes(silver, model, small).filter("probability BETWEEN 0 AND 1")
    return decided.agg(F.count("*").alias("n_decided")).join(F.broadcast(inner), F.col("n_small_splits") <= F.col("n_decided"))


# --- Streaming --------------------------------------------------------------------------------------

ARRIVALS = 6
FILES = 4  # of an arrival; a larger one has a file for a million rows
SURVIVOR_BUCKETS = 4  # of ids; a table of 100 TB has some ten thousand


def _arriving(spark: SparkSession, sf_dir: str, number: Column | None = None) -> DataFrame:
    """The transactions as a stream of six arrivals whose times overlap, one in each micro-batch.

    An arrival is as many files as any other, written and read by as many tasks. Without ``number``, later copies of a
    transaction are in later arrivals, so it is known which copy arrives first.
    """
    path = fresh_path(spark, "arriving")
    if number is None:
        copy = F.row_number().over(Window.partitionBy("TransactionID").orderBy(*_first_copy()))
        later = F.when(F.col("TransactionID").isNotNull() & (copy > 1), 3).otherwise(0)
        number = F.pmod(F.hash("AccountID"), F.lit(3)) + later
    rows = stage(_bronze(spark, sf_dir).withColumn("_arrival", number), "arrivals")
    files = max(FILES, -(-rows.count() // (ARRIVALS * 1_000_000)))
    for k in range(ARRIVALS):
        part = rows.filter(F.col("_arrival") == k).drop("_arrival")
        part.repartition(files).write.mode("append").parquet(path)
        listed = spark.read.schema(part.schema).parquet(path).inputFiles()
        for _ in range((k + 1) * files - len(listed)):  # tasks without rows wrote none
            part.limit(0).coalesce(1).write.mode("append").parquet(path)
    return streaming.read_transactions(spark, path, max_files_per_batch=files)


def _first_copy() -> list[Column]:
    """Fewest logins first, then the smallest merchant."""
    return [F.col("LoginAttempts").asc(), F.col("MerchantID").asc(), F.col("TransactionType").asc()]


def _run(stream: DataFrame, name: str) -> DataFrame:
    spark = stream.sparkSession
    return streaming.run_available(stream, fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint"))


@query
def stream_score(spark, sf_dir):
    return _run(streaming.score_stream(_arriving(spark, sf_dir), _model(spark, sf_dir)), "scored")


@query
def stream_ids_scored(spark, sf_dir):
    """Each transaction with a valid copy is decided once."""
    return stream_score(spark, sf_dir).groupBy("TransactionID").agg(F.count("*").alias("n"))


@query
def stream_features(spark, sf_dir):
    return _run(streaming.silver_stream(_arriving(spark, sf_dir)), "stream-silver")


@query
def stream_dedup(spark, sf_dir):
    return _run(streaming.dedup_stream(_arriving(spark, sf_dir)).select("TransactionID"), "stream-unique")


@query
def stream_dedup_expiring(spark, sf_dir):
    """Ids in the order of days, with some rows two arrivals late; state and watermark of two days."""
    days, late = (F.dayofmonth("TransactionDate") - 1) / 6, F.when(F.col("TransactionDuration") % 11 == 3, 2).otherwise(0)
    number = F.least(F.lit(ARRIVALS - 1), F.coalesce(F.floor(days), F.lit(0)) + late)
    path, checkpoint = fresh_path(spark, "expiring"), fresh_path(spark, "expiring-checkpoint")
    return streaming.run_expiring_dedup(_arriving(spark, sf_dir, number), "2 days", path, checkpoint).rows().select("TransactionID")


@query
def stream_survivors(spark, sf_dir):
    """Silver from a stream whose later arrivals hold newer, older and equal copies: that of the batch layer."""
    path = fresh_path(spark, "survivors")
    # Later copies come first for some accounts, last for others.
    copy = F.col("LoginAttempts") + F.when(F.col("MerchantID") > "M05", 1).otherwise(0)
    number = F.pmod(F.hash("AccountID", "TransactionDuration") + copy, F.lit(ARRIVALS))
    stream = _arriving(spark, sf_dir, number)
    survivors.survivors_stream(stream, path, fresh_path(spark, "survivors-checkpoint"), SURVIVOR_BUCKETS).awaitTermination()
    return survivors.silver_of_survivors(spark, path)


@query
def payload_stream(spark, sf_dir):
    """JSON payloads as a stream: how many were decided, and how many rejected for which reason."""
    source, scored, bad = (fresh_path(spark, name) for name in ("payloads", "decided", "rejected"))
    _text_payloads(spark, sf_dir).repartition(4).write.json(source)
    payloads = streaming.read_payloads(spark, source, max_files_per_batch=1)
    checkpoint = fresh_path(spark, "payload-checkpoint")
    streaming.score_payload_stream(payloads, _model(spark, sf_dir), scored, bad, checkpoint).awaitTermination()
    decided = spark.read.parquet(scored).select(F.lit("decided").alias("outcome"))
    rejected = spark.read.parquet(bad).select(F.array_join("reasons", ",").alias("outcome"))
    return decided.unionByName(rejected).groupBy("outcome").agg(F.count("*").alias("n"))
