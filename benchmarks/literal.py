"""

The ten slowest queries. Same rules, but: every count is an action of its own, dedup keeps an arbitrary row, the per-account
maximum is a window over whole accounts that is deduplicated afterwards, the look-back is a window over whole
accounts, AUC is MLlib's evaluator, and nothing is staged that a step does not itself store.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.functions.features import derive_features
from riskmill.plans import gold
from riskmill.plans.silver import apply_rules
from riskmill.plans.training import MAX_DEPTH, NUM_TREES, build_pipeline, features, labelled
from riskmill.schemas import DIMENSIONS, FEATURES
from riskmill.sources.driver_tables import transactions
from riskmill.sources.workspace import fresh_path


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(apply_rules(transactions(spark, sf_dir).dropDuplicates(["TransactionID"])))


def silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = transactions(spark, sf_dir)
    bronze.count()
    rows = _silver(spark, sf_dir)
    rows.count()
    return rows


def gold_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir)
    largest = F.max("TransactionAmount").over(Window.partitionBy("AccountID"))
    table = rows.select(
        "AccountID", "CustomerAge", "CustomerOccupation", "Channel", "AccountBalance", largest.alias("largest")
    ).dropDuplicates(["AccountID"])
    table.count()
    return table


def window_max_per_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    largest = F.max("TransactionAmount").over(Window.partitionBy("AccountID"))
    return _silver(spark, sf_dir).select("TransactionID", "AccountID", largest.alias("max_transaction_amount"))


def gold_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "literal-silver")
    bronze = transactions(spark, sf_dir)
    bronze.count()
    rows = _silver(spark, sf_dir)
    rows.count()
    rows.write.parquet(path)
    silver = spark.read.parquet(path)
    silver.count()
    counts = []
    for name in gold.TABLES:
        table = gold_dim_customers_plan(silver) if name == "dim_customers" else gold.build(silver, name)
        counts.append((name, table.count()))
        table.write.parquet(fresh_path(spark, f"literal-{name}"))
    return spark.createDataFrame(counts, "table string, rows long")


def gold_dim_customers_plan(silver: DataFrame) -> DataFrame:
    largest = F.max("TransactionAmount").over(Window.partitionBy("AccountID"))
    return silver.withColumn("largest", largest).dropDuplicates(["AccountID"]).select(
        "AccountID", "CustomerAge", "CustomerOccupation", "Channel", "AccountBalance", "largest"
    )


def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights from a count, a random split, the forest, and one evaluator after the other."""
    rows = labelled(_silver(spark, sf_dir)).cache()
    counts = {r["fraud_label"]: r["count"] for r in rows.groupBy("fraud_label").count().collect()}
    weight = F.when(F.col("fraud_label") == 1, sum(counts.values()) / 2 / counts[1]).otherwise(
        sum(counts.values()) / 2 / counts[0]
    )
    train, test = rows.withColumn("weight", weight).randomSplit([0.8, 0.2], 42)
    model = build_pipeline(FEATURES, NUM_TREES, MAX_DEPTH, 42).fit(train)
    values = []
    for part in (train, test):
        predicted = model.transform(part)
        for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
            evaluator = MulticlassClassificationEvaluator(labelCol="fraud_label", metricName=name)
            values.append((name, evaluator.evaluate(predicted)))
        values.append(("auc", BinaryClassificationEvaluator(labelCol="fraud_label").evaluate(predicted)))
    rows.unpersist()
    return spark.createDataFrame(values, "metric string, value double")


def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "literal-silver")
    _silver(spark, sf_dir).write.parquet(path)
    silver = spark.read.parquet(path)
    joined = gold.fact_transactions(silver)
    for name, key in DIMENSIONS.items():
        joined = joined.join(gold.TABLES[name](silver), key, "left")
    return joined


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are found by a pass over the data."""
    path = fresh_path(spark, "literal-csv")
    transactions(spark, sf_dir).write.option("header", True).csv(path)
    rows = spark.read.option("header", True).option("inferSchema", True).csv(path)
    rows.count()
    return rows


def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features(_silver(spark, sf_dir))
    means = {c: rows.agg(F.avg(c)).first()[0] for c in FEATURES}
    return rows.select("TransactionID", *[F.coalesce(F.col(c).cast("double"), F.lit(means[c])).alias(c) for c in FEATURES])


def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "literal-silver")
    _silver(spark, sf_dir).write.parquet(path)
    silver = spark.read.parquet(path)
    facts, rows = gold.fact_transactions(silver), []
    for name, key in DIMENSIONS.items():
        dimension = gold.TABLES[name](silver)
        rows.append((name, facts.join(dimension, key, "left_anti").select(key).distinct().count(), dimension.join(facts, key, "left_anti").count()))
    return spark.createDataFrame(rows, "dimension string, n_orphans long, n_unused long")


def auc_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _silver(spark, sf_dir)
    stand_in = F.col("IsFrequentLogins") + F.col("IsHighRiskChannel") + F.col("TransactionHour") / 24
    scored = rows.select(rules.fraud_label().cast("double").alias("label"), stand_in.cast("double").alias("rawPrediction"))
    return spark.createDataFrame([(BinaryClassificationEvaluator(numBins=0).evaluate(scored),)], "auc double")


LITERAL = {
    "silver_features": silver_features,
    "gold_dim_customers": gold_dim_customers,
    "window_max_per_account": window_max_per_account,
    "gold_publish": gold_publish,
    "train_rf": train_rf,
    "star_join": star_join,
    "csv_roundtrip": csv_roundtrip,
    "impute_mean": impute_mean,
    "integrity_check": integrity_check,
    "auc_rank": auc_rank,
}
