"""The pipeline's jobs as functions of paths; ``python -m riskmill`` runs them from the command line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmill.plans import bronze as bronze_plan
from riskmill.plans import gold as gold_plan
from riskmill.operators.quality import split_by_contract
from riskmill.plans.scoring import PAYLOAD_SCHEMA, from_payload, score
from riskmill.plans.silver import silver as silver_plan
from riskmill.plans.training import failed_checks, train
from riskmill.schemas import GOLD_TABLES, PAYLOAD_FIELDS, TRANSACTION_COLUMNS
from riskmill.sources.catalog import publish_all, publish_folder, require_rows
from riskmill.sources.files import CORRUPT, read_csv, read_parquet, write_by_day
from riskmill.sources.registry import ModelRegistry
from riskmill.sources.workspace import remove, stage
from riskmill.streaming.survivors import survivors, survivors_stream
from riskmill.streaming.transactions import (
    read_payloads,
    read_transactions,
    run_available,
    score_payload_stream,
    score_stream,
)


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a stored layer, from file footers: exact even if tasks of the writing job were rerun."""
    return spark.read.parquet(path).count()


def run_bronze(
    spark: SparkSession,
    source: str,
    target: str,
    source_format: str = "csv",
    replace_all: bool = True,
    rejects: str | None = None,
) -> dict[str, int]:
    """Raw files to day partitions. With ``replace_all=False`` only the days in the source are replaced.

    Lines of CSV files with a value that does not parse are stored as they came in ``rejects`` (by default a
    folder beside the target) and counted; their rows are in Bronze with NULL for that value.
    """
    rejects = rejects or target.rstrip("/") + "_rejects"
    is_csv = source_format == "csv"
    rows = read_csv(spark, source, keep_corrupt=True) if is_csv else read_parquet(spark, source)
    require_rows(rows, source)
    n_rejected = 0
    if is_csv:
        # With all columns: a value that is pruned is not parsed, and so can't be found to be bad.
        rows.filter(F.col(CORRUPT).isNotNull()).write.mode("overwrite").parquet(rejects)
        n_rejected = count_rows(spark, rejects)
        rows = rows.drop(CORRUPT)
    write_by_day(bronze_plan.with_day(rows), target, bronze_plan.DAY, replace_all)
    stored = spark.read.parquet(target)
    days = bronze_plan.count_days(stored).first()["n_days"]
    return {"rows": stored.count(), "days": days, "rejected": n_rejected}


SILVER_DAY = "TransactionDateOnly"


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def run_silver(
    spark: SparkSession, source: str, target: str, days: Sequence[str] | None = None
) -> dict[str, float | None]:
    """Clean Bronze and derive the features. The dedup looks at all days: a copy may arrive on another one.

    ``days`` (yyyy-MM-dd) names the Bronze days that are new or have changed since ``target`` was made. Then only
    transactions with a row in these days, now or in ``target``, are made again, from all their copies, and only
    the Silver days they lie in are replaced; the result is that of a full run.
    """
    bronze = read_parquet(spark, source)
    if days is None:
        write_by_day(silver_plan(bronze.select(*_quoted(TRANSACTION_COLUMNS))), target, SILVER_DAY)
    else:
        _renew_silver(spark, bronze, target, days)
    initial, final = count_rows(spark, source), count_rows(spark, target)
    removed_pct = round(100 * (initial - final) / initial, 1) if initial else None
    return {
        "initial_rows": initial,
        "final_rows": final,
        "removed": initial - final,
        "removed_pct": removed_pct,
    }


def _renew_silver(spark: SparkSession, bronze: DataFrame, target: str, days: Sequence[str]) -> None:
    wanted = [F.lit(day).cast("date") for day in days]
    old = read_parquet(spark, target)
    touched = bronze.filter(F.col(bronze_plan.DAY).isin(*wanted)).select("TransactionID")
    touched = touched.unionByName(old.filter(F.col(SILVER_DAY).isin(*wanted)).select("TransactionID"))
    touched = stage(touched.filter(F.col("TransactionID").isNotNull()).distinct(), "touched-ids")
    copies = bronze.join(touched, "TransactionID", "left_semi").select(*_quoted(TRANSACTION_COLUMNS))
    renewed = stage(silver_plan(copies), "renewed-silver")
    replaced = old.join(touched, "TransactionID", "left_semi").select(SILVER_DAY)
    dirty = stage(replaced.unionByName(renewed.select(SILVER_DAY)).distinct(), "dirty-days")
    kept = old.join(dirty, SILVER_DAY, "left_semi").join(touched, "TransactionID", "left_anti")
    content = stage(kept.select(renewed.columns).unionByName(renewed), "dirty-silver")
    write_by_day(content, target, SILVER_DAY, replace_all=False)
    filled = content.select(SILVER_DAY).distinct()
    for row in dirty.join(filled, SILVER_DAY, "left_anti").collect():  # days without rows any more
        remove(spark, f"{target.rstrip('/')}/{SILVER_DAY}={row[0]}")


def run_gold(
    spark: SparkSession,
    source: str,
    target: str,
    database: str = "gold",
    table_format: str = "parquet",
    fact_buckets: int | None = None,
    names: Sequence[str] = GOLD_TABLES,
) -> dict[str, int]:
    """Publish the star schema, or the named tables of it. ``fact_buckets`` stores both facts so that they join without a shuffle."""
    silver = read_parquet(spark, source)
    tables = {name: (lambda name=name: gold_plan.build(silver, name)) for name in names}
    buckets = {
        name: (fact_buckets, "transaction_id") for name in names if fact_buckets and name.startswith("fact_")
    }
    return publish_all(spark, tables, database, target, table_format, buckets)


def run_gold_days(
    spark: SparkSession,
    source: str,
    target: str,
    database: str = "gold",
    days: Sequence[str] | None = None,
    table_format: str = "parquet",
) -> dict[str, int]:
    """Publish the star schema from what each day contributes; the result is that of a full run.

    ``days`` (yyyy-MM-dd) names the Silver days that are new, changed or gone since the last run; None takes all days,
    as a first run does. Of Silver only these days are read. Facts are stored by day, and a day's are replaced.
    Dimensions have a state per day (newest row and maxima by key) below ``target``; all days' states are merged and
    published as a new version.
    """
    silver = read_parquet(spark, source)
    if days is not None:
        silver = silver.filter(F.col(SILVER_DAY).isin(*[F.lit(day).cast("date") for day in days]))
    folders = {name: f"{target.rstrip('/')}/days/{name}" for name in GOLD_TABLES}
    for name, folder in folders.items():
        if name in gold_plan.FACTS:
            content = gold_plan.build(silver.withColumn("_day", F.col(SILVER_DAY)), name, "_day")
        else:
            content = gold_plan.day_state(silver.withColumnRenamed(SILVER_DAY, "_day"), name, "_day")
        write_by_day(content, folder, "_day", replace_all=days is None)
    if days is not None:
        present = {str(row[0]) for row in silver.select(SILVER_DAY).distinct().collect()}  # no more than ``days``
        for day in set(days) - present:
            for folder in folders.values():
                remove(spark, f"{folder}/_day={day}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{target}'")
    for name in gold_plan.FACTS:
        publish_folder(spark, database, name, folders[name], "_day")
    dimensions = [name for name in GOLD_TABLES if name not in gold_plan.FACTS]
    plans = {
        name: (lambda name=name: gold_plan.with_load_date(gold_plan.merged_states(spark.read.parquet(folders[name]), name), name))
        for name in dimensions
    }
    counts = publish_all(spark, plans, database, f"{target.rstrip('/')}/published", table_format)
    return {name: counts[name] if name in counts else spark.table(f"{database}.{name}").count() for name in GOLD_TABLES}


def train_and_register(
    spark: SparkSession, silver: DataFrame, models: str, without_label_flags: bool = False
) -> dict[str, float | None]:
    """Train on Silver rows and store the model; gives its metrics and path."""
    registry = ModelRegistry(spark, models)
    result = train(silver, registry.new_path(), without_label_flags)
    metrics = {row["metric"]: row["value"] for row in result.metrics.collect()}  # a dozen rows
    registry.register(result.path, result.model, result.inputs, metrics)
    return {**metrics, "path": result.path}


def run_training(
    spark: SparkSession, source: str, models: str, without_label_flags: bool = False
) -> dict[str, float | None]:
    return train_and_register(spark, read_parquet(spark, source), models, without_label_flags)


def run_scoring(spark: SparkSession, source: str, models: str, target: str) -> int:
    """Score a stored Silver layer with the latest model, unless that fails its checks."""
    model = ModelRegistry(spark, models).load_latest(failed_checks)
    score(read_parquet(spark, source), model).write.mode("overwrite").parquet(target)
    return count_rows(spark, target)


def run_payload_scoring(spark: SparkSession, source: str, models: str, target: str, rejects: str) -> dict[str, int]:
    """Decide on JSON payloads (an id and the fields of the contract, as text or numbers) with the latest model.

    Payloads with missing or malformed fields go to ``rejects`` with their reasons.
    """
    model = ModelRegistry(spark, models).load_latest(failed_checks)
    good, bad = split_by_contract(spark.read.schema(PAYLOAD_SCHEMA).json(source), PAYLOAD_FIELDS)
    score(from_payload(good), model).write.mode("overwrite").parquet(target)
    bad.write.mode("overwrite").parquet(rejects)
    return {"scored": count_rows(spark, target), "rejected": count_rows(spark, rejects)}


def run_payload_stream(
    spark: SparkSession, source: str, models: str, target: str, rejects: str, checkpoint: str, max_files: int = 1000
) -> dict[str, int]:
    """Decide on payload files not seen before, then stop."""
    model = ModelRegistry(spark, models).load_latest(failed_checks)
    payloads = read_payloads(spark, source, max_files)
    score_payload_stream(payloads, model, target, rejects, checkpoint).awaitTermination()
    return {"scored": count_rows(spark, target), "rejected": count_rows(spark, rejects)}


def run_stream_scoring(
    spark: SparkSession, source: str, models: str, target: str, checkpoint: str, max_files_per_batch: int = 1000
) -> int:
    """Score transaction files not seen before with the latest model, then stop."""
    model = ModelRegistry(spark, models).load_latest(failed_checks)
    stream = read_transactions(spark, source, max_files_per_batch)
    return run_available(score_stream(stream, model), target, checkpoint).agg(F.count("*")).first()[0]


SURVIVOR_BUCKETS = 4_096


def run_survivor_stream(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    buckets: int = SURVIVOR_BUCKETS,
    max_files_per_batch: int = 1000,
) -> int:
    """Merge transaction files not seen before into the newest copy of each id, then stop. Gives the ids so far."""
    stream = read_transactions(spark, source, max_files_per_batch)
    survivors_stream(stream, target, checkpoint, buckets).awaitTermination()
    return survivors(spark, target).count()
