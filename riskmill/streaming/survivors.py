"""A stream that ends with the batch layer's survivors: the newest copy of every transaction, whatever arrives when."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskmill.functions.features import derive_features
from riskmill.operators.dedup import keep_latest
from riskmill.plans.silver import NEWEST_FIRST, apply_rules
from riskmill.schemas import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from riskmill.sources.files import write_by_day
from riskmill.sources.workspace import exists, remove

BUCKET = "_bucket"


def _current(path: str) -> str:
    return f"{path.rstrip('/')}/current"


def merge_batch(batch: DataFrame, number: int, path: str, buckets: int) -> None:
    """Put the newest copies of a batch into their buckets of ids.

    Only the buckets that the batch touches are read and replaced. They are first stored complete, as what is pending
    under the batch's number, and then replace the old ones; a batch that is repeated after a failure goes on from
    what is pending, so a bucket that was being replaced is not lost. Merging a batch twice changes nothing.
    """
    spark = batch.sparkSession
    current, pending = _current(path), f"{path.rstrip('/')}/pending/batch={number}"
    if not exists(spark, f"{pending}/_SUCCESS"):
        newest = _newest(batch.filter(F.col("TransactionID").isNotNull()), buckets)
        if exists(spark, current):
            touched = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most ``buckets``
            old = spark.read.parquet(current).filter(F.col(BUCKET).isin(touched))
            newest = _newest(old.select(newest.columns).unionByName(newest), buckets)
        newest.write.mode("overwrite").parquet(pending)
    write_by_day(spark.read.parquet(pending), current, BUCKET, replace_all=False)
    remove(spark, pending)


def _newest(rows: DataFrame, buckets: int) -> DataFrame:
    """The newest copy of each id with its bucket."""
    kept = keep_latest(rows.select(*[f"`{c}`" for c in TRANSACTION_COLUMNS]), "TransactionID", NEWEST_FIRST)
    return kept.withColumn(BUCKET, F.pmod(F.xxhash64("TransactionID"), F.lit(buckets)).cast("int"))


def survivors_stream(transactions: DataFrame, path: str, checkpoint: str, buckets: int) -> StreamingQuery:
    """Merge what is there, batch by batch, and stop."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, path, buckets)

    stream = transactions.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def survivors(spark: SparkSession, path: str) -> DataFrame:
    """The newest copy of each id so far; no rows if none has arrived."""
    if not exists(spark, _current(path)):
        return spark.createDataFrame([], TRANSACTION_SCHEMA)
    return spark.read.parquet(_current(path)).drop(BUCKET)


def silver_of_survivors(spark: SparkSession, path: str) -> DataFrame:
    """Silver of what has arrived: equal to the batch layer's over the same rows."""
    return derive_features(apply_rules(survivors(spark, path)))
