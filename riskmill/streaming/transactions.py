"""Structured Streaming over files of transactions: features, scores, dedup."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from riskmill.functions.features import derive_features
from riskmill.operators.quality import split_by_contract
from riskmill.plans.scoring import PAYLOAD_SCHEMA, from_payload, score
from riskmill.plans.silver import apply_rules
from riskmill.schemas import PAYLOAD_FIELDS, TRANSACTION_SCHEMA


def read_transactions(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of transactions as they arrive."""
    reader = spark.readStream.schema(TRANSACTION_SCHEMA)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def dedup_stream(transactions: DataFrame) -> DataFrame:
    """Transactions with an id not seen before; all ids are remembered, so no row is ever too late.

    The first copy to arrive is kept, while the batch layer keeps the newest: the two agree on ids, and
    on whole rows when copies are equal. Rows without id are left out here as they are in Silver. The ids
    live in the state store, which clusters keep on disk (RocksDB, see the session).
    """
    return transactions.filter(F.col("TransactionID").isNotNull()).dropDuplicates(["TransactionID"])


def expiring_dedup_stream(transactions: DataFrame, delay: str) -> DataFrame:
    """Transactions with an id not seen within ``delay`` of event time; ids are forgotten after that, so state is bounded.

    Rows without id or date, and those that come later than ``delay`` after the newest date before them, are not
    here: see ``run_expiring_dedup``, which loses none.
    """
    dated = transactions.filter(F.col("TransactionID").isNotNull() & F.col("TransactionDate").isNotNull())
    moment = F.to_timestamp(F.col("TransactionDate")).alias("_moment")  # a watermark needs a time with a zone
    unique = dated.select("*", moment).withWatermark("_moment", delay).dropDuplicatesWithinWatermark(["TransactionID"])
    return unique.drop("_moment")


def store_late(transactions: DataFrame, delay: str, path: str, checkpoint: str) -> StreamingQuery:
    """Store every row with an id that a watermark of ``delay`` may have passed, or that has no date.

    The newest date of each batch is stored, too. A row is taken if its date is not after the newest date up to its own
    batch, less the delay. That holds for each row the dedup has dropped, wherever its batches begin and end, as both
    read the files in the same order. A batch that is repeated replaces its own rows.
    """

    def decide(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        named = batch.filter(F.col("TransactionID").isNotNull())
        newest = batch.agg(F.max("TransactionDate").alias("newest"))
        newest.write.mode("overwrite").parquet(f"{path}/newest/batch={number}")
        so_far = spark.read.parquet(f"{path}/newest").filter(F.col("batch") <= number).agg(F.max("newest")).first()[0]
        limit = F.lit(so_far) - F.expr(f"INTERVAL {delay}")
        late = named.filter(F.col("TransactionDate").isNull() | (F.col("TransactionDate") <= limit))
        late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")

    stream = transactions.writeStream.foreachBatch(decide).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def one_per_id(rows: DataFrame) -> DataFrame:
    """The row of each id that comes first by date, then by the other columns; reduced on the map side."""
    order = ["TransactionDate", *[c for c in rows.columns if c not in ("TransactionID", "TransactionDate")]]
    first = F.min(F.struct(F.col("TransactionDate").isNull().alias("_undated"), *[F.col(f"`{c}`") for c in order])).alias("_row")
    found = rows.groupBy("TransactionID").agg(first).select("TransactionID", "_row.*")
    return found.select(*[f"`{c}`" for c in rows.columns])


def settled(unique: DataFrame, late: DataFrame) -> DataFrame:
    """One row for each id of the stream: of those stored, and of the late rows whose id is not among them.

    An id that came again after it was forgotten is stored twice; its earliest row stays.
    """
    missing = late.select(unique.columns).join(unique.select("TransactionID"), "TransactionID", "left_anti")
    return one_per_id(unique).unionByName(one_per_id(missing))


@dataclass
class ExpiringDedup:
    """What a run has left behind. ``progress`` is that of its last batches, newest last."""

    unique: DataFrame
    late: DataFrame
    progress: list

    def rows(self) -> DataFrame:
        return settled(self.unique, self.late)

    def ids_held(self) -> list[int]:
        """Ids in the state after each batch."""
        return [p.stateOperators[0].numRowsTotal for p in self.progress if p.stateOperators]

    def late_rows(self) -> int:
        """Rows that came too late for the stream itself."""
        return sum(p.stateOperators[0].numRowsDroppedByWatermark for p in self.progress if p.stateOperators)


def run_expiring_dedup(transactions: DataFrame, delay: str, path: str, checkpoint: str) -> ExpiringDedup:
    """Deduplicate what is there with state that expires, and store what may have come too late; then stop.

    Started again on the same paths, it goes on where it ended. ``ExpiringDedup.rows`` joins the two results.
    """
    spark = transactions.sparkSession
    stream = expiring_dedup_stream(transactions, delay)
    query = write_available(stream, f"{path}/unique", f"{checkpoint}/unique")
    query.awaitTermination()
    store_late(transactions, delay, f"{path}/sorted-out", f"{checkpoint}/late").awaitTermination()
    unique = spark.read.schema(stream.schema).parquet(f"{path}/unique")
    late = spark.read.schema(transactions.schema).parquet(f"{path}/sorted-out/late")
    return ExpiringDedup(unique, late, list(query.recentProgress))


def silver_stream(transactions: DataFrame) -> DataFrame:
    """The first valid copy of each transaction, with Silver features.

    Copies that break a rule are dropped before they can take an id.
    """
    return derive_features(dedup_stream(apply_rules(transactions)))


def score_stream(transactions: DataFrame, model: PipelineModel) -> DataFrame:
    """One decision for each transaction that has a valid copy."""
    return score(silver_stream(transactions), model)


def read_payloads(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """JSON payloads as they arrive: an id and the fields of the scoring contract, all as text."""
    reader = spark.readStream.schema(PAYLOAD_SCHEMA)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(path)


def score_payload_stream(
    payloads: DataFrame, model: PipelineModel, scored: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Decide on good payloads and store the others with their reasons.

    Each batch goes to one folder per sink that is named by the batch, so a batch that is repeated after a
    failure replaces its own rows.
    """

    def decide(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read once; what an executor takes with it is read again
        good, bad = split_by_contract(batch, PAYLOAD_FIELDS)
        score(from_payload(good), model).write.mode("overwrite").parquet(f"{scored}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        batch.unpersist()

    stream = payloads.writeStream.foreachBatch(decide).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop. Files are written exactly once across restarts from ``checkpoint``."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_available(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run ``write_available`` to its end and read the result table."""
    write_available(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
