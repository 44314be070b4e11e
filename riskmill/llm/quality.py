"""Choosing text like a target by importance resampling over hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.llm.common import as_bytes, id_remainder, map_batches, window_hashes
from riskmill.sources.workspace import stage

BITS = 17
TARGET_ROWS = 20_000  # labelled rows that stand for the target, chosen by a hash of the id
RANKED_AT_ONCE = 200_000
SMOOTHING = 1.0


def ngram_buckets(text: bytes) -> np.ndarray:
    """Buckets of all words and word pairs of a text."""
    words = text.split()
    parts = [window_hashes(words, 1)]
    if len(words) > 1:
        parts.append(window_hashes(words, 2))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)


def bucket_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences by bucket in the target (column ``target``) and in all texts.

    A task adds up its texts; Spark sums the tasks. The result has a fixed size, 2**BITS buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2**BITS), np.int64)
        for batch in batches:
            for text, target in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts = np.bincount(ngram_buckets(text), minlength=2**BITS)
                sums[1] += counts
                if target:
                    sums[0] += counts
        seen = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(sums[0][seen]), pa.array(sums[1][seen])], ["bucket", "in_target", "in_all"]
        )

    rows = docs.select("text", "target").mapInArrow(count, "bucket bigint, in_target bigint, in_all bigint")
    summed = rows.groupBy("bucket").agg(F.sum("in_target").alias("in_target"), F.sum("in_all").alias("in_all"))
    table = summed.toArrow()
    counts = np.zeros((2, 2**BITS), np.int64)
    for k, name in enumerate(("in_target", "in_all")):
        counts[k][table["bucket"].to_numpy()] = table[name].to_numpy()
    return counts[0], counts[1]


def log_ratio(target: np.ndarray, everything: np.ndarray) -> np.ndarray:
    """Log of the target's smoothed n-gram model over that of all text, by bucket."""
    models = [np.log(c + SMOOTHING) - np.log(c.sum() + SMOOTHING * len(c)) for c in (target, everything)]
    return models[0] - models[1]


def target_rows(labels: DataFrame, at_most: int) -> tuple[DataFrame, float]:
    """Ids that stand for the target, at most about ``at_most``, and the target's share of the labelled ids.

    An id's label is its largest; the third of ids held out is left out, and so are NULL ids and labels that
    are neither 0 nor 1.
    """
    usable = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(id_remainder("doc_id", 3) != 1)
    usable = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n, good = usable.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    part = int(1_000_000 * min(1.0, at_most / max(1, good)))
    chosen = usable.filter("quality = 1").filter(
        F.pmod(F.xxhash64("doc_id", F.lit("target")), F.lit(1_000_000)) < part
    )
    return chosen.select("doc_id"), good / n if n else 1.0


def log_weights(docs: DataFrame, labels: DataFrame, at_most: int = TARGET_ROWS) -> tuple[DataFrame, float]:
    """doc_id, log_weight, key (log_weight plus Gumbel noise) of every text, and the target's share.

    log_weight is the log of how much likelier the target's model makes the whole text than the model of all
    text. The noise depends on seed, id and text only.
    """
    chosen, share = target_rows(labels, at_most)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    flags = F.broadcast(chosen.withColumn("target", F.lit(True)))  # bounded by at_most
    flagged = docs.join(flags, "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    weights = docs.sparkSession.sparkContext.broadcast(log_ratio(*bucket_counts(flagged)))

    def weigh(batch: pa.RecordBatch) -> dict:
        ratio = weights.value
        sums = [float(ratio[ngram_buckets(text)].sum()) for text in as_bytes(batch.column(1))]
        return {"doc_id": batch.column(0), "log_weight": pa.array(sums, pa.float64()), "noise": batch.column(2)}

    noise = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), "doc_id", "text"), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    rows = docs.withColumn("noise", -F.log(-F.log(noise)))
    weighed = map_batches(rows, weigh, "doc_id bigint, log_weight double, noise double")
    return weighed.select("doc_id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("key")), share


def _threshold(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, without sorting the rows in one place.

    Quantiles close in on it from both sides. Where they can't tell the rows between them apart, the largest value is
    counted and taken off; at most RANKED_AT_ONCE values are sorted.
    """
    value = F.col(column)
    low, high, above, between = float("-inf"), None, 0, rows.count()
    while True:
        part = rows.filter(value >= low) if high is None else rows.filter((value >= low) & (value < high))
        if between <= RANKED_AT_ONCE:
            return part.select(column).orderBy(F.desc(column)).limit(k - above).agg(F.min(column)).first()[0]
        at = 1 - (k - above) / between
        near = part.stat.approxQuantile(column, [max(0.0, at - 0.02), min(1.0, at + 0.02)], 0.01)
        more = part.agg(*[F.count_if(test) for x in near for test in (value >= x, value > x)]).first()
        for x, reached, passed in ((near[0], more[0], more[1]), (near[1], more[2], more[3])):
            if above + passed < k <= above + reached:
                return x
        before = (low, high)
        if above + more[0] >= k:
            low = near[0]
        if above + more[2] < k:
            high, above = near[1], above + more[2]
        if (low, high) == before:
            top = part.agg(F.max(column)).first()[0]
            equal = part.agg(F.count_if(value == top)).first()[0]
            if above + equal >= k:
                return top
            high, above = top, above + equal
        part = rows.filter(value >= low) if high is None else rows.filter((value >= low) & (value < high))
        between = part.count()


def top_rows(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``key``, ties by doc_id, NULL first.

    Rows above the k-th key are taken, and among those with that key the least doc_ids in the same way. Rows with equal
    key and doc_id are copies, as the key follows from id and text: so many of them are taken as are missing.
    """
    if k <= 0:
        return rows.limit(0)
    if k >= rows.count():
        return rows
    chosen, left, number = None, rows, k
    first_ids = F.coalesce(-F.col("doc_id").cast("double"), F.lit(float("inf")))
    for column, value in (("key", F.col("key")), ("_id", first_ids)):
        left = left.withColumn(column, value)
        limit = _threshold(left, column, number)
        sure = left.filter(F.col(column) > limit)
        number -= sure.count()
        left = left.filter(F.col(column) == limit)
        chosen = sure if chosen is None else chosen.unionByName(sure.select(rows.columns))
    return chosen.unionByName(left.select(rows.columns).limit(number)).select(rows.columns)


def resample(docs: DataFrame, labels: DataFrame, at_most: int = TARGET_ROWS) -> DataFrame:
    """doc_id, log_weight, key, kept (true) of the documents chosen.

    As many are chosen as the target's share of the labelled ids makes of all documents: those with the largest
    log importance weight plus Gumbel noise, which is sampling without replacement by weight. Every text is
    weighed over its whole length.

    NULL and empty texts have log weight 0; NULL ids are allowed; repeated rows are chosen each; other columns are
    ignored; without labels everything is chosen; an empty table gives no rows.
    """
    weighed, share = log_weights(docs, labels, at_most)
    weighed = stage(weighed, "importance")
    return top_rows(weighed, round(share * weighed.count())).withColumn("kept", F.lit(True))
