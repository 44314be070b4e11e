"""Per-key operators that keep every row, safe for keys that hold a large share of the data."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmill.sources.workspace import stage

HOT_ROWS = 1_000_000  # a key with more rows than that is spread over ranges
TRACKED = 4_096  # keys that the sketch tells: all with more than 1/3,072 of the rows, and no others matter


def frequent_keys(df: DataFrame, key: str, least: int = HOT_ROWS, tracked: int = TRACKED) -> list:
    """Keys with more than ``least`` rows, if they hold a share of all rows worth spreading; ``tracked`` at most.

    A frequent-items sketch: one pass over the key's column, merged from map tasks, without a shuffle of keys. What it
    misses or adds changes the speed of what uses it, never a result.
    """
    top = df.filter(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {tracked}, {tracked})").alias("top")).first()["top"]
    return [x["item"] for x in top or [] if x["count"] > least]


def with_previous_time(
    df: DataFrame, key: str, time: str, tie: str, output: str, hot_rows: int = HOT_ROWS, tracked: int = TRACKED
) -> DataFrame:
    """Add the time of the key's preceding row: ``lag(time)`` ordered by time and tie, NULL times first.

    A row without key or time has no preceding row; such rows are spread by their tie. The rows move once. Those of most
    keys go through a window over their key. Those of a key with more than ``hot_rows`` rows go through ranges of
    (key, time, tie), however many share a minute or an instant, and each range gets one row carried from the one
    before it. Rows that share key, time and tie follow each other in no particular order.
    """
    named = F.col(key).isNotNull() & F.col(time).isNotNull()
    hot = frequent_keys(df, key, hot_rows, tracked)
    in_ranges = named & F.col(key).isin(hot) if hot else F.lit(False)
    spread = F.when(~named, F.xxhash64(tie))
    window = Window.partitionBy(key, spread).orderBy(time, tie)
    rest = df.filter(~F.coalesce(in_ranges, F.lit(False))) if hot else df
    rest = rest.withColumn(output, F.when(named, F.lag(time).over(window)))
    return rest.unionByName(_previous_in_ranges(df.filter(in_ranges), key, time, tie, output)) if hot else rest


def _previous_in_ranges(df: DataFrame, key: str, time: str, tie: str, output: str) -> DataFrame:
    """The look-back as an ordered scan of sorted ranges. Only the first row of a range may look back into another:
    to the last row of the nearest range before it that has rows."""
    ordered = df.repartitionByRange(key, time, tie).sortWithinPartitions(key, time, tie)
    ordered = ordered.withColumn(output, F.col(time)).withColumn("_range", F.spark_partition_id())
    ordered = ordered.withColumn("_first", F.lit(False))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key and time of the row before the batch
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, times = batch.column(key), batch.column(time)
            before = last or (keys.slice(0, 1), times.slice(0, 1))
            earlier_keys = pa.concat_arrays([before[0], keys.slice(0, batch.num_rows - 1)])
            earlier_times = pa.concat_arrays([before[1], times.slice(0, batch.num_rows - 1)])
            first = pa.array([last is None] + [False] * (batch.num_rows - 1))
            same = pc.and_(pc.equal(keys, earlier_keys), pc.invert(first))
            previous = pc.if_else(same, earlier_times, pa.scalar(None, times.type))
            last = (keys.slice(batch.num_rows - 1), times.slice(batch.num_rows - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], previous, batch.column("_range"), first], batch.schema.names)

    scanned = stage(ordered.mapInArrow(scan, ordered.schema), "look-back")
    ends = scanned.groupBy("_range").agg(F.max(F.struct(key, time)).alias("_end"))
    by_range = Window.orderBy("_range")  # one row per range
    carried = ends.select(F.col("_range").alias("_into"), F.lag("_end").over(by_range).alias("_carried"))
    joined = scanned.join(F.broadcast(carried), F.col("_range") == F.col("_into"))
    into = F.col("_first") & (F.col(key) == F.col(f"_carried.{key}"))
    joined = joined.withColumn(output, F.when(into, F.col(f"_carried.{time}")).otherwise(F.col(output)))
    return joined.drop("_range", "_first", "_into", "_carried")


def with_key_maximum(df: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Add the maximum of ``value`` over all rows of the same key, to every row.

    A window over the key would put each key's rows into one task. Here the maxima come from a group-by
    that reduces on the map side, and are joined back from a stored table: Spark knows its size, so it
    broadcasts a small one, and otherwise joins two plain shuffles, whose oversized partitions AQE splits.
    ``df`` should be a stored table; it is read twice.
    """
    largest = df.groupBy(F.col(key).alias("_key")).agg(F.max(value).alias(output))
    return df.join(stage(largest, "key-maximum"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
