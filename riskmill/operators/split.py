"""Train/test splits that depend only on the row's id: the same on any partitioning and after a retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 4  # hexadecimal digits of the hash that a round adds: 65,536 counts per label
MOST_LABELS = 1_000


def hash_part(row_id: Column, test_percent: int = 20) -> Column:
    """'test' or 'train' from the id alone; shares are close to, not exactly, the wanted ones.

    Needs no pass over the data, so it also works on a stream.
    """
    bucket = F.conv(F.substring(F.md5(row_id), 1, 8), 16, 10).cast("long") % 100
    return F.when(bucket < test_percent, "test").otherwise("train")


def test_cutoffs(df: DataFrame, row_id: str, label: str, test_share: float) -> DataFrame:
    """The beginning of the largest id hash that belongs to the test part, one row per label (``_label``, ``_cutoff``).

    Exact by counts alone: counts per beginning of the hash find the one in which the wanted share is reached, and the
    next round counts only rows with that beginning, by four digits more. It ends when one hash is left for each label;
    a round leaves one row in 65,536. No row is ranked or sorted. More than 1,000 labels are an error.
    """
    spark = df.sparkSession
    kind = df.schema[label].dataType
    schema = T.StructType([T.StructField("_label", kind), T.StructField("_start", T.StringType()), T.StructField("_wanted", T.LongType())])
    hashed = df.select(F.col(label).alias("_label"), F.md5(row_id).alias("_hash")).filter("_label IS NOT NULL AND _hash IS NOT NULL")
    by_label = Window.partitionBy("_label")  # at most 65,536 counts
    found: dict = {}
    for digits in range(DIGITS, 33, DIGITS):
        start = F.substring("_hash", 1, digits).alias("_start")
        if digits == DIGITS:
            counts = hashed.groupBy("_label", start).agg(F.count("*").alias("_n"))
            counts = counts.withColumn("_wanted", F.round(F.sum("_n").over(by_label) * test_share).cast("long"))
        else:
            again = spark.createDataFrame([(k, *v[:2]) for k, v in found.items() if v[2] > 1], schema)
            rows = hashed.withColumn("_before", F.substring("_hash", 1, digits - DIGITS))
            rows = rows.join(F.broadcast(again.withColumnRenamed("_start", "_before")), ["_label", "_before"])
            counts = rows.groupBy("_label", start, "_wanted").agg(F.count("*").alias("_n"))
        earlier = F.sum("_n").over(by_label.orderBy("_start")) - F.col("_n")
        counts = counts.withColumn("_wanted", F.col("_wanted") - earlier)
        reached = counts.filter("_wanted >= 1 AND _wanted <= _n").select("_label", "_start", "_wanted", "_n")
        for row in reached.limit(MOST_LABELS + 1).collect():
            found[row["_label"]] = (row["_start"], row["_wanted"], row["_n"])
        if len(found) > MOST_LABELS:
            raise ValueError(f"{label} takes more than {MOST_LABELS} values")
        if all(n == 1 for *_, n in found.values()):
            break
    return spark.createDataFrame([(k, v[0]) for k, v in found.items()], T.StructType(schema.fields[:2])).withColumnRenamed("_start", "_cutoff")


def stratified_split(
    df: DataFrame, row_id: str, label: str, test_share: float = 0.2, output: str = "part"
) -> DataFrame:
    """Add 'train' or 'test' so that every label has exactly its rounded share of test rows.

    ``label`` must take few values (here 0 and 1): the cutoffs, one row per label and checked to be few, are
    broadcast. ``df`` should be a stored table; it is read a few times, all but the last for id and label only. Rows
    without label or id are for training.
    """
    cutoffs = test_cutoffs(df, row_id, label, test_share)
    own = F.md5(row_id).substr(F.lit(1), F.length("_cutoff"))
    return (
        df.join(F.broadcast(cutoffs), F.col(label) == F.col("_label"), "left")
        .withColumn(output, F.when(own <= F.col("_cutoff"), "test").otherwise("train"))
        .drop("_label", "_cutoff")
    )
