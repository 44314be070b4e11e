"""Keep one row per key, chosen by an order instead of by chance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, newest_first: Sequence[str]) -> DataFrame:
    """The first row of each key when sorted by ``newest_first`` descending, NULLs last.

    ``df`` must have a beginning of the columns of ``newest_first``, besides the key, and no others: then rows
    that tie are equal, and the survivor does not depend on which of the remaining columns were read.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a key with
    a third of all rows sends one row per task and never fills a reducer. NULL keys form one group.
    """
    present = [c for c in newest_first if c in df.columns]
    if present != list(newest_first[: len(present)]) or set(df.columns) - {key, *present}:
        raise ValueError(f"columns {df.columns} are not the key and a beginning of the order {list(newest_first)}")
    window = Window.partitionBy(key).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in present])
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame,
    key: str,
    newest_first: Sequence[str],
    keep: dict[str, Column],
    aggregates: dict[str, Column] | None = None,
) -> DataFrame:
    """Attributes of the newest row per key plus aggregates over all rows of the key, in one shuffle.

    One group-by replaces a window over the whole key followed by a dedup: rows are reduced to one per
    key on the map side, whatever the size of the largest key.
    """
    newest = F.max_by(
        F.struct(*[value.alias(name) for name, value in keep.items()]),
        F.struct(*[F.col(c) for c in newest_first]),
    ).alias("_newest")
    extra = [value.alias(name) for name, value in (aggregates or {}).items()]
    return df.groupBy(key).agg(newest, *extra).select(key, "_newest.*", *(aggregates or {}))
