"""Data quality reports on Bronze rows. The rules are those Silver filters by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmill.functions.features import FEATURE_SOURCES
from riskmill.functions.rules import quality_rules


def _checked_survivors(bronze: DataFrame, newest_first: Sequence[str]) -> DataFrame:
    """One row per TransactionID: the newest row's rule results and how many rows shared the id.

    Rows are reduced to one small struct per id before the shuffle.
    """
    rules = quality_rules()
    checks = F.struct(*[check.alias(name) for name, check in rules.items()])
    order = F.struct(*[F.col(f"`{c}`") for c in newest_first if c in bronze.columns])
    return bronze.groupBy("TransactionID").agg(
        F.max_by(checks, order).alias("checks"), F.count("*").alias("copies")
    )


def _passes_all() -> Column:
    passed = F.lit(True)
    for name in quality_rules():
        passed = passed & F.col(f"checks.{name}")
    return passed


def quality_report(bronze: DataFrame, newest_first: Sequence[str]) -> DataFrame:
    """Rows before and after cleaning, and derived columns, in one pass; an empty layer gives a NULL percentage.

    ``newest_first`` is the order that chooses Silver's survivors; it must begin with what the rules read.
    """
    counted = _checked_survivors(bronze, newest_first).agg(
        F.coalesce(F.sum("copies"), F.lit(0).cast("long")).alias("initial_rows"),
        F.count_if(_passes_all()).alias("final_rows"),
    )
    removed = F.col("initial_rows") - F.col("final_rows")
    return counted.withColumns(
        {
            "removed": removed,
            "removed_pct": F.round(F.try_divide(100 * removed, F.col("initial_rows")), 4),
            "new_features": F.lit(len(FEATURE_SOURCES)),
        }
    )


def quality_by_rule(bronze: DataFrame, newest_first: Sequence[str]) -> DataFrame:
    """How many deduplicated rows fail each rule, each rule on its own."""
    rules = list(quality_rules())
    failed = _checked_survivors(bronze, newest_first).agg(
        *[F.count_if(~F.col(f"checks.{name}")).alias(name) for name in rules]
    )
    return failed.unpivot([], rules, "rule", "n_failed")


def reject_reasons(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Add ``reasons``: why a row of text fields breaks the typed contract; empty for a good row.

    ``fields`` are (name, type) pairs. A field is missing when NULL and malformed when it does not cast.
    """
    found = [
        F.when(F.col(name).isNull(), F.lit(f"missing:{name}")).when(
            F.col(name).try_cast(data_type).isNull(), F.lit(f"malformed:{name}")
        )
        for name, data_type in fields
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*found)))


def split_by_contract(df: DataFrame, fields: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, rejected rows with their reasons)."""
    checked = reject_reasons(df, fields)
    good = checked.filter(F.size("reasons") == 0).drop("reasons")
    good = good.withColumns({name: F.col(name).cast(data_type) for name, data_type in fields})
    return good, checked.filter(F.size("reasons") > 0)


def count_rejects(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Number of rows per reject reason; a row with several reasons counts once for each."""
    return (
        reject_reasons(df, fields)
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )
