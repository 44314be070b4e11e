"""Gold tables in the session catalog, and checks on published layers."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmill.sources.workspace import remove

REPORT = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("exists", T.BooleanType()),
    ]
)


_VERSION = "__v"  # between a table's name and its version
KEPT_VERSIONS = 3


def publish_table(
    df: DataFrame,
    database: str,
    table: str,
    path: str,
    table_format: str = "parquet",
    bucket_by: tuple[int, str] | None = None,
    keep: int = KEPT_VERSIONS,
) -> int:
    """Publish ``df`` as the newest version of a table stored below ``path``; gives the number of rows written.

    Every version is a table of its own, and ``database.table`` is a view of the newest. A view is replaced at once,
    so there is no moment without the table, and a job that fails leaves the old version in place. The newest ``keep``
    versions stay: readers of a replaced one can end, ``read_as_of`` finds them and ``roll_back`` returns to them.

    Rows are counted by an observation directly below the write, so nothing runs twice. With
    ``bucket_by`` the table is hashed into that many files; tables bucketed alike join without a shuffle.
    """
    spark = df.sparkSession
    before = versions(spark, database, table)
    stamp = max(time.time_ns() // 1_000_000, _stamp(before[-1]) + 1 if before else 0)
    new = f"{table}{_VERSION}{stamp:015d}"
    count = Observation()
    if bucket_by is not None:
        df = df.repartition(*bucket_by)
    writer = df.observe(count, F.count(F.lit(1)).alias("rows")).write.format(table_format).mode("overwrite")
    if bucket_by is not None:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    try:
        writer.option("path", f"{path}/version={stamp}").saveAsTable(f"{database}.{new}")
    except Exception:
        remove(spark, f"{path}/version={stamp}")
        raise
    _point(spark, database, table, new)
    for old in [*before, new][: -max(1, keep)]:
        _drop_version(spark, database, old)
    return count.get["rows"]


def publish_folder(spark: SparkSession, database: str, table: str, path: str, partition: str) -> None:
    """Show a folder of Parquet files, partitioned and replaced day by day, as ``database.table`` without its partition
    column. The view names the folder, so each query lists the days that are there."""
    columns = ", ".join(f"`{c}`" for c in spark.read.parquet(path).columns if c != partition)
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {columns} FROM parquet.`{path}`")


def versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Names of the versions of a table, the oldest first."""
    if not spark.catalog.databaseExists(database):
        return []
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{table.lower()}{_VERSION}*'").collect()]
    return sorted(n for n in names if n[len(table) + len(_VERSION) :].isdigit())


def _stamp(version: str) -> int:
    """Milliseconds since 1970 at which a version was begun."""
    return int(version.rsplit(_VERSION, 1)[1])


def _point(spark: SparkSession, database: str, table: str, version: str) -> None:
    if _location(spark, f"{database}.{table}") is not None:  # published before there were versions
        spark.sql(f"DROP TABLE {database}.{table}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT * FROM {database}.{version}")


def _drop_version(spark: SparkSession, database: str, version: str) -> None:
    folder = _location(spark, f"{database}.{version}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{version}")
    if folder is not None:
        remove(spark, folder)


def version_list(spark: SparkSession, database: str, table: str) -> DataFrame:
    """version, published_at, current: the versions that are kept; the view shows the current one."""
    shown = _shown(spark, database, table)
    rows = [(v, _stamp(v), v == shown) for v in versions(spark, database, table)]
    listed = spark.createDataFrame(rows, "version string, stamp long, current boolean")
    return listed.select("version", F.timestamp_millis("stamp").alias("published_at"), "current")


def _shown(spark: SparkSession, database: str, table: str) -> str | None:
    """The version that a table's view shows."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    text = spark.sql(f"DESCRIBE EXTENDED {database}.{table}").filter("col_name = 'View Text'").first()
    return text["data_type"].rsplit(".", 1)[1].strip("`") if text else None


def read_as_of(spark: SparkSession, database: str, table: str, moment: datetime) -> DataFrame:
    """The newest version that was begun by ``moment``; without a zone it is local time, as collected times are."""
    until = int(moment.timestamp() * 1000)
    found = [v for v in versions(spark, database, table) if _stamp(v) <= until]
    if not found:
        raise LookupError(f"no version of {database}.{table} is kept from {moment} or before")
    return spark.table(f"{database}.{found[-1]}")


def roll_back(spark: SparkSession, database: str, table: str, steps: int = 1) -> str:
    """Show the version ``steps`` before the current one again; the versions after it are dropped. Gives its name."""
    kept = versions(spark, database, table)
    place = kept.index(_shown(spark, database, table)) - steps
    if place < 0:
        raise LookupError(f"{database}.{table} has no version {steps} before the current one")
    _point(spark, database, table, kept[place])
    for later in kept[place + 1 :]:
        _drop_version(spark, database, later)
    return kept[place]


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder of a table, None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()
    return described["data_type"] if described else None


def publish_all(
    spark: SparkSession,
    tables: dict[str, Callable[[], DataFrame]],
    database: str,
    root: str,
    table_format: str = "parquet",
    buckets: dict[str, tuple[int, str]] | None = None,
    parallel: int = 6,
) -> dict[str, int]:
    """Publish several tables, a few at a time so that small ones do not leave the cluster idle."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")

    def publish(name: str) -> int:
        bucket_by = (buckets or {}).get(name)
        return publish_table(tables[name](), database, name, f"{root}/{name}", table_format, bucket_by)

    with ThreadPoolExecutor(parallel) as pool:
        rows = pool.map(inheritable_thread_target(spark)(publish), tables)
        return dict(zip(tables, rows))


def check_tables(spark: SparkSession, database: str, tables: Sequence[str]) -> DataFrame:
    """table, rows, exists for each expected table; rows are counted from file footers."""

    def check(name: str) -> DataFrame:
        if not spark.catalog.tableExists(f"{database}.{name}"):
            return spark.createDataFrame([(name, None, False)], REPORT)
        counted = spark.table(f"{database}.{name}").agg(F.count("*").alias("rows"))
        return counted.select(F.lit(name).alias("table"), "rows", F.lit(True).alias("exists"))

    return reduce(DataFrame.unionByName, map(check, tables))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables known to the catalog, without their versions; an unreachable catalog raises."""
    if database not in [d.name for d in spark.catalog.listDatabases()]:
        raise LookupError(f"no database {database}")
    listed = spark.sql(f"SHOW TABLES IN {database}").filter(~F.col("isTemporary"))
    return listed.filter(~F.col("tableName").rlike(f"{_VERSION}[0-9]+$")).select(F.col("tableName").alias("table"))


def check_layers(spark: SparkSession, layers: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """layer, rows, columns_missing for each ``{name: (path, expected columns)}``.

    A layer without files or without rows reports 0 rows, one that does not exist reports NULL.
    """

    def check(name: str) -> DataFrame:
        path, expected = layers[name]
        try:
            found = spark.read.parquet(path)
        except Exception as error:  # noqa: BLE001 - only a missing path is answered, see below
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            return spark.createDataFrame([(name, None, len(expected))], "layer string, rows long, columns_missing int")
        missing = len(set(expected) - set(found.columns))
        counted = found.agg(F.count("*").alias("rows"))
        return counted.select(F.lit(name).alias("layer"), "rows", F.lit(missing).alias("columns_missing"))

    return reduce(DataFrame.unionByName, map(check, layers))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself; an error when it has no rows. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
