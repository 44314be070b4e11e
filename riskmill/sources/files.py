"""CSV and Parquet in, day-partitioned Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmill.schemas import TRANSACTION_SCHEMA

CORRUPT = "_corrupt_record"
# Text form of event times in exchanged CSV files, and the exact form used when nothing may be lost.
CSV_TIME = "yyyy-MM-dd HH:mm:ss"
CSV_TIME_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(
    spark: SparkSession, path: str, time_format: str = CSV_TIME, infer: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """Transactions from CSV files with a header line, whose columns are matched by name.

    The declared types are used unless ``infer`` asks for a pass over the data. Columns may come in any order,
    the same in all files: a file whose header differs from the first one's fails the job. A declared column
    that is missing is an error, further columns are left out. A value that does not parse becomes NULL;
    ``keep_corrupt`` adds the raw line of such a row.
    """
    reader = spark.read.option("header", True).option("timestampNTZFormat", time_format).option("enforceSchema", False)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    header = spark.read.option("header", True).csv(path).columns  # reads the first line only
    declared = {field.name: field for field in TRANSACTION_SCHEMA}
    if missing := [name for name in declared if name not in header]:
        raise ValueError(f"{path} lacks the columns {missing}")
    fields = [declared.get(name, T.StructField(name, T.StringType())) for name in header]
    wanted = list(declared)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
        wanted.append(CORRUPT)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.option("mode", "PERMISSIVE").schema(T.StructType(fields)).csv(path)
    return rows.select(*[f"`{name}`" for name in wanted])


def write_csv(df: DataFrame, path: str, time_format: str = CSV_TIME_MICROS) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", time_format).csv(path)


def read_parquet(
    spark: SparkSession, path: str, merge_schema: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet files with partition discovery; ``merge_schema`` joins the schemas of older and newer files."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_by_day(df: DataFrame, path: str, day: str, replace_all: bool = True) -> None:
    """Parquet, one folder per day.

    ``rebalance`` groups rows by day and lets AQE cut a day that is larger than the advisory size into
    several files and join small ones, so neither a busy day nor many quiet ones hurt. With
    ``replace_all=False`` only the days in ``df`` are replaced.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file name and size in bytes; the content column is pruned, so no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return files.load(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")
    )
