"""Shared folder for tables that cut lineage or are read back by other tasks."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_cleared_at_exit: set[str] = set()
_local_folders: dict[str, str] = {}  # application id -> temporary folder, for local sessions only
_open_scratch: list[list[str]] = []  # paths handed out in each open ``scratch``, the innermost last


def configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a fresh temporary folder for its lifetime.
    """
    folder = configured_folder(spark)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="riskmill-")
        context.setCheckpointDir(_local_folders[context.applicationId])
    return _local_folders[context.applicationId]


def application_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/riskmill/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses, removed at the latest when the program ends."""
    application = spark.sparkContext.applicationId
    if application not in _cleared_at_exit:
        _cleared_at_exit.add(application)
        atexit.register(_clear_quietly, spark)
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _open_scratch:
        _open_scratch[-1].append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside. What has to last is written to a path made before."""
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            remove(spark, path)


def clear(spark: SparkSession) -> None:
    """Remove all that this application has staged, and the databases it has published there.

    Results that still read from there can't be read afterwards: call it when they have been.
    """
    folder = application_folder(spark)
    place = urlsplit(folder).path
    for database in spark.catalog.listDatabases():
        if f"{place}/" in (database.locationUri or ""):
            spark.sql(f"DROP DATABASE {database.name} CASCADE")
    remove(spark, folder)


def _clear_quietly(spark: SparkSession) -> None:
    """At the end of the program; a session that was stopped before can't reach its stores any more."""
    with contextlib.suppress(Exception):
        if spark.sparkContext._jsc is not None:
            clear(spark)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results several branches of a plan read: it is computed once, survives lost executors, and the
    readers still prune columns and know the size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_only(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``stage(build(), name)`` without the tables that ``build`` has staged on its way."""
    path = fresh_path(spark, name)
    with scratch(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
