"""Session factory. Every library function also works on a session made elsewhere."""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Start with many small shuffle partitions: AQE merges them up to the advisory size, so the same
# setting serves a day of data and the whole history.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Ids remembered by the streaming dedup live on local disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "riskmill",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    table_catalog: dict[str, str] | None = None,
) -> SparkSession:
    """Make or get the session.

    ``master`` is left to spark-submit when None. ``table_catalog`` holds the settings of an external
    table catalog (for example ``{"spark.sql.catalog.lake": "...", "spark.sql.catalog.lake.type": "hive"}``)
    and is passed on unchanged, so a table format whose jar is on the class path needs no code here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if master is None or not master.startswith("local"):
        settings.update(CLUSTER_CONF)
    settings.update(table_catalog or {})
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
