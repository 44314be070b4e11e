"""Model registry: a table with one row per stored model. The latest model is the newest row."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a model record.
ENTRY = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("trained_at", T.TimestampType(), False),
        T.StructField("stamp", T.StringType(), False),
        T.StructField("model_type", T.StringType(), False),
        T.StructField("n_features", T.IntegerType(), False),
        T.StructField("features", T.ArrayType(T.StringType()), False),
        T.StructField("test_accuracy", T.DoubleType()),
        T.StructField("test_auc", T.DoubleType()),
        T.StructField("fraud_rate", T.DoubleType()),
        T.StructField("total_samples", T.LongType()),
    ]
)


class ModelRegistry:
    """Models and their registry table below one root folder.

    An entry is added after its model is stored and evaluated, so it always points to a complete model,
    and paths are full ones, so any job that reaches the folder can load it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _table(self) -> str:
        return f"{self.root}/registry"

    def new_path(self) -> str:
        """Where the next model goes: named by the time, and unique."""
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        return f"{self.root}/riskmill_model_{stamp}_{uuid.uuid4().hex[:6]}"

    def register(
        self, path: str, model: PipelineModel, features: list[str], metrics: dict[str, float | None]
    ) -> None:
        """Add the entry of a model stored under ``path``."""
        now = datetime.now(timezone.utc)
        samples = metrics.get("total_samples")
        entry = (
            path,
            now,
            now.strftime("%Y%m%d_%H%M%S"),
            type(model.stages[-1]).__name__,
            len(features),
            features,
            metrics.get("test_accuracy"),
            metrics.get("test_auc"),
            metrics.get("fraud_rate"),
            None if samples is None else int(samples),
        )
        self.spark.createDataFrame([entry], ENTRY).coalesce(1).write.mode("append").parquet(self._table)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(self._table)

    def latest_path(self) -> str:
        try:
            path = self.entries().agg(F.max_by("path", "trained_at")).first()[0]
        except Exception as error:  # noqa: BLE001 - only a missing registry is answered
            if "PATH_NOT_FOUND" not in str(error):
                raise
            path = None
        if path is None:
            raise FileNotFoundError(f"no model in {self.root}")
        return path

    def load_latest(self, check: Callable[[PipelineModel], list[str]] | None = None) -> PipelineModel:
        """The newest model. ``check`` names what is wrong with it, if anything; then it is refused."""
        path = self.latest_path()
        model = PipelineModel.load(path)
        if check is not None and (wrong := check(model)):
            raise ValueError(f"the model in {path} fails {wrong}")
        return model
