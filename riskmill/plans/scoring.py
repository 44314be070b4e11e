"""Scoring: block or allow. Works on a batch and on a stream alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.plans.training import predict
from riskmill.schemas import FEATURES, PAYLOAD_FIELDS


PAYLOAD_SCHEMA = "TransactionID string, " + ", ".join(f"{name} string" for name, _ in PAYLOAD_FIELDS)


def score(silver: DataFrame, model: PipelineModel) -> DataFrame:
    """TransactionID, prediction, probability, action for rows with Silver features."""
    inputs = [F.col(c).cast("double").alias(c) for c in FEATURES]
    scored = predict(silver.select("TransactionID", *inputs), model)
    return scored.select(
        "TransactionID", "prediction", "probability", rules.action(F.col("prediction")).alias("action")
    )


def to_payload(silver: DataFrame) -> DataFrame:
    """Silver rows as text payloads with the external field names."""
    fields = [F.col(c).cast("string").alias(name) for c, (name, _) in zip(FEATURES, PAYLOAD_FIELDS)]
    return silver.select("TransactionID", *fields)


def from_payload(payload: DataFrame) -> DataFrame:
    """Payload fields under their feature names, ready for ``score``."""
    return payload.withColumnsRenamed({name: c for c, (name, _) in zip(FEATURES, PAYLOAD_FIELDS)})
