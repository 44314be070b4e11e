"""Risk model: features, label, exact stratified split, balanced forest, metrics.

The label is computed from four of the features, so near-perfect metrics are expected and say nothing
about real fraud. ``without_label_flags`` leaves those four out of the model's inputs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmill.functions import rules
from riskmill.operators.metrics import area_under_roc, evaluate
from riskmill.operators.split import stratified_split
from riskmill.schemas import FEATURES, LABEL_FLAGS
from riskmill.sources.workspace import stage

# Parameters of the model.
NUM_TREES = 100
MAX_DEPTH = 15
MIN_ROWS_PER_LEAF = 4
SEED = 42
TEST_SHARE = 0.2


def features(silver: DataFrame) -> DataFrame:
    """The row's id and the 16 model inputs."""
    return silver.select("TransactionID", *FEATURES)


def labelled(silver: DataFrame) -> DataFrame:
    """Id, inputs and the label; inputs as doubles, so that a mean can replace a NULL."""
    inputs = [F.col(c).cast("double").alias(c) for c in FEATURES]
    return silver.select("TransactionID", *inputs, rules.fraud_label().alias("fraud_label"))


def label_distribution(silver: DataFrame) -> DataFrame:
    """fraud_label, n, share; the share of label 1 is the fraud rate."""
    counts = silver.groupBy(rules.fraud_label().alias("fraud_label")).agg(F.count("*").alias("n"))
    everything = Window.partitionBy()  # two rows
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(everything), 6))


def class_weights(df: DataFrame, label: str = "fraud_label") -> DataFrame:
    """fraud_label, weight: rows / (classes * rows of the class). One row per label."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    everything = Window.partitionBy()  # two rows
    weight = F.sum("_n").over(everything) / (F.count("*").over(everything) * F.col("_n"))
    return counts.select(label, weight.alias("weight"))


def require_positives(df: DataFrame, label: str = "fraud_label") -> None:
    """Error when no row has label 1; stops at the first one found."""
    if df.filter(F.col(label) == 1).isEmpty():
        raise ValueError("no positive label: check the four risk flags in Silver")


def build_pipeline(inputs: list[str], num_trees: int, max_depth: int, seed: int) -> Pipeline:
    filled = [f"{c}_filled" for c in inputs]
    return Pipeline(
        stages=[
            Imputer(strategy="mean", inputCols=inputs, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features"),
            RandomForestClassifier(
                labelCol="fraud_label",
                weightCol="weight",
                numTrees=num_trees,
                maxDepth=max_depth,
                minInstancesPerNode=MIN_ROWS_PER_LEAF,
                seed=seed,
                # Deep trees: remember each row's node instead of walking down from the root per level.
                cacheNodeIds=True,
                checkpointInterval=10,
            ),
        ]
    )


@dataclass
class TrainingResult:
    path: str
    model: PipelineModel
    metrics: DataFrame  # metric, value
    inputs: list[str]


def predict(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``prediction`` (int) and ``probability`` of the positive class."""
    return (
        model.transform(df)
        .withColumn("prediction", F.col("prediction").cast("int"))
        .withColumn("probability", vector_to_array("probability")[1])
        .drop("features", "rawPrediction", *[c for c in model.stages[0].getOutputCols()])
    )


def metrics_of(predicted: DataFrame) -> DataFrame:
    """metric, value for the train and test parts of (part, fraud_label, prediction, probability).

    Rows with equal outcome are merged first; accuracy, cells and ranking metric are computed from that
    one staged table, so the model is applied once.
    """
    outcomes = stage(
        predicted.groupBy("part", "fraud_label", "prediction", "probability").agg(F.count("*").alias("n")),
        "outcomes",
    )
    test = outcomes.filter(F.col("part") == "test")
    train = outcomes.filter(F.col("part") == "train")
    n = F.col("n")
    # The long form goes through doubles: every metric is one.
    as_rows = lambda df, prefix, names: df.select(
        *[F.col(c).cast("double").alias(prefix + c) for c in names]
    ).unpivot([], [prefix + c for c in names], "metric", "value")
    parts = [
        as_rows(evaluate(train, "fraud_label", "prediction", n), "train_", ["accuracy"]),
        as_rows(
            evaluate(test, "fraud_label", "prediction", n),
            "test_",
            ["accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp"],
        ),
        as_rows(area_under_roc(test, "fraud_label", "probability", n), "test_", ["auc"]),
        as_rows(
            outcomes.agg(
                F.sum("n").alias("total_samples"),
                F.try_divide(F.sum(F.col("fraud_label") * n), F.sum("n")).alias("fraud_rate"),
            ),
            "",
            ["total_samples", "fraud_rate"],
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def train(
    silver: DataFrame,
    path: str,
    without_label_flags: bool = False,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
) -> TrainingResult:
    """Fit the forest, store it under ``path`` and evaluate it as stored.

    Rows never reach the driver; only the trees and metrics do. ``silver`` should be a stored table: its
    model columns are read several times. A model just fitted carries its training summary, and with it
    the session, into every task; the stored one does not.
    """
    inputs = [c for c in FEATURES if not (without_label_flags and c in LABEL_FLAGS)]
    rows = labelled(silver)
    require_positives(rows)
    # Stored once: fitting reads it for means, weights, split points and the trees.
    parts = stage(stratified_split(rows, "TransactionID", "fraud_label", TEST_SHARE), "training")
    train_rows = parts.filter(F.col("part") == "train")
    weights = class_weights(train_rows)  # two rows
    weighted = train_rows.join(F.broadcast(weights), "fraud_label")
    build_pipeline(inputs, num_trees, max_depth, seed).fit(weighted).write().save(path)
    model = PipelineModel.load(path)
    return TrainingResult(path, model, metrics_of(predict(parts, model)), inputs)


def forest(model: PipelineModel) -> RandomForestClassificationModel:
    return model.stages[-1]


def feature_importance(spark: SparkSession, model: PipelineModel, k: int = 10) -> DataFrame:
    """The k most important inputs, most important first; ``importance`` adds up to 1 over all inputs."""
    names = [c.removesuffix("_filled") for c in model.stages[1].getInputCols()]
    values = forest(model).featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def _checks(model: PipelineModel) -> list[tuple[str, str, bool]]:
    last = forest(model)
    if not isinstance(last, RandomForestClassificationModel):
        return [("model_type", type(last).__name__, False)]
    n_inputs = len(model.stages[1].getInputCols())
    return [
        ("model_type", type(last).__name__, isinstance(last, RandomForestClassificationModel)),
        ("n_features", str(last.numFeatures), last.numFeatures == n_inputs),
        ("n_classes", str(last.numClasses), last.numClasses == 2),
        ("n_trees", str(last.getNumTrees), last.getNumTrees > 0),
    ]


def check_model(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """check, found, ok: is the loaded pipeline a forest with the expected inputs and two classes?"""
    return spark.createDataFrame(_checks(model), "check string, found string, ok boolean")


def failed_checks(model: PipelineModel) -> list[str]:
    """Names of the checks that the model fails."""
    return [name for name, _, ok in _checks(model) if not ok]
