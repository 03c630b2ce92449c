"""Classifiers behind one scoring contract.

A fitted classifier adds ``actual`` (if the label is there), ``labels``, ``shares``
(aligned with the labels, summing to 1), ``predicted`` and ``confidence``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.metrics import argmax_label
from tidewatch.plans import softmax_trees
from tidewatch.plans.profiles import SEED, BoostedParams, ForestParams, SequenceParams
from tidewatch.plans.recurrent import Recurrent, fit_epochs
from tidewatch.plans.softmax_trees import Growth, SoftmaxTrees, feature_array
from tidewatch.schemas import TARGET_COLUMN


def ordered_labels(df: DataFrame, target: str = TARGET_COLUMN) -> list[str]:
    """Distinct labels in alphabetical order. A model keeps one entry per label."""
    labels = df.select(F.col(target).cast("string").alias("label")).distinct()
    return sorted(row.label for row in labels.collect())


@dataclass(frozen=True)
class Inputs:
    """How rows become model inputs: feature order and label order."""

    features: list[str]
    labels: list[str]
    target: str = TARGET_COLUMN

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the feature vector and, where the target exists, the label index."""
        assembler = VectorAssembler(
            inputCols=self.features, outputCol="features", handleInvalid="error"
        )
        return self.index(assembler.transform(df))

    def index(self, df: DataFrame) -> DataFrame:
        if self.target not in df.columns:
            return df
        indexer = StringIndexerModel.from_labels(
            self.labels, inputCol=self.target, outputCol="label_index"
        )
        return indexer.transform(df)


def _contract(df: DataFrame, inputs: Inputs, shares: Column) -> DataFrame:
    with_shares = df.withColumns(
        {"labels": F.array(*[F.lit(label) for label in inputs.labels]), "shares": shares}
    )
    predicted, confidence = argmax_label(F.col("shares"), F.col("labels"))
    scored = with_shares.withColumns({"predicted": predicted, "confidence": confidence})
    if inputs.target in df.columns:
        scored = scored.withColumn("actual", F.col(inputs.target))
    return scored


@dataclass(frozen=True)
class Fitted:
    """A fitted model with its inputs; ``score`` uses the model's own features."""

    kind: str
    model: object
    inputs: Inputs

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the model with what scoring needs: kind, feature and label order."""
        head = json.dumps({"kind": self.kind, **asdict(self.inputs)})
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/inputs")
        self.model.save(spark, f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        """A stored model that scores as the fitted one did."""
        head = json.loads(spark.read.text(f"{path}/inputs").first()[0])
        kind = head.pop("kind")
        return Fitted(kind, MODELS[kind].load(spark, f"{path}/model"), Inputs(**head))

    def score(self, df: DataFrame) -> DataFrame:
        prepared = df if "features" in df.columns else self.inputs.prepare(df)
        return _contract(prepared, self.inputs, self.model.shares(feature_array(prepared)))


MODELS = {"boosted": SoftmaxTrees, "forest": SoftmaxTrees, "sequence": Recurrent}


def fit_trees(train: DataFrame, inputs: Inputs, params: BoostedParams | ForestParams) -> Fitted:
    """``train`` carries ``features``, ``label_index``, ``class_weight`` and ``row_key``."""
    boosted = isinstance(params, BoostedParams)
    growth = Growth(
        trees=params.trees,
        max_depth=params.max_depth,
        learning_rate=params.learning_rate,
        subsample=params.subsample,
        feature_share=params.feature_share,
        l2=params.l2,
        bins=params.bins,
        leaves=None if boosted else params.leaves,
        seed=SEED,
    )
    rows = train.select(
        feature_array(train).alias("x"), F.col("label_index").alias("y"),
        F.col("class_weight").alias("weight"), F.col("row_key").alias("key"),
    )
    model = softmax_trees.fit(rows, len(inputs.features), len(inputs.labels), growth)
    return Fitted("boosted" if boosted else "forest", model, inputs)


def fit_sequence(
    train: DataFrame, inputs: Inputs, params: SequenceParams, mean: list[float], scale: list[float]
) -> list[Fitted]:
    """The network after each epoch. ``train`` carries ``features``, ``label_index``, ``row_key``."""
    rows = train.select(
        feature_array(train).alias("x"), F.col("label_index").cast("int").alias("y"),
        F.col("row_key").alias("key"),
    )
    start = Recurrent.fresh(params.length, mean, scale, params.hidden, len(inputs.labels), SEED)
    epochs = fit_epochs(
        rows, start, epochs=params.epochs, batch_rows=params.block_size, rate=params.learning_rate
    )
    return [Fitted("sequence", model, inputs) for model, _ in epochs]


def sequence_vector(sequence: Column) -> Column:
    return array_to_vector(F.flatten(sequence))


def feature_importance(fitted: Fitted) -> DataFrame:
    """``feature, importance``, highest first; ties keep the feature order.

    The importance is the feature's share of the gain of all splits.
    """
    rows = [
        (i, name, float(value))
        for i, (name, value) in enumerate(
            zip(fitted.inputs.features, fitted.model.importance(), strict=True)
        )
    ]
    table = SparkSession.active().createDataFrame(rows, "position int, feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "position").select("feature", "importance")
