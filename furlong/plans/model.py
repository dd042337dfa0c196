"""Split by date and label; MLlib's boosted trees, for features that are numbers. ``boosting`` has the others."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from furlong.operators.aggregates import roc_auc
from furlong.operators.project import after_date, between_dates, is_first
from furlong.session import shared_root

LABEL = "label"
SCORE = "score"
# what a tree sees where a feature has no value; below every real value
MISSING = -1e6


def split_by_date(
    df: DataFrame, date: str, train_first: str, train_last: str, valid_last: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train: inclusive range. Valid: strictly later, up to ``valid_last`` if given. Earlier rows: neither."""
    valid = after_date(df, date, train_last)
    return between_dates(df, date, train_first, train_last), between_dates(valid, date, last=valid_last)


def split_name(date: str, train_first: str, train_last: str, valid_last: str | None = None) -> Column:
    """The same split as a column: "train", "valid" or null."""
    valid = F.col(date) > train_last
    if valid_last is not None:
        valid = valid & (F.col(date) <= valid_last)
    return F.when(F.col(date).between(train_first, train_last), "train").when(valid, "valid")


def with_label(df: DataFrame, rank: str = "rank") -> DataFrame:
    """Label 1 for the winner."""
    return df.withColumn(LABEL, is_first(rank))


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns by name, in order, as one vector beside the label.

    Codes are fed as plain numbers: declared as categories they would have to fit into
    the bins of a tree, which ids do not.
    """
    numbers = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in features], LABEL)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(numbers).select("features", LABEL)


class Fitted(NamedTuple):
    model: GBTClassificationModel
    auc: float
    rounds: int


# the fixed part of the parameters; tuned ones are laid over it
BASE_PARAMS: dict[str, Any] = {"stepSize": 0.1, "lossType": "logistic", "seed": 17}

def _fit_rounds(train: DataFrame, params: dict[str, Any], rounds: int) -> GBTClassificationModel:
    booster = GBTClassifier(
        featuresCol="features", labelCol=LABEL, maxIter=rounds, checkpointInterval=10, **params
    )
    return booster.fit(train)


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """Round with the least loss before ``patience`` rounds passed without a better one, and whether they did."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(
    train: DataFrame, valid: DataFrame, params: dict[str, Any] | None = None, max_rounds: int = 300, patience: int = 20
) -> Fitted:
    """Boosted trees on assembled data, up to where the loss on ``valid`` stopped falling.

    MLlib's own stop gives up at the first round without gain. Here all rounds are fitted
    once, and the model is cut behind the best round before ``patience`` rounds brought
    nothing: the first trees of a boosted model are the model of that many rounds.
    """
    shared_root(train.sparkSession)
    model = _fit_rounds(train, {**BASE_PARAMS, **(params or {})}, max_rounds)
    best, _ = best_round(list(model.evaluateEachIteration(valid)), patience)
    model = first_rounds(model, best)
    return Fitted(model, auc_of(model, valid), best)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first so many trees of a boosted one."""
    if rounds >= model.getNumTrees:
        return model
    context = SparkSession.active().sparkContext
    gateway, jvm, whole = context._gateway, context._jvm, model._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = whole.trees()[i], model.treeWeights[i]
    kind = jvm.org.apache.spark.ml.classification.GBTClassificationModel
    cut = GBTClassificationModel(kind(whole.uid(), trees, weights, whole.numFeatures(), whole.numClasses()))
    return cut._set(**{param.name: model.getOrDefault(param) for param in model.params if model.isSet(param)})


def score(model: GBTClassificationModel, assembled: DataFrame) -> DataFrame:
    """The probability of label 1 for each row."""
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(assembled).select(LABEL, probability.alias(SCORE))


def auc_of(model: GBTClassificationModel, assembled: DataFrame) -> float:
    return roc_auc(score(model, assembled), SCORE, LABEL).first()["auc"]


def importance(model: GBTClassificationModel, features: Sequence[str], kind: str = "gain") -> DataFrame:
    """Feature names with their share of the gain, or with how often they are split on ("weight")."""
    if kind not in ("gain", "weight"):
        raise ValueError(f"kind={kind!r}")
    values = model.featureImportances.toArray() if kind == "gain" else split_counts(model, len(features))
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return SparkSession.active().createDataFrame(rows, f"feature string, {kind} double")


def split_counts(model: GBTClassificationModel, size: int) -> list[int]:
    """How often each feature is split on over all trees."""
    counts = [0] * size
    for index in re.findall(r"If \(feature (\d+) ", model.toDebugString):
        counts[int(index)] += 1
    return counts
