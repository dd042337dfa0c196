import random

import pytest
from hypothesis import given, strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from furlong.operators.aggregates import roc_auc
from furlong.plans import model
from furlong.plans.training import TrainConfig
from furlong.sources import tables


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [0, 1, 6])
def test_auc(spark, digits):
    rng = random.Random(digits)
    rows = [(round(rng.random() * 3, digits), float(rng.random() < 0.3)) for _ in range(600)]
    df = spark.createDataFrame(rows, "score double, label double")
    found = roc_auc(df, "score", "label").first()
    assert found["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert found["positives"] + found["negatives"] == 600
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert found["auc"] == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    reversed_scores = df.selectExpr("-score AS score", "label")
    assert roc_auc(reversed_scores, "score", "label").first()["auc"] == pytest.approx(1 - found["auc"], abs=1e-12)


def test_auc_without_one_of_the_classes(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.7, 1.0), (None, 0.0)], "score double, label double")
    assert tuple(roc_auc(df, "score", "label").first()) == (2, 0, None)


def test_split(spark):
    days = ["20231231", "20240101", "20240131", "20240201", "20240301"]
    df = spark.createDataFrame([(d,) for d in days], "race_date string")
    train, valid = model.split_by_date(df, "race_date", "20240101", "20240131")
    assert [r[0] for r in train.collect()] == days[1:3]
    assert [r[0] for r in valid.collect()] == days[3:]
    _, bounded = model.split_by_date(df, "race_date", "20240101", "20240131", "20240201")
    assert [r[0] for r in bounded.collect()] == days[3:4]
    named = df.select(model.split_name("race_date", "20240101", "20240131", "20240201"))
    assert [r[0] for r in named.collect()] == [None, "train", "train", "valid", None]


@given(st.lists(st.floats(0, 1), min_size=1, max_size=60), st.integers(1, 10))
def test_best_round(losses, patience):
    best, stopped = model.best_round(losses, patience)
    seen = losses[: best + patience] if stopped else losses
    assert losses[best - 1] == min(seen) and seen.index(min(seen)) == best - 1
    assert stopped == (best - 1 + patience < len(losses))


FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(1200):
        a, b = rng.random(), rng.random()
        rows.append((a, b if rng.random() > 0.1 else None, 1 if a + 0.2 * rng.random() > 0.6 else 2))
    df = model.with_label(spark.createDataFrame(rows, "a double, b double, rank int"))
    train, valid = df.randomSplit([0.6, 0.4], seed=1)
    return tuple(model.assemble(part, FEATURES).cache() for part in (train, valid))


def test_fit_stops_and_scores(spark, data):
    fitted = model.fit_boosted(*data, {"maxDepth": 2, "stepSize": 0.3}, max_rounds=40, patience=3)
    assert fitted.auc > 0.95 and 1 <= fitted.rounds < 40
    assert fitted.model.getNumTrees == fitted.rounds
    gain = dict(model.importance(fitted.model, FEATURES).collect())
    assert gain["a"] > 0.9 and sum(gain.values()) == pytest.approx(1)
    weight = dict(model.importance(fitted.model, FEATURES, "weight").collect())
    assert weight["a"] >= 1 and weight["b"] >= 0


def test_models_are_stored_under_a_version(spark, data, folder):
    fitted = model.fit_boosted(*data, {"maxDepth": 2}, max_rounds=3, patience=3)
    path = tables.publish_model(spark, fitted.model, {"maxDepth": 2}, {"auc": fitted.auc}, folder, "gbt", "v1")
    assert path == f"{folder}/gbt/model_version=v1"
    stored, params, metrics = tables.read_model(spark, folder, "gbt", "v1")
    assert params == {"maxDepth": 2} and metrics == {"auc": fitted.auc}
    assert model.auc_of(stored, data[1]) == pytest.approx(fitted.auc)


def test_config():
    dates = {"train_first_date": "20240101", "train_last_date": "20240131", "data_version": "d", "model_version": "m"}
    assert TrainConfig(**dates, feature_columns=("a", "b")).feature_columns == ("a", "b")
    assert len(TrainConfig(**dates).feature_columns) == 17
