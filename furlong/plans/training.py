"""A training run from landed pages to a stored model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from furlong import fixed_values as fixed
from furlong.plans.boosting import Fitted, importance, prepare
from furlong.plans.features import CATEGORIES, preprocess
from furlong.plans.model import split_by_date, with_label
from furlong.plans.race_result import get_race_results
from furlong.plans.search import SEARCH_SPACES, search
from furlong.sources.pages import PageSource
from furlong.sources.tables import publish_all, publish_booster, read_version


@dataclass
class TrainConfig:
    """Settings of a training run."""

    train_first_date: str
    train_last_date: str
    data_version: str
    model_version: str
    valid_last_date: str | None = None
    model: str = "leaves"
    feature_columns: tuple[str, ...] = tuple(fixed.FEATURE_COLUMNS)
    max_rounds: int = 300
    patience: int = 20
    trials: int = 100
    parallelism: int = 2
    least_rounds: int = 10


def build_features(spark: SparkSession, config: TrainConfig, pages: PageSource, data_root: str) -> DataFrame:
    """Results of the run's dates, turned into features and published under the data version."""
    raw = get_race_results(
        spark, pages, data_root, config.data_version, config.train_first_date, config.valid_last_date
    )
    publish_all(preprocess(raw), data_root, config.data_version, replace=True)
    return read_version(spark, data_root, config.data_version, "feature")


def train_and_publish(
    spark: SparkSession, config: TrainConfig, pages: PageSource, data_root: str, model_root: str
) -> tuple[Fitted, DataFrame]:
    """Build features, split by date, search, store the best model found.

    Its fit has come to its end in the search: it is the one that was promoted to the last
    rung. Returns the fitted model with its AUC, and the importance of the features.
    """
    labelled = with_label(build_features(spark, config, pages, data_root))
    train, valid = split_by_date(
        labelled, "race_date", config.train_first_date, config.train_last_date, config.valid_last_date
    )
    # codes of ids are split on as sets of ids, not as numbers
    sets = [c for c in config.feature_columns if c in {f"{name}_cat" for name in CATEGORIES}]
    prepared = prepare(train, valid, [c for c in config.feature_columns if c not in sets], sets)
    fitted, trials = search(
        prepared, SEARCH_SPACES[config.model], config.trials, config.max_rounds, config.patience,
        least_rounds=config.least_rounds, parallelism=config.parallelism,
    )
    best = next(trial for trial in trials if trial.fitted is fitted)
    metrics = {"auc": fitted.auc, "rounds": fitted.rounds}
    publish_booster(spark, fitted.model, best.drawn, metrics, model_root, config.model, config.model_version)
    return fitted, importance(spark, fitted.model)
