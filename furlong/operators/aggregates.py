"""Means, lists per date, ROC-AUC, dictionary codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from furlong.operators.joins import attach_mean
from furlong.operators.skew import find_hot_keys, keyed_running_totals, row_numbers, running_totals, spread_join

IDS_PER_LIST = 10_000


def mean_per_key(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Mean per key, nulls ignored. Combined before the shuffle, so hot keys are cheap."""
    return rows.groupBy(key).agg(F.avg(value).alias(name))


def add_deviation(rows: DataFrame, value: str, mean: str, name: str) -> DataFrame:
    return rows.withColumn(name, F.col(value) - F.col(mean))


def deviation_from_mean(rows: DataFrame, key: str, value: str, mean: str, name: str) -> DataFrame:
    """Mean per key joined back to its rows, and each row's distance from it."""
    means = mean_per_key(rows.filter(F.col(key).isNotNull()), key, value, mean)
    return add_deviation(attach_mean(rows, means, key), value, mean, name)


def mean_before(rows: DataFrame, key: str, date: str, value: str, name: str) -> DataFrame:
    """Per row the mean of its key over strictly earlier dates; null where there is none.

    What a model may know of a row's key on the day: no value of the same or a later date goes
    in. Values are first summed per key and date, so only those sums are ordered. Rows without a
    key or date have no mean; missing values don't count.
    """
    known = rows.filter(F.col(key).isNotNull() & F.col(date).isNotNull())
    daily = known.groupBy(key, date).agg(F.coalesce(F.sum(value), F.lit(0)).alias("__sum"), F.count(value).alias("__n"))
    upto = keyed_running_totals(daily, key, [date], {"__sum_before": "__sum", "__n_before": "__n"})
    means = upto.select(key, date, F.when(F.col("__n_before") > 0, F.col("__sum_before") / F.col("__n_before")).alias(name))
    return spread_join(rows, means, [key, date])


def _places(rows: DataFrame, date: str, id_column: str) -> DataFrame:
    """Per date and id the first place among the date's ids in order, ``__first``, and the number of copies, ``__n``."""
    # equal ids travel as one row with a count
    counted = rows.groupBy(date, id_column).agg(F.count(F.lit(1)).alias("__n"))
    return keyed_running_totals(counted, date, [id_column], {"__first": "__n"})


def placed_ids(rows: DataFrame, date: str, id_column: str) -> DataFrame:
    """One row per date, ``place`` (from 0, in order of the id) and id, duplicates kept, whatever a date's size."""
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))
    placed = _places(rows, date, id_column).withColumn("__copy", copies)
    return placed.select(date, (F.col("__first") + F.col("__copy")).alias("place"), id_column)


def ids_per_date(rows: DataFrame, date: str, id_column: str, per_list: int = IDS_PER_LIST) -> DataFrame:
    """The ids of ``placed_ids`` as lists, ``part`` after ``part`` of ``per_list`` places; a view for readers of lists.

    An ordinary date is one list (``part`` 0); no list and no task grows with the largest date.
    """
    last = F.col("__first") + F.col("__n") - 1
    pieces = (
        _places(rows, date, id_column)
        .withColumn("__last", last)
        .withColumn(
            "part",
            F.explode(F.sequence(F.floor(F.col("__first") / per_list), F.floor(F.col("__last") / per_list))),
        )
        .withColumn(
            "__copies",
            F.least(F.col("__last"), (F.col("part") + 1) * per_list - 1)
            - F.greatest(F.col("__first"), F.col("part") * per_list)
            + 1,
        )
    )
    listed = pieces.groupBy(date, "part").agg(
        F.array_sort(F.collect_list(F.struct("__first", id_column, "__copies"))).alias("__items")
    )
    repeated = F.transform(
        "__items", lambda item: F.array_repeat(item[id_column], item["__copies"].cast("int"))
    )
    return listed.select(date, F.col("part").cast("int").alias("part"), F.flatten(repeated).alias(f"{id_column}s"))


def roc_auc(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve as one row (``positives``, ``negatives``, ``auc``).

    Ties count half. Rows are first counted per distinct score, so a score shared by
    many rows costs nothing; the cumulative step runs on sorted ranges.
    """
    positive = F.sum((F.col(label) == 1).cast("long"))
    per_score = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(score)
        .agg(positive.alias("__pos"), F.count(F.lit(1)).alias("__all"))
        .withColumn("__neg", F.col("__all") - F.col("__pos"))
        .drop("__all")
    )
    ordered = running_totals(per_score, [score], {"__neg_below": "__neg"})
    wins = F.col("__pos").cast("double") * (F.col("__neg_below") + F.col("__neg") / F.lit(2.0))
    sums = ordered.agg(
        F.coalesce(F.sum("__pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("__neg"), F.lit(0)).alias("negatives"),
        F.sum(wins).alias("__wins"),
    )
    pairs = F.nullif(F.col("positives").cast("double") * F.col("negatives"), F.lit(0.0))
    return sums.select("positives", "negatives", (F.col("__wins") / pairs).alias("auc"))


AUC_BUCKETS = 4096


def bucketed_auc(scored: DataFrame, score: str, label: str, share: Column) -> float | None:
    """Exact area under the ROC curve by a single job; null where a label is missing.

    ``share`` rises with the score and lies in [0, 1]; it deals the scores to buckets, which
    are gone through in order. Within a bucket scores are counted and ordered by a window.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counted = known.select(F.col(score).alias("__score"), (F.col(label) == 1).cast("long").alias("__pos"), F.lit(1).alias("__all"), share.alias("__share"))
    return counted_auc(counted, F.col("__share"))


def counted_auc(counted: DataFrame, share: Column) -> float | None:
    """As ``bucketed_auc``, from rows that count for several: ``__score``, ``__pos`` of label 1, ``__all``."""
    bucket = F.least(F.floor(share * AUC_BUCKETS), F.lit(AUC_BUCKETS - 1))
    per_score = (
        counted.groupBy(bucket.alias("__bucket"), "__score")
        .agg(F.sum("__pos").alias("__pos"), F.sum("__all").alias("__all"))
        .withColumn("__neg", F.col("__all") - F.col("__pos"))
    )
    before = Window.partitionBy("__bucket").orderBy("__score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__neg").over(before), F.lit(0))
    inside = per_score.withColumn("__wins", F.col("__pos").cast("double") * (below + F.col("__neg") / F.lit(2.0)))
    sums = inside.groupBy("__bucket").agg(F.sum("__pos"), F.sum("__neg"), F.sum("__wins"))
    positives, negatives, wins = 0, 0, 0.0
    for _, pos, neg, own in sorted(sums.collect()):  # at most one row per bucket
        wins += own + float(pos) * negatives
        positives += pos
        negatives += neg
    return wins / (positives * negatives) if positives and negatives else None


def dictionary(rows: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct values with dense codes from 0 in sort order."""
    distinct = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    return row_numbers(distinct, [column], code)


def encode_with(rows: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """Look up each column's code, or whatever else its dictionary holds per value; unknown and missing values get null."""
    hot = find_hot_keys(rows, [[column] for column in dictionaries])
    encoded = rows
    for (column, codes), spread in zip(dictionaries.items(), hot):
        encoded = spread_join(encoded, codes, [column], hot=spread)
    return encoded


def dictionary_encode(rows: DataFrame, columns: list[str], suffix: str = "_cat") -> DataFrame:
    """Add a dense code per value of each column; a missing value has no code."""
    return encode_with(rows, {column: dictionary(rows, column, f"{column}{suffix}") for column in columns})
