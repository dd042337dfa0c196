"""Joins and orderings that hold when one key owns a large share of all rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DoubleType, FloatType, IntegralType, LongType, MapType, StructType,
)

from furlong.session import cut_lineage

# A key counts as hot from this many rows on; each slice of it then holds about as many.
ROWS_PER_SLICE = 1_000_000
# Most keys the heavy-hitter summary returns, hence the bound of what is collected and
# broadcast. Any key beyond that holds less than a ten-thousandth of the rows.
MAX_HOT_KEYS = 10_000
TRACKED_KEYS = 20_000
# Groups of tasks whose summaries are merged before the last step.
MERGE_GROUPS = 512

_HASH = "__key_hash"
_SLICES = "__slices"
_SLICE = "__slice"


class HotKeys(NamedTuple):
    """How to spread the keys of one join."""

    slices: dict[int, int]  # hash of a hot key: number of slices
    null_slices: int  # slices for the rows that lack a key


def _wide(kind: DataType) -> DataType:
    """The type in which equal keys of several number types hash alike."""
    if isinstance(kind, IntegralType):
        return LongType()
    return DoubleType() if isinstance(kind, FloatType) else kind


def _common_types(left: DataFrame, right: DataFrame, keys: list[str]) -> dict[str, DataType]:
    """Per key the type that a join compares it in."""
    types = {}
    for key in keys:
        kinds = {_wide(side.schema[key].dataType) for side in (left, right)}
        types[key] = kinds.pop() if len(kinds) == 1 else _wide(left.select(key).union(right.select(key)).schema[0].dataType)
    return types


def _key_hash(keys: list[str], types: dict[str, DataType]) -> Column:
    values = [F.col(key).cast(types[key]) for key in keys]
    # -0.0 equals 0.0 in a join
    return F.xxhash64(*[v + F.lit(0.0) if isinstance(types[k], DoubleType) else v for k, v in zip(keys, values)])


def find_hot_keys(
    df: DataFrame,
    key_sets: list[list[str]],
    rows_per_slice: int = ROWS_PER_SLICE,
    types: dict[str, DataType] | None = None,
) -> list[HotKeys]:
    """Heavy keys of several joins, found in one pass over the key columns.

    A mergeable summary of fixed size per key set is all that leaves the tasks. It
    only steers how work is spread: a key that is missed, or hit by chance because of
    an equal hash, changes no result. ``types``: in which the keys are compared, if not
    in their own. A table without rows has no hot keys.
    """
    sets = range(len(key_sets))
    types = types or {key: _wide(df.schema[key].dataType) for keys in key_sets for key in keys}
    hashed = df.select(
        F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("g"),
        *[F.when(_all_present(keys), _key_hash(keys, types)).alias(f"h{i}") for i, keys in enumerate(key_sets)],
    )
    # merged in two steps, so that no task takes in the summaries of all others
    merged = hashed.groupBy("g").agg(
        *[F.expr(f"approx_top_k_accumulate(h{i}, {TRACKED_KEYS})").alias(f"state{i}") for i in sets],
        *[F.count_if(F.col(f"h{i}").isNull()).alias(f"nulls{i}") for i in sets],
    )
    # by a constant, so that a partition without rows adds nothing instead of an empty summary
    found = merged.groupBy(F.lit(True)).agg(
        *[
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(state{i}, {TRACKED_KEYS}), {MAX_HOT_KEYS})").alias(f"top{i}")
            for i in sets
        ],
        *[F.sum(f"nulls{i}").alias(f"nulls{i}") for i in sets],
    ).first()
    out = []
    if found is None:
        return [HotKeys({}, 0) for _ in sets]
    for i in sets:
        hot = {
            item["item"]: -(-item["count"] // rows_per_slice)
            for item in found[f"top{i}"] or []
            if item["item"] is not None and item["count"] > rows_per_slice
        }
        out.append(HotKeys(hot, -(-(found[f"nulls{i}"] or 0) // rows_per_slice)))
    return out


def _hashable(df: DataFrame) -> list[Column]:
    """The columns that can be hashed; of a map its entries."""

    def has_map(kind: DataType) -> bool:
        if isinstance(kind, StructType):
            return any(has_map(f.dataType) for f in kind.fields)
        return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and has_map(kind.elementType))

    out = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, MapType) and not has_map(kind.keyType) and not has_map(kind.valueType):
            out.append(F.map_entries(column))
        elif not has_map(kind):
            out.append(column)
    return out


def _all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    hot: HotKeys | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Equi-join of a large left side with hot keys to a right side that is narrow per key.

    Rows of a hot key are cut into slices by a hash of the row and its partition, and
    only the right rows of that key are repeated, once per slice. Left rows that lack a
    key are spread as well. Where nothing is hot this is the plain join, and adaptive
    execution turns it into a broadcast when the right side proves small at run time.

    ``hot`` is looked up in ``left`` unless it is given; give it when ``left`` is the
    result of earlier joins, so that they do not run for the lookup too.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"spread_join keeps or drops left rows only: how={how!r}")
    types = _common_types(left, right, keys)
    if hot is None:
        hot = find_hot_keys(left, [keys], rows_per_slice, types)[0]
    rest = [c for c in right.columns if c not in keys]
    if not hot.slices and hot.null_slices <= 1:
        return left.join(right, keys, how).select(*left.columns, *rest)

    spark = left.sparkSession
    table = F.broadcast(spark.createDataFrame(list(hot.slices.items()), f"{_HASH} long, {_SLICES} int"))
    # the partition number parts exact copies of a row; unlike a random number it is the
    # same again when a lost task is run once more
    row_hash = F.xxhash64(F.spark_partition_id(), *_hashable(left))
    sliced_left = (
        left.withColumn(_HASH, _key_hash(keys, types))
        .join(table, _HASH, "left")
        .withColumn(
            _SLICE,
            F.when(~_all_present(keys), F.pmod(row_hash, F.lit(max(hot.null_slices, 1))))
            .when(F.col(_SLICES).isNotNull(), F.pmod(row_hash, F.col(_SLICES)))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop(_HASH, _SLICES)
    )
    sliced_right = (
        right.filter(_all_present(keys))
        .withColumn(_HASH, _key_hash(keys, types))
        .join(table, _HASH, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SLICES), F.lit(1)) - 1)))
        .drop(_HASH, _SLICES)
    )
    return sliced_left.join(sliced_right, [*keys, _SLICE], how).select(*left.columns, *rest)


_MARK, _PART = "__mark", "__part"


def _placed(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows range sorted once and written out, each with its range and a rising mark."""
    marked = df.sort(*order).withColumn(_MARK, F.monotonically_increasing_id())
    return cut_lineage(marked.withColumn(_PART, F.shiftright(F.col(_MARK), 33)), "ordered")


def _starts(sums: DataFrame, names: list[str]) -> DataFrame:
    """What lies before each range, from a table of one row per range."""
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    return F.broadcast(
        sums.select(_PART, *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"__start_{name}") for name in names])
    )


def running_totals(df: DataFrame, order: list[str], totals: dict[str, str]) -> DataFrame:
    """Sum of a column over all rows ordered before this one, over the whole table.

    ``totals`` maps each new column to the column it adds up. Each sorted range is
    summed on its own, and the ranges are chained by a table of one row per range.
    ``order`` should be unique: rows that are equal in it cannot be spread.
    """
    placed = _placed(df, order)
    within = Window.partitionBy(_PART).orderBy(_MARK).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    sums = placed.groupBy(_PART).agg(*[F.sum(c).alias(new) for new, c in totals.items()])
    return (
        placed.withColumns({f"__in_{new}": F.coalesce(F.sum(c).over(within), F.lit(0)) for new, c in totals.items()})
        .join(_starts(sums, list(totals)), _PART)
        .select(*df.columns, *[(F.col(f"__in_{new}") + F.col(f"__start_{new}")).alias(new) for new in totals])
    )


def row_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Place of each row in the order of the whole table, from 0.

    The mark of a row already counts within its range, so only the ranges are chained.
    """
    placed = _placed(df, order)
    counts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias(name))
    within = F.col(_MARK) - F.shiftleft(F.col(_PART), 33)
    return placed.join(_starts(counts, [name]), _PART).select(*df.columns, (within + F.col(f"__start_{name}")).alias(name))


def keyed_running_totals(df: DataFrame, key: str, order: list[str], totals: dict[str, str]) -> DataFrame:
    """Sum of a column over the rows of the same key ordered before this one, whatever a key's share of the rows.

    Rows are range sorted by key and order, so a key with many rows lies in several ranges. Each
    range is summed on its own; only a key that crosses a border carries on, and of these there
    is at most one per range. ``key`` and ``order`` together should be unique. A missing key is a
    key of its own.
    """
    placed = _placed(df, [key, *order])
    rows = placed.withColumn("__key", F.struct(F.col(key)))
    within = Window.partitionBy(_PART, key).orderBy(_MARK).rowsBetween(Window.unboundedPreceding, Window.currentRow - 1)
    # the key that a range ends with is the only one that can go on behind it
    last = rows.groupBy(_PART).agg(F.max_by("__key", _MARK).alias("__last"), F.min_by("__key", _MARK).alias("__first"))
    ends = (
        rows.join(F.broadcast(last), _PART)
        .filter(F.col("__key").eqNullSafe(F.col("__last")))
        .groupBy(_PART, "__last")
        .agg(*[F.sum(c).alias(new) for new, c in totals.items()])
    )
    # one row per range: what its first key had in the ranges before
    before = Window.partitionBy("__last").orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = ends.select(
        (F.col(_PART)).alias("__from"), "__last", *[F.coalesce(F.sum(new).over(before), F.lit(0)).alias(f"__carry_{new}") for new in totals]
    )
    ranges = last.select(_PART, "__first").withColumn("__prior", F.lag(_PART).over(Window.orderBy(_PART)))
    carried = ranges.join(upto, (F.col("__prior") == F.col("__from")) & F.col("__first").eqNullSafe(F.col("__last")), "left").select(
        _PART, "__first", *[f"__carry_{new}" for new in totals]
    )
    out = rows.withColumns({f"__in_{new}": F.coalesce(F.sum(c).over(within), F.lit(0)) for new, c in totals.items()}).join(
        F.broadcast(carried), _PART
    )
    is_first = F.col("__key").eqNullSafe(F.col("__first"))
    return out.select(
        *df.columns,
        *[
            (F.col(f"__in_{new}") + F.when(is_first, F.coalesce(F.col(f"__carry_{new}"), F.lit(0))).otherwise(F.lit(0))).alias(new)
            for new in totals
        ],
    )
