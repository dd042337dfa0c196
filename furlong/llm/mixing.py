"""Mixing sources to target weights by Pfair scheduling of blocks.

A source's documents, in an order that a hash of the id fixes, form blocks. With weight
w, block i of a source is released at slot floor(i / w) and due by slot ceil((i + 1) / w);
in every slot the released block that is due first is taken. On one line of slots that
order meets every deadline, so before the first source ends each source is less than one
block away from its share at every slot. Releases and deadlines are whole-number
arithmetic on the weights as given, so no error grows with the number of slots. The order
of the blocks is one after the other by nature: one task goes through it, with one row
per source to read and one heap entry per source to hold, and gives out one row per
block; all work on rows is spread.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Mapping
from fractions import Fraction
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from furlong.llm.common import cut_lineage, free_names
from furlong.operators.skew import _hashable, row_numbers

BLOCK_ROWS = 32
#: Slots of one period, where weights are rounded to whole parts of one.
PERIOD = 2048
#: From this slot on no release is waited for, so that slots stay 64-bit numbers.
LAST_WAIT = 1 << 62
#: Rows of the plan that are given out at once.
PLAN_ROWS = 10_000


def parts_of(weights: Mapping[Any, float], period: int = PERIOD) -> dict[Any, int]:
    """Whole parts of the period, at least one for each positive weight, by largest remainder."""
    wanted = {s: w for s, w in weights.items() if w > 0}
    if len(wanted) > period:
        raise ValueError(f"{len(wanted)} sources don't fit a period of {period} slots")
    total = sum(wanted.values())
    spare = period - len(wanted)
    exact = {s: w / total * spare for s, w in wanted.items()}
    parts = {s: 1 + int(x) for s, x in exact.items()}
    names = sorted(wanted, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    for s in names[: period - sum(parts.values())]:
        parts[s] += 1
    return parts


def pfair(weights: list[Any], blocks: list[int]) -> Iterator[tuple[int, int, int, bool]]:
    """(place of the source, block, slot, on target) in the order of slots, earliest deadline first among the released.

    The slot in which a source is found to have ended stays empty, and from the first such
    slot on no block is on target. An ended source asks for no more slots, and where no
    other block is released a slot stays empty. Of equal deadlines the first place is taken.
    """
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*[w.denominator for w in exact])
    parts = [w.numerator * (scale // w.denominator) for w in exact]
    total = sum(parts)
    ready = [(-(-total // n), place, 0) for place, n in enumerate(parts)]
    heapq.heapify(ready)
    waiting: list[tuple[int, int, int]] = []
    slot, on_target = 0, True
    while ready or waiting:
        now = slot if ready else max(slot, waiting[0][0])
        slot = max(slot, min(now, LAST_WAIT))
        while waiting and waiting[0][0] <= now:
            _, place, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * total // parts[place]), place, block))
        _, place, block = heapq.heappop(ready)
        if block < blocks[place]:
            yield place, block, slot, on_target
            heapq.heappush(waiting, ((block + 1) * total // parts[place], place, block + 1))
        else:
            on_target = False
        slot += 1


def pfair_period(parts: Mapping[Any, int]) -> list[tuple[Any, int, int]]:
    """(source, block of the period, slot) for one period."""
    names, counts = list(parts), list(parts.values())
    return [(names[place], block, slot) for place, block, slot, _ in islice(pfair(counts, counts), sum(counts))]


def tempered(counts: Mapping[Any, int], exponent: float) -> dict[Any, float]:
    """Weights that grow with a power of the size: 1 keeps the shares, 0 makes them equal."""
    return {s: float(n) ** exponent for s, n in counts.items() if n > 0}


def schedule(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    weights: Mapping[Any, float] | None = None,
    exponent: float = 0.7,
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """One row per row of ``docs``: id, source, ``block`` of its source, ``slot``, ``place`` in the block, ``on_target``.

    Sorting by slot and place gives the mix. ``on_target``: the slot comes before the
    first source has ended, so the shares hold; later rows are scheduled as well, with
    slots that ended sources leave empty. Without ``weights`` they come from the sizes,
    tempered by ``exponent``. With ``period`` they are rounded to whole parts of so many
    slots, and there can't be more sources than slots; without it they hold as they are,
    for any number of sources. A null source is a source of its own; a source without a
    weight gets no slot. Rows without an id, and rows that repeat one, have their own
    places. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("__id"), F.col(source).alias("__source"))
    # rows that are equal in both columns can change places; the mark keeps them apart in the sort
    marked = rows.withColumn("__mark", F.monotonically_increasing_id())
    return _placed(marked, ["__mark"], weights, exponent, block_rows, period, seed).select(
        F.col("__id").alias(id_column), F.col("__source").alias(source), "block", "slot", "place", "on_target"
    )


def _placed(
    rows: DataFrame,
    ties: list[str],
    weights: Mapping[Any, float] | None = None,
    exponent: float = 0.7,
    block_rows: int = BLOCK_ROWS,
    period: int | None = None,
    seed: int = 17,
) -> DataFrame:
    """The rows, which have ``__id`` and ``__source``, with block, slot, place, on_target and ``__number``.

    ``ties`` order rows with equal ids. ``__number``: place in the order by source, then hash.
    """
    columns = rows.columns
    rows = rows.withColumn("__order", F.xxhash64(F.lit(seed), "__id"))
    numbered = cut_lineage(row_numbers(rows, ["__source", "__order", "__id", *ties], "__number"), "numbered")
    sizes = numbered.groupBy("__source").agg(F.min("__number").alias("first"), F.count("*").alias("n"))
    if period is not None:
        found = sizes.sort("first").limit(period + 1).collect()  # bounded by the period
        if len(found) > period:
            raise ValueError(f"more than {period} sources; raise the period")
        counts = {r["__source"]: r["n"] for r in found}
        given = tempered(counts, exponent) if weights is None else {s: w for s, w in weights.items() if s in counts}
        weights = parts_of(given, period) if given else {}
    spark = rows.sparkSession
    if weights is not None:
        kind = rows.schema["__source"].dataType.simpleString()
        table = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], f"__s {kind}, weight double")
        sizes = sizes.join(table, F.col("__source").eqNullSafe(F.col("__s")), "left")
    else:
        sizes = sizes.withColumn("weight", F.lit(None).cast("double"))

    # one row per source in, one per block out; then dealt out by number, as few bytes give many rows
    sources = sizes.select("first", "n", "weight").repartition(1).sortWithinPartitions("first")
    plan = sources.mapInArrow(
        _planner(block_rows, exponent if weights is None else None),
        "__head long, __rows long, block long, slot long, on_target boolean",
    )
    plan = plan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__head")
    plan = plan.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("__rows").cast("int") - 1)))
    plan = plan.withColumn("__number", F.col("__head") + F.col("place")).drop("__head", "__rows")
    # few bytes before the rows come out of them, so the plan would be broadcast
    return numbered.join(plan.hint("merge"), "__number").select(*columns, "__number", "block", "slot", "place", "on_target")


def _planner(
    block_rows: int, exponent: float | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns first row, rows and weight of every source into the plan: first row, rows and slot of every block.

    With ``exponent`` the weights come from the sizes. Blocks of sources without a weight have no slot.
    """

    def blocks_of(sources: list[tuple[int, int, float | None]]) -> Iterator[tuple[int, int, int, int | None, bool]]:
        def row(place: int, block: int, slot: int | None, on_target: bool):
            first, n, _ = sources[place]
            begin = block * block_rows
            return first + begin, min(block_rows, n - begin), block, slot, on_target

        blocks = [-(-n // block_rows) for _, n, _ in sources]
        weighted = [place for place, (_, _, w) in enumerate(sources) if w is not None and w > 0]
        slots = pfair([sources[place][2] for place in weighted], [blocks[place] for place in weighted])
        for at, block, slot, on_target in slots:
            yield row(weighted[at], block, slot, on_target)
        for place in sorted({*range(len(sources))} - {*weighted}):
            for block in range(blocks[place]):
                yield row(place, block, None, False)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources: list[tuple[int, int, float | None]] = []
        for batch in batches:
            first, n, weight = (c.to_pylist() for c in batch.columns)
            if exponent is not None:
                weight = [float(x) ** exponent for x in n]
            sources += zip(first, n, weight)
        rows = blocks_of(sources)
        while part := list(islice(rows, PLAN_ROWS)):
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            names = ["__head", "__rows", "block", "slot", "on_target"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*part), kinds)], names)

    return plan


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", **options: Any) -> DataFrame:
    """All rows of ``docs`` in the order of the mix, by slot and place, all their columns.

    The shares hold until the first source ends (``on_target`` of ``schedule``). What
    comes later follows in its slots, and rows of sources without a weight come last.
    Rows without an id, and rows that repeat one, have their own places, in the order of
    a hash of the row.
    """
    key, tie, slot, number = free_names(docs, 4)
    keyed = docs.withColumns({tie: F.xxhash64(*_hashable(docs)), key: F.monotonically_increasing_id()})
    keyed = cut_lineage(keyed, "keyed")
    rows = keyed.select(F.col(key).alias("__key"), F.col(tie).alias("__tie"), F.col(id_column).alias("__id"), F.col(source).alias("__source"))
    order = _placed(rows, ["__tie", "__key"], **options)
    order = order.select(F.col("__key").alias(key), F.col("slot").alias(slot), F.col("__number").alias(number))
    ordered = keyed.join(order.hint("merge"), key).sort(F.asc_nulls_last(slot), number)
    return ordered.drop(key, tie, slot, number)
