"""Boosted trees by gradient histograms.

A round adds up gradients, curvatures and rows per (leaf, feature, bin): each task adds up its
own rows in numpy, and Spark adds up what the tasks found. The sums, whose number depends on
leaves and bins and not on rows, are all that is shuffled and all that reaches the driver.
Ids are split on as sets: per leaf the ids are ordered by gradient over curvature, and the
best cut through that order is found on Spark, where the sums per id stay; the ids of the
chosen side are a stored table.

A tree grows leaf by leaf, the one with the largest gain first. So that a tree takes one
aggregation per level and not one per leaf, every leaf that may come up is looked at ahead,
and what did not come up is cut off again.

Without id columns rows are stored in blocks: one row of the stored table holds some ten
thousand rows as arrays. The executors keep the blocks with their margins, in memory as far as
it goes, so a pass is one stage that reads no table; a round makes new ones from those of the
last, and every few rounds they are checkpointed. What an executor loses is made again from there.

With id columns margins are stored after every round. A fit ends at the first round that brought
no gain in AUC for ``patience`` rounds, and goes on from its state if more rounds are asked for.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from furlong.operators.aggregates import bucketed_auc
from furlong.operators.skew import HotKeys, find_hot_keys, spread_join
from furlong.session import cut_lineage, discard, discard_checkpoint, scratch_path

LABEL = "label"
SCORE = "score"
MARGIN = "margin"
BINS = 255
#: Buckets of the order of ids within a leaf; a task sorts the ids of one of them.
RATIO_BUCKETS = 256
DRAW = 1 << 20
#: Rows of a block, and bytes of a row group of blocks, which a reader holds at once.
BLOCK_ROWS = 1 << 16
BLOCK_GROUP_BYTES = 16 << 20
#: Tasks of a pass per slot, and the blocks that one of them has at most unless it has few rows.
TASKS_PER_SLOT = 3
TASK_BLOCKS = 64
#: Partial sums that are added up on the driver; of more of them some are added up on the executors first.
MOST_PARTIAL = 64
#: After so many rounds the blocks are checkpointed, so that what they come from stays short.
CHECKPOINT_ROUNDS = 10
KEPT = StorageLevel.MEMORY_AND_DISK
#: Different scores that a task of the AUC orders, and how many places it gives for cutting the next round's.
RANGE_SCORES = 50_000
RANGE_PLACES = 64
#: Steps down the trees that are made in SQL for a row; more of them are made in numpy.
STEPS_IN_SQL = 16


@dataclass(frozen=True)
class BoostParams:
    """How trees grow. ``row_every``: for how many rounds a draw of rows holds, 0 for no draws; ``max_depth`` 0: no bound."""

    rate: float = 0.1
    leaves: int = 31
    max_depth: int = 0
    l1: float = 0.0
    l2: float = 0.0
    least_rows: int = 20
    least_curvature: float = 1e-3
    row_share: float = 1.0
    row_every: int = 0
    feature_share: float = 1.0
    set_smoothing: float = 10.0
    seed: int = 17


class Prepared(NamedTuple):
    """Train and valid rows as one stored table: row, valid, label, bins and ids."""

    table: DataFrame  # rows, or blocks of them if there are no sets
    features: list[str]
    sets: list[str]
    cuts: list[list[float]]  # per feature the upper ends of its bins but the last
    start: float  # log odds of the train rows
    hot: list[HotKeys]  # per id column
    train: RDD | None = None  # blocks at the start, if there are no sets
    valid: RDD | None = None

    def drop(self) -> None:
        """Let go of the kept blocks, once no fit starts from them any more."""
        for blocks in (self.train, self.valid):
            if blocks is not None:
                blocks.unpersist()

    @property
    def rows(self) -> DataFrame:
        return self.table if self.sets else unpacked(self.table, len(self.features), self.start)


NODE_SCHEMA = (
    "number int, tree int, depth int, g double, h double, n long, feature int, is_set boolean, bin int, threshold double, "
    "missing_left boolean, left int, right int, gain double, value double"
)


@dataclass
class Node:
    """A node of a tree; ``left`` is -1 in a leaf. Numbers of nodes are unique in a model."""

    number: int
    tree: int
    depth: int
    g: float
    h: float
    n: int
    feature: int = -1
    is_set: bool = False
    bin: int = 0
    threshold: float = 0.0
    missing_left: bool = False
    left: int = -1
    right: int = -1
    gain: float = 0.0
    value: float = 0.0


@dataclass
class Boosted:
    """A model: its nodes, and the ids of its sets (``node``, ``feature``, ``id``), a stored table."""

    features: list[str]
    sets: list[str]
    start: float
    nodes: list[Node]
    ids: DataFrame | None = None

    @property
    def trees(self) -> int:
        return max((node.tree for node in self.nodes), default=-1) + 1

    def first_trees(self, count: int) -> Boosted:
        return replace(self, nodes=[node for node in self.nodes if node.tree < count])


@dataclass
class State:
    """What a fit goes on from: the whole model, the rows with their margins, the AUC after each round."""

    model: Boosted
    table: DataFrame | None  # as ``Prepared.table``, with margins; none if there are no sets
    path: str | None
    history: list[float] = field(default_factory=list)
    train: RDD | None = None  # blocks with margins, if there are no sets
    valid: RDD | None = None
    edges: list[float] = field(default_factory=list)  # scores that cut the valid rows into ranges
    made_from: list[RDD] = field(default_factory=list)  # blocks that are let go once the train blocks are made
    saved: list[RDD] = field(default_factory=list)  # the last ones that were checkpointed
    outdated: list[RDD] = field(default_factory=list)  # those before

    @property
    def rows(self) -> DataFrame:
        if self.model.sets:
            return self.table
        rows = [part.map(_as_row(valid)) for part, valid in ((self.train, False), (self.valid, True))]
        blocks = SparkSession.active().createDataFrame(rows[0].union(rows[1]), f"{BLOCK_SCHEMA}, {MARGIN} binary")
        return unpacked(blocks, len(self.model.features), self.model.start)

    def settle(self) -> None:
        """Let go of what the blocks were made from, now that they are there."""
        for blocks in self.made_from:
            blocks.unpersist()
        for blocks in self.outdated:
            discard_checkpoint(blocks)
        self.made_from, self.outdated = [], []

    def drop(self) -> None:
        """Let go of margins that nothing goes on from."""
        if self.path:
            discard(self.table.sparkSession, self.path)
        if self.history and self.train is not None:
            self.train.unpersist()
            self.valid.unpersist()
            self.outdated += self.saved
        self.settle()


class Fitted(NamedTuple):
    model: Boosted
    auc: float
    rounds: int
    state: State


# -- preparation ---------------------------------------------------------------


def _array(values: Sequence[Any], kind: str) -> Column:
    """A constant array; its values are not part of the generated code, so equal plans share it."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def bin_cuts(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Per feature at most ``bins - 1`` values that cut its rows into parts of about equal size."""
    if not features:
        return []
    shares = F.array(*[F.lit((i + 1) / bins) for i in range(bins)])
    found = train.agg(*[F.percentile_approx(_number(c), shares).alias(f"c{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(found[f"c{i}"] or []))[:-1] for i in range(len(features))]


def prepare(
    train: DataFrame, valid: DataFrame, features: Sequence[str], sets: Sequence[str] = (), bins: int = BINS, label: str = LABEL
) -> Prepared:
    """Bin the features and store both parts. Labels are 0 and 1; null and NaN are missing values.

    ``sets``: id columns, split on as sets of ids; a missing id is in no set. Both tables are
    read twice: give stored ones.
    """
    features, sets = list(features), list(sets)
    cuts = bin_cuts(train, features, bins)
    both = train.withColumn("__valid", F.lit(False)).unionByName(valid.withColumn("__valid", F.lit(True)), allowMissingColumns=True)
    numbers = F.array(*[_number(c) for c in features]) if features else F.array().cast("array<double>")
    ids = F.array(*[F.col(c).cast("string") for c in sets]) if sets else F.array().cast("array<string>")
    rows = both.select(
        F.monotonically_increasing_id().alias("row"), F.col("__valid").alias("valid"), F.col(label).cast("double").alias(LABEL),
        numbers.alias("__x"), ids.alias("s"),
    )
    rows = rows.filter(F.col(LABEL).isNotNull())
    if sets:
        stored = cut_lineage(rows.withColumn("b", _binner(cuts)("__x")).drop("__x"), "binned")
        counts = stored.filter("NOT valid").agg(F.sum(LABEL).alias("ones"), F.count("*").alias("n")).first()
    else:
        path = scratch_path(rows.sparkSession, "binned")
        blocks = rows.drop("s").mapInArrow(_packer(cuts), BLOCK_SCHEMA)
        _write_blocks(blocks, path)
        stored = rows.sparkSession.read.schema(BLOCK_SCHEMA).parquet(path)
        found = stored.groupBy("valid").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"), F.count("*").alias("blocks"))
        by_part = {part["valid"]: part for part in found.toArrow().to_pylist()}
        counts = by_part.get(False, {"ones": 0.0, "n": 0})
    if not counts["n"] or not 0 < counts["ones"] < counts["n"]:
        raise ValueError("the train rows must have both labels")
    start = math.log(counts["ones"] / (counts["n"] - counts["ones"]))
    hot = []
    if sets:
        flat = stored.select(*[F.get("s", i).alias(f"id{i}") for i in range(len(sets))])
        hot = find_hot_keys(flat, [[f"id{i}"] for i in range(len(sets))])
        return Prepared(stored, features, sets, cuts, start, hot)
    parts = [
        _kept_blocks(stored.filter(F.col("valid") == valid), by_part[valid]["blocks"] if valid in by_part else 0, len(features), start)
        for valid in (False, True)
    ]
    return Prepared(stored, features, sets, cuts, start, hot, *parts)


def _matrix(lists: pa.Array, count: int, missing: float) -> np.ndarray:
    """Lists of ``count`` numbers as one row per place in the list, ``missing`` for null."""
    flat = pc.fill_null(lists.flatten(), missing).to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(lists), count).T)


def _bins_of(wide: np.ndarray, ends: list[np.ndarray]) -> np.ndarray:
    """Per feature and row how many cuts lie below the number, -1 where it is missing."""
    found = np.array([np.searchsorted(c, x) for c, x in zip(ends, wide)], dtype=np.int64).reshape(wide.shape)
    return np.where(np.isnan(wide), -1, found)


def _binner(cuts: list[list[float]]) -> Callable[..., Column]:
    """From the features' numbers to their bins: how many cuts lie below; null where the number is missing."""
    ends = [np.array(c, dtype=float) for c in cuts]

    @F.arrow_udf("array<int>")
    def bins(numbers: pa.Array) -> pa.Array:
        found = _bins_of(_matrix(numbers, len(ends), math.nan), ends).astype(np.int32)
        values = pa.array(found.T.ravel(), mask=(found < 0).T.ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(numbers) + 1) * len(ends), pa.int32()), values)

    return bins


# -- blocks of rows ------------------------------------------------------------

BLOCK_SCHEMA = "valid boolean, n int, ones double, row binary, label binary, b binary"


def _bin_type(ends: Sequence[Sequence[float]]) -> np.dtype:
    """The type of bins counted from 1; 0 is a missing value."""
    return np.min_scalar_type(max((len(cuts) + 1 for cuts in ends), default=1))


def _packer(cuts: list[list[float]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (``row``, ``valid``, label, ``__x``) to blocks, each of train rows or of valid rows only."""
    ends, bin_type, block_rows = [np.array(c, dtype=float) for c in cuts], _bin_type(cuts), BLOCK_ROWS
    names = ["valid", "n", "ones", "row", "label", "b"]

    def block(valid: bool, row: np.ndarray, label: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
        held = (row.tobytes(), label.tobytes(), bins.tobytes())
        fields = [pa.array([valid]), pa.array([len(row)], pa.int32()), pa.array([float(label.sum())])]
        return pa.RecordBatch.from_arrays([*fields, *[pa.array([x], pa.binary()) for x in held]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[tuple[np.ndarray, ...]]] = {False: [], True: []}

        def cut(valid: bool, least: int) -> Iterator[pa.RecordBatch]:
            if sum(len(part[0]) for part in held[valid]) < least:
                return
            row, label, bins = (np.concatenate(parts, axis=-1) for parts in zip(*held[valid]))
            whole = len(row) if least == 1 else len(row) // block_rows * block_rows
            for at in range(0, whole, block_rows):
                end = min(at + block_rows, whole)
                yield block(valid, row[at:end], label[at:end], np.ascontiguousarray(bins[:, at:end]))
            held[valid] = [(row[whole:], label[whole:], bins[:, whole:])]

        for batch in batches:
            bins = (_bins_of(_matrix(batch.column("__x"), len(ends), math.nan), ends) + 1).astype(bin_type)
            row, label = batch.column("row").to_numpy(), batch.column(LABEL).to_numpy()
            is_valid = batch.column("valid").to_numpy(zero_copy_only=False).astype(bool)
            for valid in (False, True):
                own = is_valid == valid
                held[valid].append((row[own], label[own], bins[:, own]))
                yield from cut(valid, block_rows)
        for valid in (False, True):
            yield from cut(valid, 1)

    return run


def _write_blocks(blocks: DataFrame, path: str) -> None:
    blocks.write.option("parquet.block.size", BLOCK_GROUP_BYTES).parquet(path)


#: A block as its holder has it: id of the first row, ids of all rows less that one, labels, bins (a row per feature), margins.
_Block = tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _bins_from(held: Any, count: int, n: int) -> np.ndarray:
    return np.frombuffer(held, f"u{max(1, len(held) // max(1, count * n))}").reshape(count, n)


def _kept_blocks(table: DataFrame, blocks: int, count: int, start: float) -> RDD:
    """Stored blocks with the margin before the first round, kept by the executors."""

    def block(stored: tuple[Any, ...]) -> _Block:
        n, ids, labels, bins = stored
        row, label = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.float64)
        first = int(row.min())
        if row.max() - first < 1 << 32:
            row = (row - first).astype(np.uint32)
        else:
            first = 0
        if np.isin(label, (0.0, 1.0)).all():
            label = label.astype(np.uint8)
        return first, row, label, _bins_from(bins, count, n), np.full(n, start)

    stored = table.filter("n > 0").select("n", "row", "label", "b")
    tasks = TASKS_PER_SLOT * table.sparkSession.sparkContext.defaultParallelism
    if blocks > 4 * tasks:
        stored = stored.repartition(max(tasks, blocks // TASK_BLOCKS))
    return stored.rdd.map(block).persist(KEPT)


def _as_row(valid: bool) -> Callable[[_Block], tuple[Any, ...]]:
    """From a block to a row of the stored table, with its margins."""

    def row(block: _Block) -> tuple[Any, ...]:
        first, ids, label, bins, margin = block
        arrays = (ids.astype(np.int64) + first, label.astype(np.float64), bins, margin)
        return valid, len(ids), float(label.sum()), *(a.tobytes() for a in arrays)

    return row


def unpacked(blocks: DataFrame, count: int, start: float) -> DataFrame:
    """Blocks as rows: ``row``, ``valid``, label, ``s`` (empty), ``b``, and the margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "valid", LABEL, "s", "b", MARGIN]
        for whole in batches:
            for block in whole.to_pylist():
                n = block["n"]
                if not n:
                    continue
                bins = _bins_from(block["b"], count, n).astype(np.int32).T.ravel() - 1
                margin = np.frombuffer(block[MARGIN], np.float64) if MARGIN in block else np.full(n, start)
                b = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * count, pa.int32()), pa.array(bins, pa.int32(), mask=bins < 0))
                s = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1), pa.int32()), pa.array([], pa.string()))
                row, label = np.frombuffer(block["row"], np.int64), np.frombuffer(block["label"], np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.full(n, block["valid"])), pa.array(label), s, b, pa.array(margin)], names)

    schema = f"row long, valid boolean, {LABEL} double, s array<string>, b array<int>, {MARGIN} double"
    return blocks.mapInArrow(run, schema)


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def hashed(rows: np.ndarray, *more: int) -> np.ndarray:
    """``xxhash64`` of a long and some ints, as a column of these gives it."""
    h = np.full(len(rows), 42, np.uint64) + _P5 + np.uint64(8)
    h = _mixed(_turned(h ^ (_turned(rows.astype(np.int64).view(np.uint64) * _P2, 31) * _P1), 27) * _P1 + _P4)
    for value in more:
        h = h + _P5 + np.uint64(4)
        h = _mixed(_turned(h ^ (np.full(len(rows), value & 0xFFFFFFFF, np.uint64) * _P1), 23) * _P2 + _P3)
    return h.view(np.int64)


def _summed(parts: RDD) -> np.ndarray:
    """The sum of arrays of one shape; of many, some are added up on the executors first."""
    if parts.getNumPartitions() <= MOST_PARTIAL:
        return reduce(np.add, parts.collect())
    return parts.treeReduce(np.add)


def _distinct(scores: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different scores in order, and how often each is there."""
    if counts is None:
        scores = np.sort(scores)
        counts = np.ones(len(scores), np.int64)
    else:
        order = np.argsort(scores)
        scores, counts = scores[order], counts[order]
    if not len(scores):
        return scores, counts
    first = np.flatnonzero(np.concatenate([[True], scores[1:] != scores[:-1]]))
    return scores[first], np.add.reduceat(counts, first)


def _blocks_auc(valid: RDD, edges: list[float]) -> tuple[float | None, list[float]]:
    """Exact area under the ROC curve, and scores that cut the next round's into ranges of about equal work.

    A task counts its rows per score; the counts are dealt to ranges of the score, each of which
    is ordered by one task. What the ranges send are sums, which are joined in order.
    """
    cuts, places = np.array(edges, dtype=float), RANGE_PLACES

    def counted(blocks: Iterator[_Block]) -> Iterator[tuple[int, tuple[bool, np.ndarray, np.ndarray]]]:
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        for _, _, label, _, margin in blocks:
            for one in (True, False):
                held[one].append(margin[(label == 1) == one])
        for one, parts in held.items():
            if parts:
                scores, counts = _distinct(np.concatenate(parts))
                ends = np.searchsorted(scores, cuts, side="right")
                for place, (s, n) in enumerate(zip(np.split(scores, ends), np.split(counts, ends))):
                    if len(s):
                        yield place, (one, s, n)

    def ordered(found: Iterator[tuple[int, tuple[bool, np.ndarray, np.ndarray]]]) -> Iterator[tuple[Any, ...]]:
        held: dict[int, dict[bool, list[tuple[np.ndarray, np.ndarray]]]] = {}
        for place, (one, s, n) in found:
            held.setdefault(place, {True: [(np.empty(0), np.empty(0, np.int64))], False: [(np.empty(0), np.empty(0, np.int64))]})[one].append((s, n))
        for place, sides in held.items():
            (ones, of_one), (zeros, of_zero) = (_distinct(*(np.concatenate(part) for part in zip(*sides[one]))) for one in (True, False))
            below = np.concatenate([[0], np.cumsum(of_zero)])
            twice = below[np.searchsorted(zeros, ones)] + below[np.searchsorted(zeros, ones, side="right")]
            scores = np.sort(np.concatenate([ones, zeros]))
            at = scores[np.linspace(0, len(scores) - 1, min(places, len(scores))).astype(np.int64)]
            yield place, int(of_one.sum()), int(of_zero.sum()), float((of_one * (twice / 2)).sum()), len(scores), at.tolist()

    ranges = len(edges) + 1
    found = valid.mapPartitions(counted).partitionBy(ranges, lambda place: place).mapPartitions(ordered).collect()  # one row per range
    positives, negatives, wins, weighed = 0, 0, 0.0, []
    for _, ones, zeros, own, size, at in sorted(found):
        wins += own + float(ones) * negatives
        positives += ones
        negatives += zeros
        weighed += [(score, size / len(at)) for score in at]
    sizes = np.cumsum([weight for _, weight in weighed]) if weighed else np.zeros(1)
    slots = TASKS_PER_SLOT * valid.context.defaultParallelism
    wanted = max(min(int(sizes[-1]) // RANGE_SCORES + 1, slots), int(sizes[-1]) // (40 * RANGE_SCORES))
    ends = np.searchsorted(sizes, np.arange(1, wanted) * sizes[-1] / wanted)
    auc = wins / (positives * negatives) if positives and negatives else None
    return auc, sorted({weighed[end][0] for end in ends})


# -- walking trees -------------------------------------------------------------


def _literal(values: Sequence[Any], kind: str) -> str:
    """A constant array in SQL; as ``_array``."""
    return f"cast(split('{','.join(map(str, values))}', ',') AS array<{kind}>)"


def _leaf(nodes: Sequence[Node], root: str, values: str, members: bool) -> str:
    """SQL for the number of the leaf that a row's numbers fall into; one text is planned faster than many calls.

    ``members``: whether there is a column ``members``, the nodes whose set has one of the row's ids.
    """
    base = nodes[0].number
    depth = max(node.depth for node in nodes)
    if not depth:
        return f"cast({root} AS int)"

    def of(kind: str, found: Sequence[Any]) -> str:
        return f"get({_literal(found, kind)}, at - {base})"

    feature, limit = of("int", [node.feature for node in nodes]), of("double", [node.threshold for node in nodes])
    missing = of("int", [int(node.missing_left) for node in nodes])
    left, right = of("int", [node.left for node in nodes]), of("int", [node.right for node in nodes])
    goes_left = f"CASE WHEN get({values}, {feature}) IS NULL THEN {missing} = 1 ELSE get({values}, {feature}) <= {limit} END"
    if members:
        in_set = "array_contains(members, at)"
        goes_left = f"CASE WHEN {of('int', [int(node.is_set) for node in nodes])} = 1 THEN {in_set} ELSE {goes_left} END"
    step = f"CASE WHEN {left} < 0 THEN at WHEN {goes_left} THEN {left} ELSE {right} END"
    return f"aggregate(sequence(1, {depth}), cast({root} AS int), (at, level) -> {step})"


class _Walk:
    """Trees as arrays, through which all rows of a batch go down level by level. Places count from the first node."""

    def __init__(self, nodes: Sequence[Node], by_bin: bool) -> None:
        self.base, self.by_bin = nodes[0].number, by_bin
        self.depth = max(node.depth for node in nodes)
        own = np.arange(len(nodes))
        self.is_set = np.array([node.is_set for node in nodes])
        self.feature = np.array([0 if node.is_set else max(node.feature, 0) for node in nodes])
        self.limit = np.array([node.bin if by_bin else node.threshold for node in nodes])
        self.missing_left = np.array([node.missing_left for node in nodes])
        # a leaf leads to itself
        self.left = np.array([node.left for node in nodes]) - self.base
        self.right = np.array([node.right for node in nodes]) - self.base
        leaf = np.array([node.left < 0 for node in nodes])
        self.left, self.right = np.where(leaf, own, self.left), np.where(leaf, own, self.right)

    def members(self, lists: pa.Array | None) -> np.ndarray | None:
        """Row and place of the nodes whose set has the row's id, as one sorted number each."""
        if lists is None:
            return None
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) - self.base
        known = (place >= 0) & (place < len(self.left))
        return np.sort(row[known] * len(self.left) + place[known])

    def down(self, values: np.ndarray, members: np.ndarray | None, root: int = 0) -> np.ndarray:
        """The place of the leaf that each row falls into. ``values``: a row per feature, as ``_matrix`` gives them."""
        rows = np.arange(values.shape[1])
        at = np.full(len(rows), root)
        if not len(values):
            values = np.zeros((1, len(rows)))
        for _ in range(self.depth):
            value = values[self.feature[at], rows]
            gone = value < 0 if self.by_bin else np.isnan(value)
            goes_left = np.where(gone, self.missing_left[at], value <= self.limit[at])
            if members is not None:
                wanted = rows * len(self.left) + at
                near = np.searchsorted(members, wanted)
                held = members[np.minimum(near, len(members) - 1)] == wanted if len(members) else np.zeros(len(rows), bool)
                goes_left = np.where(self.is_set[at], held, goes_left)
            at = np.where(goes_left, self.left[at], self.right[at])
        return at


#: A node's number, feature and last bin (from 1) of the left side, whether missing values go left, and the children's numbers.
_Step = tuple[int, int, int, bool, int, int]


def _steps(nodes: Sequence[Node], wanted: Sequence[int]) -> list[_Step]:
    """The splits on the way to some nodes, parents first; -1 for a child that leads to none of them."""
    needed, steps = set(wanted), []
    for node in reversed(nodes):
        children = [child if child in needed else -1 for child in (node.left, node.right)]
        if node.left >= 0 and max(children) >= 0:
            needed.add(node.number)
            steps.append((node.number, node.feature, node.bin + 1, node.missing_left, *children))
    return steps[::-1]


def _parted(steps: Sequence[_Step], bins: np.ndarray, held: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Which rows of a block fall into each node that the steps lead to. ``held``: the rows at the roots."""
    for at, feature, last, missing_left, left, right in steps:
        rows = held.pop(at)
        own = bins[feature].take(rows)
        goes_left = own <= last
        if not missing_left:
            goes_left &= own > 0
        if left >= 0:
            held[left] = rows.compress(goes_left)
        if right >= 0:
            held[right] = rows.compress(~goes_left)
    return held


def _number_scorer(nodes: Sequence[Node], count: int, start: float) -> Callable[..., Column]:
    """From the numbers of ``count`` features to the margin by trees without sets: numbers are binned at the trees' own thresholds."""
    split = [node for node in nodes if node.left >= 0]
    ends = [np.array(sorted({node.threshold for node in split if node.feature == i}), dtype=float) for i in range(count)]
    binned = [replace(node, bin=int(np.searchsorted(ends[node.feature], node.threshold))) if node.left >= 0 else node for node in nodes]
    roots = [i for i, node in enumerate(binned) if node.depth == 0]
    trees = [binned[a:b] for a, b in zip(roots, [*roots[1:], len(binned)])]
    walks = [(tree[0].number, _steps(tree, [n.number for n in tree if n.left < 0]), {n.number: n.value for n in tree}) for tree in trees]
    bin_type = _bin_type(ends)

    @F.arrow_udf("double")
    def total(lists: pa.Array) -> pa.Array:
        bins = (_bins_of(_matrix(lists, count, math.nan), ends) + 1).astype(bin_type)
        rows, out = np.arange(len(lists)), np.full(len(lists), start)
        for root, steps, values in walks:
            for number, inside in _parted(steps, bins, {root: rows}).items():
                out[inside] += values[number]
        return pa.array(out)

    return total


def _leaf_values(nodes: Sequence[Node], by_bin: bool, count: int, start: float = 0.0) -> Callable[..., Column]:
    """From the bins or numbers of ``count`` features, and the row's ``members``, to the sum of the values of all trees' leaves."""
    walk = _Walk(nodes, by_bin)
    roots = [i for i, node in enumerate(nodes) if node.depth == 0]
    held = np.array([node.value for node in nodes])

    def total(lists: pa.Array, members: pa.Array | None) -> pa.Array:
        values = _matrix(lists, count, -1 if by_bin else math.nan)
        inside = walk.members(members)
        out = np.full(len(lists), start)
        for root in roots:
            out += held[walk.down(values, inside, root)]
        return pa.array(out)

    @F.arrow_udf("double")
    def without_sets(lists: pa.Array) -> pa.Array:
        return total(lists, None)

    @F.arrow_udf("double")
    def with_sets(lists: pa.Array, members: pa.Array) -> pa.Array:
        return total(lists, members)

    return lambda *columns: without_sets(*columns) if len(columns) == 1 else with_sets(*columns)


#: Drawn rows of a batch: bins, gradient, curvature, and members if there are sets.
_Drawn = tuple[np.ndarray, np.ndarray, np.ndarray, "pa.Array | None"]


def _row_reader(count: int) -> Callable[[pa.RecordBatch], _Drawn]:
    def read(batch: pa.RecordBatch) -> _Drawn:
        members = batch.column("members") if "members" in batch.schema.names else None
        return _matrix(batch.column("b"), count, -1), batch.column("g").to_numpy(), batch.column("h").to_numpy(), members

    return read


def _adder(
    read: Callable[[pa.RecordBatch], _Drawn], walk: _Walk | None, slots: np.ndarray, chosen: list[int], width: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds up gradient, curvature and rows per slot, chosen feature (and one for all rows) and bin (the last: missing).

    ``slots``: of each place of the tree, -1 for none. A task gives out one row per sum that is not empty.
    """
    n_slots = int(slots.max()) + 1
    sizes = (len(chosen) + 1, n_slots, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((2, *sizes)), np.zeros(sizes, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, g, h, members = read(batch)
            slot = np.zeros(len(g), np.int64)
            if walk is not None:
                slot = slots[walk.down(bins, walk.members(members))]
                kept = slot >= 0
                bins, g, h, slot = bins[:, kept], g[kept], h[kept], slot[kept]
            first = slot * width
            for place in range(len(chosen) + 1):
                at = first
                if place < len(chosen):
                    own = bins[chosen[place]]
                    at = first + np.where(own < 0, width - 1, own)
                for k, weights in enumerate((g, h)):
                    sums[k, place] += np.bincount(at, weights, n_slots * width).reshape(n_slots, width)
                counts[place] += np.bincount(at, minlength=n_slots * width).reshape(n_slots, width)
        place, slot, at = np.nonzero(counts)
        found = [slot.astype(np.int32), place.astype(np.int32), at.astype(np.int32), *sums[:, place, slot, at], counts[place, slot, at]]
        if len(place):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["slot", "place", "bin", "g", "h", "n"])

    return run


def _block_adder(
    steps: Sequence[_Step], root: int, wanted: Sequence[int], chosen: list[int], width: int, draw: tuple[int, int, int] | None
) -> Callable[[Iterator[_Block]], Iterator[np.ndarray]]:
    """Adds up gradient, curvature and rows per wanted node, chosen feature (and one for all rows) and bin (the last: missing).

    ``draw``: epoch, seed and bound of the hash of the rows that are drawn. A task gives out one array.
    """
    shape = (3, len(chosen) + 1, len(wanted), width)

    def run(blocks: Iterator[_Block]) -> Iterator[np.ndarray]:
        sums = np.zeros(shape)
        for first, ids, label, bins, margin in blocks:
            rows = np.arange(len(ids))
            if draw is not None:
                rows = rows[(hashed(ids.astype(np.int64) + first, draw[0], draw[1]) & (DRAW - 1)) < draw[2]]
            held = _parted(steps, bins, {root: rows})
            inside = [held[number] for number in wanted]
            rows, ends = np.concatenate(inside), np.cumsum([0, *map(len, inside)])
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-margin.take(rows)))
            g, h = p - label.take(rows), p * (1 - p)
            slot = np.repeat(np.arange(len(inside)) * width, np.diff(ends))
            for place, feature in enumerate(chosen):
                at = bins[feature].take(rows) + slot
                for k, weights in enumerate((g, h, None)):
                    sums[k, place] += np.bincount(at, weights, len(inside) * width).reshape(len(inside), width)
            for i, (a, b) in enumerate(zip(ends, ends[1:])):
                sums[:, -1, i, 0] += g[a:b].sum(), h[a:b].sum(), b - a
        sums[:, :-1] = np.roll(sums[:, :-1], -1, axis=-1)
        yield sums

    return run


def _block_step(steps: Sequence[_Step], root: int, values: dict[int, float]) -> Callable[[Iterator[_Block]], Iterator[_Block]]:
    """Blocks with the values of one more tree added to their margins."""

    def run(blocks: Iterator[_Block]) -> Iterator[_Block]:
        for first, ids, label, bins, margin in blocks:
            margin = margin.copy()
            for number, rows in _parted(steps, bins, {root: np.arange(len(ids))}).items():
                margin[rows] += values[number]
            yield first, ids, label, bins, margin

    return run


def _with_members(rows: DataFrame, ids: DataFrame | None, count: int, hot: Sequence[HotKeys | None]) -> DataFrame:
    """With a column ``members``: the nodes that one of a row's ids is in the set of, looked up once per id, not per node."""
    if ids is None:
        return rows
    columns = rows.columns
    for i in range(count):
        per_id = ids.filter(F.col("feature") == i).groupBy(F.col("id").alias(f"__id{i}")).agg(F.collect_list("node").alias(f"__nodes{i}"))
        rows = spread_join(rows.withColumn(f"__id{i}", F.get("s", i)), per_id, [f"__id{i}"], hot=hot[i])
    found = ", ".join(f"coalesce(__nodes{i}, cast(array() AS array<int>))" for i in range(count))
    return rows.selectExpr(*[f"`{c}`" for c in columns], f"concat({found}) AS members")


# -- growing -------------------------------------------------------------------


def _shrunk(g: Any, l1: float) -> Any:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _worth(g: Any, h: Any, params: BoostParams) -> Any:
    """How much a leaf with these sums lowers the loss, doubled."""
    return _shrunk(g, params.l1) ** 2 / np.maximum(h + params.l2, 1e-300)


class _Split(NamedTuple):
    gain: float
    feature: int
    is_set: bool
    bin: int
    missing_left: bool
    g: float  # sums of the left side
    h: float
    n: int
    ratio: float = 0.0  # of a set its last id
    id: str = ""


def best_number_split(hist: np.ndarray, node: Node, chosen: Sequence[int], sizes: Sequence[int], params: BoostParams) -> _Split | None:
    """The best threshold of one node. ``hist``: per chosen feature and bin (the last: missing) the three sums."""
    best: _Split | None = None
    for place, feature in enumerate(chosen):
        size = sizes[feature]
        present, missing = hist[place, :size], hist[place, -1]
        below = np.cumsum(present, axis=0)
        whole = np.array([node.g, node.h, node.n])
        # missing values on the right; then on the left; the last cut parts present ones from missing ones
        sides = [(below if missing[2] else below[:-1], False)]
        if missing[2]:
            sides.append((below[:-1] + missing, True))
        for left, missing_left in sides:
            right = whole - left
            fits = (np.minimum(left[:, 2], right[:, 2]) >= params.least_rows) & (
                np.minimum(left[:, 1], right[:, 1]) >= params.least_curvature
            )
            if not fits.any():
                continue
            gain = _worth(left[:, 0], left[:, 1], params) + _worth(right[:, 0], right[:, 1], params) - _worth(node.g, node.h, params)
            at = int(np.argmax(np.where(fits, gain, -np.inf)))
            if gain[at] > (best.gain if best else 0.0):
                # without missing values in the node they go where more rows go
                side = missing_left if missing[2] else bool(left[at, 2] > right[at, 2])
                best = _Split(float(gain[at]), feature, False, at, side, float(left[at, 0]), float(left[at, 1]), int(left[at, 2]))
    return best


class _Round:
    """The rows of one round, and the tree that grows on them."""

    def __init__(self, prepared: Prepared, state: State, params: BoostParams) -> None:
        self.prepared, self.state, self.params = prepared, state, params
        self.tree = state.model.trees
        self.base = max((node.number for node in state.model.nodes), default=-1) + 1
        random = np.random.default_rng([params.seed, self.tree])
        total = len(prepared.features) + len(prepared.sets)
        taken = sorted(random.permutation(total)[: max(1, math.ceil(params.feature_share * total))].tolist())
        self.chosen = [i for i in taken if i < len(prepared.features)]
        self.chosen_sets = [i - len(prepared.features) for i in taken if i >= len(prepared.features)]
        self.sizes = [len(cuts) + 1 for cuts in prepared.cuts]
        self.width = max([self.sizes[i] for i in self.chosen], default=1) + 1
        self.nodes: list[Node] = []
        self.splits: dict[int, _Split | None] = {}
        self.hists: dict[int, np.ndarray] = {}
        self.set_tables: list[DataFrame] = []

    def ids(self) -> DataFrame | None:
        out = None
        for table in self.set_tables:
            out = table if out is None else out.unionByName(table)
        return out

    def _drawn(self) -> DataFrame:
        """The drawn train rows of a fit with sets: ``b``, ``s``, gradient, curvature, and ``members`` if the tree has sets."""
        drawn = "NOT valid"
        if self.params.row_every:
            epoch = f"get({_literal([self.tree // self.params.row_every], 'int')}, 0)"
            bound = f"get({_literal([round(self.params.row_share * DRAW)], 'int')}, 0)"
            drawn += f" AND pmod(xxhash64(row, {epoch}, {self.params.seed}), {DRAW}) < {bound}"
        rows = _with_members(self.state.table.filter(drawn), self.ids(), len(self.prepared.sets), self.prepared.hot)
        members = ["members"] if "members" in rows.columns else []
        rows = rows.selectExpr("b", "s", *members, LABEL, f"1 / (1 + exp(-{MARGIN})) AS p")
        return rows.selectExpr("b", "s", *members, f"p - {LABEL} AS g", "p * (1 - p) AS h")

    def _places(self, numbers: Sequence[int]) -> np.ndarray:
        """Of each node of the tree its place among some nodes (the slot), -1 for none."""
        places = {number: i for i, number in enumerate(numbers)}
        return np.array([places.get(node.number, -1) for node in self.nodes] or [0])

    def _slots(self, numbers: Sequence[int]) -> DataFrame:
        """The drawn train rows in one of some nodes: the node's place among them (``slot``), ``s``, gradient, curvature."""
        rows = self._drawn()
        if not self.nodes:
            return rows.selectExpr("0 AS slot", "s", "g", "h")
        walk, slots, count = _Walk(self.nodes, True), self._places(numbers), len(self.prepared.features)

        @F.arrow_udf("int")
        def without_sets(lists: pa.Array) -> pa.Array:
            return pa.array(slots[walk.down(_matrix(lists, count, -1), None)].astype(np.int32))

        @F.arrow_udf("int")
        def with_sets(lists: pa.Array, members: pa.Array) -> pa.Array:
            return pa.array(slots[walk.down(_matrix(lists, count, -1), walk.members(members))].astype(np.int32))

        slot = with_sets("b", "members") if "members" in rows.columns else without_sets("b")
        return rows.select(slot.alias("slot"), "s", "g", "h").filter("slot >= 0")

    def _histograms(self, numbers: Sequence[int]) -> np.ndarray:
        """Per node, chosen feature (and one for all rows) and bin the sums of gradient, curvature and rows."""
        if not self.prepared.sets:
            draw = None
            if self.params.row_every:
                draw = (self.tree // self.params.row_every, self.params.seed, round(self.params.row_share * DRAW))
            add = _block_adder(_steps(self.nodes, numbers), self.base, list(numbers), self.chosen, self.width, draw)
            found = _summed(self.state.train.mapPartitions(add))
            self.state.settle()
            return found.transpose(2, 1, 3, 0)
        walk = _Walk(self.nodes, True) if self.nodes else None
        rows, read = self._drawn().drop("s"), _row_reader(len(self.prepared.features))
        add = _adder(read, walk, self._places(numbers), self.chosen, self.width)
        sums = rows.mapInArrow(add, "slot int, place int, bin int, g double, h double, n long")
        sums = sums.groupBy("slot", "place", "bin").agg(F.expr("sum(g) AS g"), F.expr("sum(h) AS h"), F.expr("sum(n) AS n"))
        table = sums.toArrow()
        hist = np.zeros((len(numbers), len(self.chosen) + 1, self.width, 3))
        slot, place, bins = (table[c].to_numpy() for c in ("slot", "place", "bin"))
        for k, name in enumerate(("g", "h", "n")):
            hist[slot, place, bins, k] = table[name].to_numpy()
        return hist

    def _set_splits(self, asked: Sequence[Node]) -> tuple[dict[int, _Split], DataFrame | None]:
        """Per node the best set of ids of any chosen column, and the sums per id."""
        if not self.chosen_sets or not asked:
            return {}, None
        params = self.params
        picked = f"transform({_literal(self.chosen_sets, 'int')}, i -> get(s, i))"
        rows = self._slots([node.number for node in asked]).selectExpr("slot", "g", "h", f"posexplode({picked}) AS (place, id)")
        sums = rows.filter("id IS NOT NULL").groupBy("slot", "place", "id").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")
        )
        ratio = F.col("g") / (F.col("h") + params.set_smoothing)
        bucket = F.floor((ratio / (1 + F.abs(ratio)) + 1) / 2 * RATIO_BUCKETS)
        sums = cut_lineage(sums.withColumn("ratio", ratio).withColumn("bucket", bucket), "ids")

        # prefix sums in the order of the ratio: within buckets, and over the few buckets of a leaf and column
        upto = Window.partitionBy("slot", "place", "bucket").orderBy("ratio", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = Window.partitionBy("slot", "place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        names = ("g", "h", "n")
        buckets = sums.groupBy("slot", "place", "bucket").agg(*[F.sum(c).alias(c) for c in names])
        starts = buckets.select("slot", "place", "bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b{c}") for c in names])
        left = (
            sums.withColumns({f"i{c}": F.sum(c).over(upto) for c in names})
            .join(F.broadcast(starts), ["slot", "place", "bucket"])
            .select("slot", "place", "ratio", "id", *[(F.col(f"i{c}") + F.col(f"b{c}")).alias(f"l{c}") for c in names])
        )
        whole = {
            c: F.get(_array([getattr(node, c) for node in asked], "double"), F.col("slot")) for c in names
        }

        def worth(g: Column, h: Column) -> Column:
            return F.pow(F.greatest(F.abs(g) - params.l1, F.lit(0.0)), F.lit(2.0)) / F.greatest(h + params.l2, F.lit(1e-300))

        right = {c: whole[c] - F.col(f"l{c}") for c in names}
        fits = (
            (F.least(F.col("ln"), right["n"]) >= params.least_rows)
            & (F.least(F.col("lh"), right["h"]) >= params.least_curvature)
        )
        gain = worth(F.col("lg"), F.col("lh")) + worth(right["g"], right["h"]) - worth(whole["g"], whole["h"])
        ranked = left.filter(fits).select("slot", F.struct((-gain).alias("loss"), "place", "ratio", "id", "lg", "lh", "ln").alias("split"))
        found = {}
        for slot, s in ranked.groupBy("slot").agg(F.min("split")).collect():  # one row per leaf
            if s["loss"] < 0:
                column = self.chosen_sets[s["place"]]
                found[asked[slot].number] = _Split(-s["loss"], column, True, 0, False, s["lg"], s["lh"], s["ln"], s["ratio"], s["id"])
        return found, sums

    def _look_at(self, asked: list[Node]) -> None:
        """Find the best split of each of some nodes."""
        if not self.nodes:
            # the root's own sums come with its histogram
            self.hists[self.base] = self._histograms([self.base])[0]
            g, h, n = self.hists[self.base][-1, 0]
            asked[0].g, asked[0].h, asked[0].n = float(g), float(h), int(n)
        else:
            by_parent: dict[int, list[Node]] = {}
            for node in asked:
                by_parent.setdefault(self.parent[node.number], []).append(node)
            # of two children the smaller is counted, the other is what is left of the parent
            counted = [min(children, key=lambda node: node.n) for children in by_parent.values()]
            hists = self._histograms([node.number for node in counted]) if self.chosen else [None] * len(counted)
            for node, hist in zip(counted, hists):
                self.hists[node.number] = hist
            for (parent, children), small in zip(by_parent.items(), counted):
                for node in children:
                    if node is not small and self.chosen:
                        self.hists[node.number] = self.hists[parent] - self.hists[small.number]
        sets, sums = self._set_splits(asked)
        for node in asked:
            hist = self.hists.get(node.number)
            best = best_number_split(hist, node, self.chosen, self.sizes, self.params) if hist is not None else None
            other = sets.get(node.number)
            if other is not None and (best is None or other.gain > best.gain):
                best = other
            self.splits[node.number] = best
        self.pending = (asked, sums)

    def _keep_sets(self, opened: Sequence[int]) -> None:
        """Store the ids of the chosen sides of the sets among the nodes that are opened next."""
        asked, sums = self.pending
        chosen = [
            (slot, self.chosen_sets.index(split.feature), split.ratio, split.id, node.number, split.feature)
            for slot, node in enumerate(asked)
            if node.number in opened and (split := self.splits[node.number]) is not None and split.is_set
        ]
        if not chosen:
            return
        spark = sums.sparkSession
        table = spark.createDataFrame(chosen, "slot int, place int, last double, last_id string, node int, feature int")
        side = (F.col("ratio") < F.col("last")) | ((F.col("ratio") == F.col("last")) & (F.col("id") <= F.col("last_id")))
        inside = sums.join(F.broadcast(table), ["slot", "place"]).filter(side).select("node", "feature", "id")
        self.set_tables.append(cut_lineage(inside, "sets"))

    def _order(self) -> tuple[list[int], list[int]]:
        """The nodes that are split, best first, as far as gains are known; and those of them without children yet."""
        by_number = {node.number: node for node in self.nodes}
        heap = [(-split.gain, number) for number, split in self.splits.items() if number == self.base and split]
        done, ahead = [], []
        while heap and len(done) < self.params.leaves - 1:
            _, number = heapq.heappop(heap)
            done.append(number)
            node = by_number[number]
            if node.left < 0:
                ahead.append(number)
                continue
            for child in (node.left, node.right):
                if (split := self.splits.get(child)) is not None:
                    heapq.heappush(heap, (-split.gain, child))
        return done, ahead

    def grow(self) -> list[Node]:
        """The tree's nodes. Children come behind their parents."""
        params = self.params
        self.parent: dict[int, int] = {}
        root = Node(self.base, self.tree, 0, 0.0, 0.0, 0)
        self._look_at([root])
        self.nodes = [root]
        waiting: dict[int, tuple[list[Node], DataFrame | None]] = {self.base: self.pending}
        while True:
            done, ahead = self._order()
            if not ahead:
                break
            # sets are stored from the sums that were found with the node
            for pending in {id(waiting[number]): waiting[number] for number in ahead}.values():
                self.pending = pending
                self._keep_sets([number for number in ahead if waiting[number] is pending])
            opened = []
            for number in ahead:
                node, split = self.nodes[number - self.base], self.splits[number]
                self._apply(node, split)
                for g, h, n, side in (
                    (split.g, split.h, split.n, "left"), (node.g - split.g, node.h - split.h, node.n - split.n, "right")
                ):
                    child = Node(self.base + len(self.nodes), self.tree, node.depth + 1, g, h, n)
                    setattr(node, side, child.number)
                    self.parent[child.number] = number
                    self.nodes.append(child)
                    opened.append(child)
            splittable = [
                node for node in opened
                if node.n >= 2 * params.least_rows and (not params.max_depth or node.depth < params.max_depth)
            ]
            if splittable:
                self._look_at(splittable)
                waiting |= {node.number: self.pending for node in splittable}
        return self._pruned(done)

    def _apply(self, node: Node, split: _Split) -> None:
        node.feature, node.is_set, node.bin, node.missing_left = split.feature, split.is_set, split.bin, split.missing_left
        node.gain = split.gain
        if not split.is_set:
            cuts = self.prepared.cuts[split.feature]
            node.threshold = cuts[split.bin] if split.bin < len(cuts) else math.inf

    def _pruned(self, done: list[int]) -> list[Node]:
        """The nodes that came up, with their values; the others were looked at in vain."""
        kept, split = [self.base], set(done)
        for number in kept:
            if number in split:
                node = self.nodes[number - self.base]
                kept += [node.left, node.right]
        out = []
        for number in sorted(kept):
            node = self.nodes[number - self.base]
            value = -self.params.rate * float(_shrunk(node.g, self.params.l1)) / max(node.h + self.params.l2, 1e-300)
            if number in split:
                out.append(replace(node, value=value))
            else:
                out.append(replace(node, left=-1, right=-1, feature=-1, is_set=False, gain=0.0, value=value))
        self.nodes = out
        return out

    def finish(self) -> State:
        """The state after this round: margins stored anew, those of the last round deleted."""
        nodes, state = renumbered(self.nodes), self.state
        if not self.prepared.sets:
            return self._finish_blocks(nodes)
        spark = state.table.sparkSession
        ids = self.ids()
        if ids is not None:
            numbers = {old.number: new.number for old, new in zip(self.nodes, nodes) if old.is_set}
            if numbers:
                table = spark.createDataFrame(list(numbers.items()), "node int, __new int")
                ids = ids.join(F.broadcast(table), "node").select(F.col("__new").alias("node"), "feature", "id")
            else:
                ids = None
        path, count = scratch_path(spark, "margins"), len(self.prepared.features)
        rows = _with_members(state.table, ids, len(self.prepared.sets), self.prepared.hot)
        value = _leaf_values(nodes, True, count)("b", *(["members"] if ids is not None else []))
        kept = [c if c != MARGIN else (F.col(MARGIN) + value).alias(MARGIN) for c in state.table.columns]
        rows.select(*kept).write.parquet(path)
        stored = spark.read.schema(state.table.schema).parquet(path)
        if state.path:
            discard(spark, state.path)
        if ids is not None:
            ids = ids if state.model.ids is None else state.model.ids.unionByName(ids)
            ids = cut_lineage(ids, "model-sets")
        model = replace(state.model, nodes=[*state.model.nodes, *nodes], ids=ids if ids is not None else state.model.ids)
        auc = _known(bucketed_auc(stored.filter("valid"), MARGIN, LABEL, 1 / (1 + F.exp(-F.col(MARGIN)))))
        return State(model, stored, path, [*state.history, auc])

    def _finish_blocks(self, nodes: list[Node]) -> State:
        state, values = self.state, {node.number: node.value for node in nodes if node.left < 0}
        step = _block_step(_steps(nodes, list(values)), nodes[0].number, values)
        train, valid = (part.mapPartitions(step).persist(KEPT) for part in (state.train, state.valid))
        saved, outdated = state.saved, state.outdated
        if (self.tree + 1) % CHECKPOINT_ROUNDS == 0:
            saved, outdated = [train, valid], [*outdated, *saved]
            for part in saved:
                part.checkpoint()
        auc, edges = _blocks_auc(valid, state.edges)
        model = replace(state.model, nodes=[*state.model.nodes, *nodes])
        # those of the start are other fits' as well; train blocks are made by the next round's first pass
        made_from = []
        if state.history:
            made_from = [state.train]
            state.valid.unpersist()
        return State(model, None, None, [*state.history, _known(auc)], train, valid, edges, made_from, saved, outdated)


def _known(auc: float | None) -> float:
    if auc is None:
        raise ValueError("the valid rows must have both labels")
    return auc


def renumbered(nodes: Sequence[Node]) -> list[Node]:
    """The same nodes with numbers that have no gaps."""
    base = nodes[0].number
    numbers = {node.number: base + i for i, node in enumerate(nodes)} | {-1: -1}
    return [replace(node, number=numbers[node.number], left=numbers[node.left], right=numbers[node.right]) for node in nodes]


def fit(
    prepared: Prepared, params: BoostParams | None = None, max_rounds: int = 300, patience: int = 20, state: State | None = None
) -> Fitted:
    """Boosted trees up to the round with the best AUC on the valid rows.

    Ends when ``patience`` rounds brought no gain, or after ``max_rounds`` rounds in all. With
    ``state`` it goes on from an earlier fit on the same rows, as if that had not ended; a fit's
    state can be gone on from once.
    """
    params = params or BoostParams()
    if state is None:
        table = prepared.table.withColumn(MARGIN, F.lit(prepared.start)) if prepared.sets else None
        state = State(Boosted(prepared.features, prepared.sets, prepared.start, []), table, None, [], prepared.train, prepared.valid)
    while len(state.history) < max_rounds and not stopped(state.history, patience):
        step = _Round(prepared, state, params)
        step.grow()
        state = step.finish()
    best = best_round(state.history)
    return Fitted(state.model.first_trees(best), state.history[best - 1], best, state)


def best_round(history: Sequence[float]) -> int:
    """The first round with the largest AUC, from 1."""
    return max(range(len(history)), key=lambda i: (history[i], -i)) + 1


def stopped(history: Sequence[float], patience: int) -> bool:
    """Whether so many rounds have passed without a gain."""
    return bool(history) and len(history) - best_round(history) >= patience


# -- using a model -------------------------------------------------------------


def margins(model: Boosted, rows: DataFrame) -> DataFrame:
    """``rows`` with the sum of the trees' values (``margin``); needs the model's feature and id columns."""
    features = F.array(*[_number(c) for c in model.features]) if model.features else F.array().cast("array<double>")
    wide = rows.withColumns({"__x": features, "s": F.array(*[F.col(c).cast("string") for c in model.sets]) if model.sets else F.array()})
    if not model.nodes:
        return rows.withColumn(MARGIN, F.lit(model.start))
    if model.ids is None and sum(depths_of(model.nodes)) > STEPS_IN_SQL:
        scorer = _number_scorer(model.nodes, len(model.features), model.start)
        return wide.select(*[F.col(f"`{c}`") for c in rows.columns], scorer("__x").alias(MARGIN))
    wide = _with_members(wide, model.ids, len(model.sets), [None] * len(model.sets))
    first = [node.number for node in model.nodes if node.depth == 0]
    leaf = _leaf(model.nodes, "root", "__x", model.ids is not None)
    value = f"get({_literal([node.value for node in model.nodes], 'double')}, {leaf} - {model.nodes[0].number})"
    total = f"aggregate({_literal(first, 'int')}, cast({model.start!r} AS double), (total, root) -> total + {value})"
    return wide.selectExpr(*[f"`{c}`" for c in rows.columns], f"{total} AS {MARGIN}")


def depths_of(nodes: Sequence[Node]) -> list[int]:
    """The depth of each tree."""
    out: dict[int, int] = {}
    for node in nodes:
        out[node.tree] = max(out.get(node.tree, 0), node.depth)
    return list(out.values())


def score(model: Boosted, rows: DataFrame) -> DataFrame:
    """``rows`` with the probability of label 1 (``score``)."""
    return margins(model, rows).withColumn(SCORE, 1 / (1 + F.exp(-F.col(MARGIN)))).drop(MARGIN)


def importance(spark: SparkSession, model: Boosted) -> DataFrame:
    """Per feature its share of the gain, and how often it is split on (``weight``)."""
    names = [*model.features, *model.sets]
    gain, weight = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0)
    for node in model.nodes:
        if node.left >= 0:
            name = model.sets[node.feature] if node.is_set else model.features[node.feature]
            gain[name] += node.gain
            weight[name] += 1
    total = sum(gain.values()) or 1.0
    rows = [(name, gain[name] / total, float(weight[name])) for name in names]
    return spark.createDataFrame(rows, "feature string, gain double, weight double")
