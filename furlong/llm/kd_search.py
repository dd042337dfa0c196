"""Exact top-k search by inner product over KD-trees, one per shard.

A shard's vectors are split at medians of the coordinate they spread most in, until a
leaf is small; every node keeps the tight box around its vectors. For a query, no vector
in a box can score more than the box's corner that suits the query best. Nodes are
visited best bound first, and the search of a shard ends at the first bound below the
query's k-th score so far, which goes on from shard to shard.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from furlong.llm.common import cut_lineage
from furlong.session import scratch_path

SHARD_ROWS = 4096
LEAF_ROWS = 64
#: Rows that one task searches, at least.
TASK_ROWS = 8192
#: Queries that are sent to all tasks at once, about: with 64 numbers each, 2 MB.
QUERY_BLOCK = 4096
SCALE = 1024
EXACT = 2.0**53


def build_tree(values: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows in the tree, and its nodes: (begin, end, left child or -1); the right one follows the left."""
    order = np.arange(len(values))
    nodes = [[0, len(values), -1]]
    at = 0
    while at < len(nodes):
        begin, end, _ = nodes[at]
        if end - begin > leaf_rows:
            rows = order[begin:end]
            here = values[rows]
            widest = int(np.argmax(here.max(axis=0) - here.min(axis=0)))
            middle = (end - begin) // 2
            order[begin:end] = rows[np.argpartition(here[:, widest], middle)]
            nodes[at][2] = len(nodes)
            nodes += [[begin, begin + middle, -1], [begin + middle, end, -1]]
        at += 1
    return order, np.array(nodes, np.int64)


def _scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (whole numbers as doubles) of the rows whose vectors take part."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"))
    # scores of larger components would not fit a long
    most = F.sqrt(F.lit(2.0**62) / F.greatest(F.size("v"), F.lit(1))) / SCALE
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > most))
    return rows.filter("id IS NOT NULL AND v IS NOT NULL").filter(~bad).filter(F.size("v") > 0).select("id", _scaled(F.col("v")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def index_shards(rows: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per shard: vectors in tree order, nodes and boxes. Shards hold vectors of one length."""

    def shard(ids: np.ndarray, values: np.ndarray) -> dict:
        order, nodes = build_tree(values, leaf_rows)
        values = values[order]
        low = np.array([values[b:e].min(axis=0) for b, e, _ in nodes])
        high = np.array([values[b:e].max(axis=0) for b, e, _ in nodes])
        return {
            "width": values.shape[1], "ids": ids[order].tolist(), "vectors": values.tobytes(),
            "nodes": nodes.tobytes(), "low": low.tobytes(), "high": high.tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            widths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(widths):
                some = batch.filter(pa.array(widths == width))
                own = held.setdefault(int(width), [])
                own.append((some.column(0).to_numpy(), _matrix(some.column(1), int(width))))
                while sum(len(x) for x, _ in own) >= shard_rows:
                    ids, values = (np.concatenate(x) for x in zip(*own))
                    yield pa.RecordBatch.from_pylist([shard(ids[:shard_rows], values[:shard_rows])], schema=arrow)
                    own[:] = [(ids[shard_rows:], values[shard_rows:])]
        for own in held.values():
            ids, values = (np.concatenate(x) for x in zip(*own))
            if len(ids):
                yield pa.RecordBatch.from_pylist([shard(ids, values)], schema=arrow)

    arrow = pa.schema(
        [("width", pa.int32()), ("ids", pa.list_(pa.int64())), *[(n, pa.binary()) for n in ("vectors", "nodes", "low", "high")]]
    )
    return rows.mapInArrow(run, "width int, ids array<long>, vectors binary, nodes binary, low binary, high binary")


class Best:
    """The k best of each query so far: higher scores first, then smaller ids."""

    def __init__(self, k: int, queries: int) -> None:
        self.k = k
        self.ids = [np.empty(0, np.int64)] * queries
        self.scores: list[np.ndarray] = [np.empty(0)] * queries
        self.kth = [-math.inf] * queries

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.kth[query]
        if not fit.any():
            return
        ids = np.concatenate([self.ids[query], ids[fit]])
        scores = np.concatenate([self.scores[query], scores[fit]])
        first = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[first], scores[first]
        if len(first) == self.k:
            self.kth[query] = scores[first[-1]]


def _exactly(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether inner products of such rows are whole numbers that a double holds exactly."""
    return a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < EXACT


def _whole(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def search_shard(best: Best, asking: np.ndarray, queries: np.ndarray, own_ids: np.ndarray, shard: dict) -> None:
    """Visit one shard's tree for the queries numbered ``asking``."""
    width = shard["width"]
    ids = np.asarray(shard["ids"], np.int64)
    values = np.frombuffer(shard["vectors"]).reshape(-1, width)
    nodes = np.frombuffer(shard["nodes"], np.int64).reshape(-1, 3)
    low, high = (np.frombuffer(shard[n]).reshape(-1, width) for n in ("low", "high"))
    if not _exactly(values, queries):
        values, low, high, queries = (_whole(x) for x in (values, low, high, queries))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    plan = nodes.tolist()
    for row, query in enumerate(asking):
        bound = bounds[row].tolist()
        heap = [(-bound[0], 0)]
        while heap:
            worst, node = heapq.heappop(heap)
            if -worst < best.kth[query]:
                break
            begin, end, left = plan[node]
            if left < 0:
                scores, found = values[begin:end] @ queries[row], ids[begin:end]
                other = found != own_ids[row]
                best.add(query, found[other], scores[other])
            else:
                for child in (left, left + 1):
                    if bound[child] >= best.kth[query]:
                        heapq.heappush(heap, (-bound[child], child))


FOUND = "query_id long, vec_id long, score long"


def _search(index: DataFrame, block: list[tuple[int, list[float]]], k: int, path: str) -> None:
    """Add the k best of each query of a block in the shards of each task to the files at ``path``."""
    by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for width in {len(v) for _, v in block}:
        some = [i for i, (_, v) in enumerate(block) if len(v) == width]
        by_width[width] = (np.array(some), np.array([block[i][1] for i in some]), np.array([block[i][0] for i in some]))
    sent = index.sparkSession.sparkContext.broadcast(by_width)  # a block's size is bounded
    names = [query_id for query_id, _ in block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, len(names))
        for batch in batches:
            for shard in batch.to_pylist():
                if shard["width"] in sent.value:
                    search_shard(best, *sent.value[shard["width"]], shard)
        lengths = [len(x) for x in best.ids]
        if sum(lengths):
            scores = [int(x) for found in best.scores for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(names, np.int64), lengths)),
                    pa.array(np.concatenate(best.ids)),
                    pa.array(scores, pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    index.mapInArrow(run, FOUND).write.mode("append").parquet(path)
    sent.destroy()


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest inner product for each row of ``queries``.

    Components become floor(1024 * x). Rows with the query's own id are no candidates; ties
    go to the smaller id. Vectors that are null, empty, or hold null or non-finite components
    take no part, and vectors of another length than the query's are no candidates. A row that
    repeats an id is a candidate of its own; a query that repeats an id is asked once, by its
    smallest vector. Fewer candidates than ``k`` give fewer rows. Returns ``query_id``,
    ``rank``, ``vec_id``, ``score``. Other columns are neither read nor returned.

    The index is built once and written. Queries go to all tasks in blocks of bounded size.
    """
    rows = usable(vectors, id_column, vector)
    asked = cut_lineage(usable(queries, id_column, vector).groupBy("id").agg(F.min("v").alias("v")), "queries")
    total, n_queries = rows.count(), asked.count()
    spark = vectors.sparkSession
    tasks = max(1, -(-total // (SHARD_ROWS * 16)), min(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS)))
    index = cut_lineage(index_shards(rows.repartition(tasks)), "kd-index")
    blocks = max(1, -(-n_queries // QUERY_BLOCK))
    path = scratch_path(spark, "found")  # of all blocks, so no plan grows with their number
    for number in range(blocks):
        here = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)
        block = [(r["id"], r["v"]) for r in here.collect()]  # about QUERY_BLOCK rows
        _search(index, block, k, path)
    found = spark.read.schema(FOUND).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
