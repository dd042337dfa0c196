"""Sharding by K-d tree: nodes split at weighted medians along their widest metadata dimension.

The rows to place are groups of equal texts, weighted by their bytes. Each dimension of a
group becomes one whole number, the scaled value in the upper bits and a hash of the group
below, so groups with equal values can still be told apart and no group is cut. A median is
found by counting: bytes per bin of the interval that holds it, bin by bin narrower, for all
nodes of a level at once. Only those sums are shuffled; rows stay where they are. Everything
runs as DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import NumericType

from furlong.llm.common import cut_lineage, join_sized
from furlong.operators.skew import row_numbers

VALUE_BITS, HASH_BITS = 31, 31
BINS = 4096
#: Share of a node's bytes that a cut may lie from its aim before another dimension is tried.
TOLERANCE = 0.01
#: Most shards; what the driver holds per level is a few numbers for each.
MAX_SHARDS = 65_536


class Cut(NamedTuple):
    """Where one node is split: keys of ``dim`` from ``at`` on go to its second half."""

    dim: int
    at: int
    off: int  # bytes from the aim


def _common_bytes(docs: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Per text column the number of bytes with which all its values begin: those that the least and the largest share."""
    if not columns:
        return {}
    found = docs.agg(*[f(F.col(c).cast("string")).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    out = {}
    for i, c in enumerate(columns):
        low, high = ((found[f"{f}{i}"] or "").encode() for f in ("min", "max"))
        out[c] = next((at for at, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
    return out


def _ordinal(column: str, numeric: bool, skipped: int = 0) -> Column:
    """A dimension as a double: numbers as they are, text by six bytes behind the ``skipped`` ones that all values share; null below all."""
    if numeric:
        value = F.col(column).cast("double")
        return F.when(F.isnan(value), F.lit(None)).otherwise(value)
    head = F.substring(F.encode(F.col(column).cast("string"), "UTF-8"), skipped + 1, 6)
    padded = F.rpad(F.hex(head), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


def text_groups(docs: DataFrame, id_column: str, text: str, dims: Sequence[str]) -> DataFrame:
    """Narrow rows: id, ``size``, ``crc``, ``hash`` of the text, and each dimension as ``d0``, ``d1``..."""
    kinds = {f.name: isinstance(f.dataType, NumericType) for f in docs.schema}
    skipped = _common_bytes(docs, [d for d in dims if not kinds[d]])
    return docs.select(
        F.col(id_column).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"),
        *[_ordinal(d, kinds[d], skipped.get(d, 0)).alias(f"d{i}") for i, d in enumerate(dims)],
    )


def _keyed(groups: DataFrame, n_dims: int) -> DataFrame:
    """Each dimension as a whole number ``k<i>``, spread over its range in the whole table."""
    ends = groups.agg(*[f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)]).first()
    top = (1 << VALUE_BITS) - 1
    low_bits = F.pmod(F.xxhash64("hash", "crc", "size"), F.lit(1 << HASH_BITS))
    keys = []
    for i in range(n_dims):
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        if low is None or high == low:
            value = F.lit(0).cast("long")
        else:
            value = F.coalesce(F.floor((F.col(f"d{i}") - low) / (high - low) * (top - 1)).cast("long") + 1, F.lit(0))
        keys.append((value * (1 << HASH_BITS) + low_bits).alias(f"k{i}"))
    return groups.select("size", "crc", "hash", "weight", "n", *keys, F.lit(0).cast("int").alias("node"))


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of numbers as a literal in the plan."""
    names = ", ".join(schema.split())
    if not rows:
        return spark.sql(f"SELECT * FROM VALUES ({', '.join(['0L'] * len(schema.split()))}) AS t({names})").limit(0)
    values = ", ".join("(" + ", ".join(f"{int(v)}L" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def _medians(groups: DataFrame, wanted: dict[int, tuple[int, int, int, int]]) -> dict[int, Cut]:
    """For each node (its dimension, lowest and highest key, bytes to put before the cut) the best cut."""
    spark = groups.sparkSession
    # node: interval [low, high] that holds the cut, bytes below it
    open_nodes = {node: [dim, low, high, 0, aim] for node, (dim, low, high, aim) in wanted.items()}
    cuts: dict[int, Cut] = {}
    n_keys = sum(c.startswith("k") for c in groups.columns)
    while open_nodes:
        rows = [(node, *state, (state[2] - state[1]) // BINS + 1) for node, state in open_nodes.items()]
        state = F.broadcast(_table(spark, rows, "node dim low high below aim step"))
        key = F.element_at(F.array(*[F.col(f"k{i}") for i in range(n_keys)]), (F.col("dim") + 1).cast("int"))
        inside = groups.join(state, "node").withColumn("key", key).filter("key BETWEEN low AND high")
        place = ((F.col("key") - F.col("low")) / F.col("step")).cast("long").alias("place")
        bins = inside.groupBy("node", "below", "aim", place).agg(F.sum("weight").alias("weight"))
        upto = F.col("below") + F.sum("weight").over(Window.partitionBy("node").orderBy("place"))  # at most BINS + 1 rows a node
        hit = bins.withColumn("upto", upto).filter("upto >= aim AND upto - weight < aim")
        hits = {r["node"]: r for r in hit.select("node", "place", "weight", "upto").collect()}
        for node in list(open_nodes):
            dim, low, high, below, aim = open_nodes.pop(node)
            if node not in hits:  # nothing goes before the cut
                cuts[node] = Cut(dim, low, 0)
                continue
            step = (high - low) // BINS + 1
            begin = low + hits[node]["place"] * step
            upto_here = hits[node]["upto"]
            before = upto_here - hits[node]["weight"]
            if step == 1:  # one group, before or behind the cut
                first, second = aim - before, upto_here - aim
                cuts[node] = Cut(dim, begin, first) if first <= second else Cut(dim, begin + 1, second)
            else:
                open_nodes[node] = [dim, begin, min(begin + step - 1, high), before, aim]
    return cuts


def kd_leaves(groups: DataFrame, n_dims: int, shards: int) -> DataFrame:
    """``groups`` with the number of the leaf of each, as ``node``; leaves hold nearly equal weight."""
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"shards must lie between 1 and {MAX_SHARDS}")
    placed = cut_lineage(_keyed(groups, n_dims), "kd")
    leaves = {0: shards}  # a node is numbered by its first leaf
    while any(n > 1 for n in leaves.values()):
        extents = placed.groupBy("node").agg(
            F.sum("weight").alias("weight"),
            *[f(f"k{i}").alias(f"{f.__name__}{i}") for i in range(n_dims) for f in (F.min, F.max)],
        )
        rows = {r["node"]: r for r in extents.collect() if leaves[r["node"]] > 1}  # one per node
        best: dict[int, Cut] = {}
        for turn in range(n_dims):
            wanted = {}
            for node, r in rows.items():
                if node in best and best[node].off <= TOLERANCE * r["weight"]:
                    continue
                spread = sorted(range(n_dims), key=lambda i: (r[f"min{i}"] - r[f"max{i}"], i))
                aim = r["weight"] * (leaves[node] // 2) // leaves[node]
                wanted[node] = (spread[turn], r[f"min{spread[turn]}"], r[f"max{spread[turn]}"], aim)
            for node, cut in _medians(placed, wanted).items():
                if node not in best or cut.off < best[node].off:
                    best[node] = cut
        table = F.broadcast(
            _table(placed.sparkSession, [(n, c.dim, c.at, leaves[n] // 2) for n, c in best.items()], "node dim at first")
        )
        key = F.element_at(F.array(*[F.col(f"k{i}") for i in range(n_dims)]), (F.col("dim") + 1).cast("int"))
        further = F.when(F.col("at").isNotNull() & (key >= F.col("at")), F.col("first")).otherwise(F.lit(0))
        placed = placed.join(table, "node", "left").withColumn("node", (F.col("node") + further).cast("int"))
        placed = cut_lineage(placed.drop("dim", "at", "first"), "kd")
        leaves = {
            n: k
            for node, count in leaves.items()
            for n, k in ([(node, count // 2), (node + count // 2, count - count // 2)] if count > 1 else [(node, count)])
        }
    return placed


def shard_by_bytes(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    dims: Sequence[str] = ("n_chars", "source", "lang", "doc_id"),
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the text's bytes plus one. Shards hold nearly equal bytes (law ``bytes``, so
    ``grown_shard`` is null); rows with equal texts stay together, null counts as empty. With
    ``target_bytes`` the number of shards follows from the table's bytes. ``slot`` counts the
    rows of a shard from 0 in order of the id. Null values of a dimension come first, a null
    id gets a place as any other; rows that repeat an id have places of their own. A group
    of equal texts larger than a shard makes that shard larger. An empty table has no rows.
    """
    rows = cut_lineage(text_groups(docs, id_column, text, dims), "sized")
    groups = cut_lineage(
        rows.groupBy("size", "crc", "hash").agg(
            F.sum("size").alias("weight"), F.count("*").alias("n"), *[F.min(f"d{i}").alias(f"d{i}") for i in range(len(dims))]
        ),
        "texts",
    )
    if target_bytes is not None:
        total = groups.agg(F.sum("weight")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    leaves = kd_leaves(groups, len(dims), shards).select("size", "crc", "hash", "n", F.col("node").alias("shard"))
    placed = join_sized(rows.select("id", "size", "crc", "hash"), leaves, ["size", "crc", "hash"], "n")
    numbered = cut_lineage(row_numbers(placed, ["shard", "id", "crc", "hash"], "number"), "numbered")
    starts = F.broadcast(numbered.groupBy("shard").agg(F.min("number").alias("start")))  # one row per shard
    return numbered.join(starts, "shard").select(
        F.col("id").alias(id_column),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("number") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
