"""SimHash near-dedup with a hierarchical index over fingerprints in Gray order.

A fingerprint's bits fall into ``max_bits + 2`` blocks. Fingerprints within ``max_bits``
agree in at least two whole blocks, so each pair of blocks is a mask, and the pattern
under it is an upper node that linked fingerprints share. Under an upper node the
fingerprints lie in Gray order; runs of neighbours form nodes that keep the bits their
members share and that no node above has, and a search adds up the differences on the
way down and leaves a node as soon as they exceed the bound, or as soon as all its
members are known to be in the searcher's group. Only one link per member and node comes
out, never all pairs.

An upper node with too many members is divided by further blocks of its free bits; as
these become fewer, the number of different members is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from furlong.llm.common import cut_lineage, free_names, is_empty, join_sized, row_keys, whole_groups
from furlong.llm.components import components

SEED = 42
FAN = 16
#: Fingerprints under one upper node that a task takes; beyond that the node is divided.
NODE_LIMIT = 2_000_000


def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash of the word shingles of a text that is already in lower case."""
    words = text.split()  # bytes: at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    if len(words) <= width:
        spans = [(0, len(joined))]
    else:
        spans = zip((ends - lengths).tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[start : start + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return int(value)


def fingerprints(docs: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """``id``, ``k0``, ``k1`` (``row_keys``) and ``fp`` (the 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.ascii_lower(pc.fill_null(batch.column(3), "")).cast(pa.large_binary())
            marks = np.array([fingerprint(t.as_py(), width) for t in lowered], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(marks, pa.int64())], names=["id", "k0", "k1", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.select("id", *row_keys("id", "text"), "text").mapInArrow(run, "id long, k0 long, k1 long, fp long")


def _block_masks(free: int, blocks: int) -> list[int]:
    """The set bits of ``free`` in so many blocks of neighbours, as masks."""
    bits = [i for i in range(64) if free >> i & 1]
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << i for i in bits[lo:hi]) for lo, hi in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _gray_rank(column: str) -> Column:
    rank = F.col(column)
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank


def _joined_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the smallest position of its group) after linking a[i] with b[i]."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:  # to the root
            above = labels[labels]
            if np.array_equal(above, labels):
                break
            labels = above


def _tree(marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the top: each node's shared bits, and its pattern under them."""
    shared, pattern = np.full(len(marks), ~np.uint64(0)), marks
    levels = [(shared, pattern)]
    while len(pattern) > FAN:
        starts = np.arange(0, len(pattern), FAN)
        ones = np.bitwise_and.reduceat(pattern & shared, starts)
        anything = np.bitwise_or.reduceat(pattern | ~shared, starts)
        shared = np.bitwise_and.reduceat(shared, starts) & ~(ones ^ anything)
        pattern = ones & shared
        levels.append((shared, pattern))
    return levels[::-1]


def node_labels(
    marks: np.ndarray, max_bits: int, block: int = 4096, starts: np.ndarray | None = None, seen_nodes: list[int] | None = None
) -> np.ndarray:
    """For fingerprints under one or more upper nodes the first position of each one's group.

    ``starts``: where each upper node begins; within it the fingerprints lie in Gray order.
    One tree of shared patterns spans them all, and a search stays under its own upper node.
    ``seen_nodes`` gets how many nodes were looked at, and how many of them were left out
    because of their differences, or because all their members were known to be linked.
    """
    total = len(marks)
    starts = np.zeros(1, np.int64) if starts is None else starts
    stop = np.repeat(np.append(starts[1:], total), np.diff(np.append(starts, total)))
    labels = np.arange(total)
    levels = _tree(marks)
    spans = [FAN ** (len(levels) - 1 - depth) for depth in range(len(levels))]
    counts = np.zeros(3, np.int64)
    for start in range(0, total, block):
        asking = np.arange(start, min(start + block, total))
        who = np.repeat(asking, len(levels[0][1]))
        node = np.tile(np.arange(len(levels[0][1])), len(asking))
        seen, above = np.zeros(len(who), np.int64), np.zeros(len(who), np.uint64)
        for depth, (shared, pattern) in enumerate(levels):
            # later rows under the same upper node only: a pair is met once
            own = (node * spans[depth] < stop[who]) & ((node + 1) * spans[depth] > who + 1)
            who, node, seen, above = who[own], node[own], seen[own], above[own]
            new_bits = shared[node] & ~above
            seen = seen + np.bitwise_count((marks[who] ^ pattern[node]) & new_bits)
            begins = np.arange(0, total, spans[depth])
            least, most = np.minimum.reduceat(labels, begins), np.maximum.reduceat(labels, begins)
            known = (least[node] == labels[who]) & (most[node] == labels[who])
            near = seen <= max_bits
            counts += len(node), np.count_nonzero(~near), np.count_nonzero(near & known)
            keep = near & ~known
            who, node, seen, above = who[keep], node[keep], seen[keep], shared[node[keep]]
            if depth + 1 < len(levels):
                width = len(levels[depth + 1][1])
                who, seen, above = (np.repeat(x, FAN) for x in (who, seen, above))
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                inside = node < width
                who, node, seen, above = who[inside], node[inside], seen[inside], above[inside]
        labels = _joined_labels(labels, who, node)
    if seen_nodes is not None:
        seen_nodes[:] = counts.tolist()
    return labels


def _links_under_nodes(max_bits: int):
    """Links of each member to the first member of its group, for the upper nodes with two members or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["mask", "pattern"], least=20_000):
            mask, pattern = table.column("mask").to_numpy(), table.column("pattern").to_numpy()
            heads = np.flatnonzero(np.concatenate([[True], (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])]))
            sizes = np.diff(np.append(heads, len(mask)))
            several = np.repeat(sizes > 1, sizes)
            ids, marks = table.column("id").to_numpy()[several], table.column("fp").to_numpy()[several].view(np.uint64)
            sizes = sizes[sizes > 1]
            if not len(sizes):
                continue
            labels = node_labels(marks, max_bits, starts=np.cumsum(sizes) - sizes)
            linked = np.flatnonzero(labels != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[linked]), pa.array(ids[labels[linked]])], names=["a", "b"]
            )

    return run


def near_links(nodes: DataFrame, max_bits: int, node_limit: int | None = None) -> DataFrame:
    """Links (``a``, ``b``) that join all ids whose fingerprints differ in at most ``max_bits`` bits.

    ``nodes`` has one row per different fingerprint (``fp``) with an ``id``; a written table.
    """
    limit = node_limit or NODE_LIMIT
    blocks = _block_masks((1 << 64) - 1, max_bits + 2)
    masks = [x | y for x, y in combinations(blocks, 2)]
    rows = _under(nodes, masks)
    found: DataFrame | None = None
    left = nodes.count() > limit  # no node can be larger than all
    while True:
        if left:
            sizes = rows.groupBy("mask", "pattern").agg(F.count("*").alias("rows")).filter(F.col("rows") > limit)
            large = cut_lineage(sizes, "large-nodes")
            left = not is_empty(large)
        fitting = rows.join(large.select("mask", "pattern"), ["mask", "pattern"], "left_anti") if left else rows
        placed = (
            fitting.repartition("mask", "pattern")
            .withColumn("rank", _gray_rank("fp"))
            .sortWithinPartitions("mask", "pattern", "rank")
            .select("mask", "pattern", "fp", "id")
        )
        links = cut_lineage(placed.mapInArrow(_links_under_nodes(max_bits), "a long, b long"), "near")
        found = links if found is None else found.unionByName(links)
        if not left:
            return found
        rows = cut_lineage(_divided(join_sized(rows, large, ["mask", "pattern"], "rows"), max_bits), "divided")


def _under(nodes: DataFrame, masks: list[int]) -> DataFrame:
    one_each = F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
    return nodes.select("id", "fp", one_each.alias("mask")).withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))


def _divided(rows: DataFrame, max_bits: int) -> DataFrame:
    """Members of large nodes under wider masks: of ``max_bits + 1`` blocks of the free bits at least one agrees too."""
    wider: dict[int, list[int]] = {}
    for (mask,) in rows.select("mask").distinct().collect():  # as many as there are masks, whatever the input
        held = mask % (1 << 64)
        wider[mask] = [_signed(held | block) for block in _block_masks(~held % (1 << 64), max_bits + 1)]
    choice = F.create_map(*[F.lit(x) for m, more in wider.items() for x in (m, more)])
    return (
        rows.withColumn("mask", F.explode(choice[F.col("mask")]))
        .withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        .distinct()
    )


def _grouped(docs: DataFrame, id_column: str, text: str, width: int, max_bits: int) -> DataFrame:
    """Per row ``id``, ``k0``, ``k1``, ``fp`` and ``component_id``."""
    marks = cut_lineage(fingerprints(docs, id_column, text, width), "fingerprints")
    nodes = cut_lineage(marks.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "nodes")
    # fingerprints are what is linked: rows may lack an id, or share one
    found = components(near_links(nodes.select("fp", F.col("fp").alias("id")), max_bits), "a", "b")
    grouped = nodes.join(found.select(F.col("id").alias("fp"), "component"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "first", "n"
    )
    grouped = cut_lineage(grouped, "members")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("members"))
    named = join_sized(grouped, cut_lineage(least, "components"), ["component"], "members")
    named = cut_lineage(named.select("fp", "component_id", "n"), "groups")
    return join_sized(marks, named, ["fp"], "n").select("id", "k0", "k1", "fp", "component_id")


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (hex), ``component_id``.

    Texts are read in lower case (A-Z only), null as empty; a text with fewer than
    ``width`` words is one shingle, and one without words has fingerprint zero, which
    links like any other. ``component_id`` is the smallest id that can be reached over
    links of at most ``max_bits`` bits, null where none of the rows reached has one. Rows
    that repeat an id, with the same text or another, and rows without an id have a row each
    and link like others. Other columns are neither read nor returned.
    """
    return _grouped(docs, id_column, text, width, max_bits).select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_copies(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, max_bits: int = 4
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group, all their columns.

    A row without an id stays only where no row of its group has one.
    """
    groups = _grouped(docs, id_column, text, width, max_bits)
    gone = groups.filter(~F.col("id").eqNullSafe(F.col("component_id"))).select("k0", "k1").distinct()
    keys = dict(zip(free_names(docs, 2), row_keys(F.col(id_column).cast("long"), F.col(text))))
    marked = docs.withColumns(keys)
    same = [marked[name] == gone[key] for name, key in zip(keys, ("k0", "k1"))]
    return marked.join(gone.hint("merge"), same, "left_anti").drop(*keys)
