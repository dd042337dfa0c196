"""Removal of repeated byte strings by suffix arrays over shards of candidate text.

A string can recur only where its anchor does (``anchors``), so text without a recurring
anchor is settled by one shuffle of hashes. Stretches of text around recurring anchors are
gathered by anchor: equal stretches are settled by counting them, and the different ones
that share an anchor go to one shard, where induced sorting gives the suffix array and the
permuted common prefixes tell which of their strings are equal. Equal strings have equal
anchors, so no pair of them is in different shards. An anchor with very many different
stretches around it is split by the strings themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from furlong.llm.anchors import Hashes, anchor_runs, combined, covered, digests
from furlong.llm.common import cut_lineage, join_sized, pieces, row_keys, text_bytes, whole_groups
from furlong.llm.suffix_array import long_matches, suffix_array

RUN = 32
CHUNK_BYTES = 1024 * 1024
#: Rows of about 300 bytes that a shard gathers before it is sorted.
SHARD_ROWS = 6_000
#: Different stretches around one anchor that go to one shard.
MOST_STRETCHES = 20_000
SEPARATOR = 0xFF  # no byte of UTF-8
#: A stretch: hash of its anchor, digest of its bytes, windows in it, bytes before the anchor.
KEYS = ["anchor", "v0", "v1", "windows", "off"]
KEY_TYPES = "anchor long, v0 long, v1 long, windows int, off int"
#: A row, by two hashes of its id and text: it may lack an id, or share one with another text.
ROW = ["k0", "k1"]
PLACE = "struct<k0: long, k1: long, at: long>"


def _stretches(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Neighbouring (row, begin, end) to look at together; a long text comes in parts that overlap."""
    held: list[tuple[int, int, int]] = []
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if held and end - held[0][1] > CHUNK_BYTES:
            yield held
            held = []
        if end - begin <= CHUNK_BYTES:
            held.append((row, begin, end))
            continue
        for part in range(begin, end - length + 1, CHUNK_BYTES):
            yield [(row, part, min(part + CHUNK_BYTES + length - 1, end))]
    if held:
        yield held


def _anchored(length: int):
    """Per batch the anchors of all windows, with a digest of the stretch that their windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            for some in pieces(batch, "text", 4 * CHUNK_BYTES):
                keys = [some.column(name).to_numpy() for name in ROW]
                whole, offsets = text_bytes(some.column("text"))
                for group in _stretches(offsets, length):
                    rows, begins, ends = (np.array(x, np.int64) for x in zip(*group))
                    base = begins[0]
                    data = whole[base : ends[-1]]
                    if len(data) < length:
                        continue
                    hashes = Hashes(data)
                    at = np.arange(len(data) - RUN + 1)
                    run_hashes = hashes.of(at, at + RUN)
                    runs = anchor_runs(run_hashes, begins - base, ends - base, RUN, length)
                    if not len(runs.anchor):
                        continue
                    row = rows[runs.text]
                    found.append(
                        (
                            run_hashes[runs.anchor].view(np.int64), *digests(data, runs.first, runs.last + length),
                            (runs.last - runs.first + 1).astype(np.int32), (runs.anchor - runs.first).astype(np.int32),
                            *[key[row] for key in keys], runs.first + base - offsets[row],
                        )
                    )
            if found:
                columns = [np.concatenate(x) for x in zip(*found)]
                yield combined(dict(zip(KEYS, columns)), dict(zip([*ROW, "at"], columns[len(KEYS) :])))

    return run


def _cut_out(length: int):
    """The stretches wanted of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, "text", 4 * CHUNK_BYTES):
                out = []
                for text, wanted in zip(some.column(0).cast(pa.large_binary()).to_pylist(), some.column(1).to_pylist()):
                    for w in wanted:
                        at = w.pop("at")
                        out.append({**w, "bytes": (text or b"")[at : at + w["windows"] + length - 1]})
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema(
        [("anchor", pa.int64()), ("v0", pa.int64()), ("v1", pa.int64()), ("windows", pa.int32()), ("off", pa.int32()),
         ("c", pa.int64()), ("members", pa.int64()), ("bytes", pa.binary())]
    )
    return run


def _runs_of(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"begin": int(b), "end": int(e)} for b, e in zip(edges[::2], edges[1::2])]


def _sorted_shards(length: int):
    """Which windows of each stretch occur in another one of the shard, as ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor"], least=SHARD_ROWS):
            texts = table.column("bytes").to_pylist()
            windows = table.column("windows").to_numpy()
            sizes = np.array([len(t) for t in texts])
            begins = np.cumsum(np.concatenate([[0], sizes[:-1] + 1]))
            data = np.frombuffer(bytes([SEPARATOR]).join(texts), np.uint8)
            fits = np.minimum(windows, np.maximum(sizes - length + 1, 0))
            starts = np.repeat(begins - np.concatenate([[0], np.cumsum(fits)[:-1]]), fits) + np.arange(fits.sum())
            array = suffix_array(np.append(data.astype(np.int64) + 1, 0))
            flags = np.split(long_matches(data, array, starts, length), np.cumsum(fits)[:-1])
            hit = [i for i, f in enumerate(flags) if f.any()]
            rows = table.select([*KEYS, "c"]).take(pa.array(hit, pa.int64())).combine_chunks()
            ranges = pa.array([_runs_of(flags[i]) for i in hit], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))
            for out in rows.append_column("ranges", ranges).combine_chunks().to_batches():
                yield out

    return run


def _windows(length: int):
    """Every window of each stretch, by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                some = batch.slice(start, 2000)
                texts = some.column(some.schema.get_field_index("bytes")).to_pylist()
                sizes = np.array([len(t) for t in texts])
                windows = np.minimum(some.column(some.schema.get_field_index("windows")).to_numpy(), np.maximum(sizes - length + 1, 0))
                place = np.arange(windows.sum()) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
                at = place + np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), windows)
                two = [pa.array(half) for half in digests(b"".join(texts), at, at + length)]
                keys = some.select([*KEYS, "c"]).take(pa.array(np.repeat(np.arange(len(texts)), windows)))
                yield pa.RecordBatch.from_arrays(
                    [*keys.columns, *two, pa.array(place.astype(np.int32))], names=[*KEYS, "c", "w0", "w1", "place"]
                )

    return run


def _removed(length: int):
    """What is left of each text, and what was removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (text or "").encode()
                gone = covered([(s["begin"], s["end"]) for s in spans or []])
                edges = [0, *[x for span in gone for x in span], len(data)]
                kept.append(b"".join(data[b:e] for b, e in zip(edges[::2], edges[1::2])))
                n_bytes.append(len(data))
                n_spans.append(len(gone))
                n_removed.append(sum(e - b for b, e in gone))
            counts = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def repeated_spans(rows: DataFrame, length: int, most: int | None = None) -> DataFrame:
    """Per row (``ROW``) the byte spans (``begin``, ``end``) of all strings of ``length`` bytes that occur elsewhere too.

    ``rows``: ``ROW`` and ``text``.
    """
    anchored = rows.mapInArrow(_anchored(length), f"{KEY_TYPES}, n long, place {PLACE}, more array<{PLACE}>")
    anchored = cut_lineage(anchored, "anchored")
    # only counts are shuffled by anchor; where it occurs stays with the row
    counts = anchored.groupBy("anchor").agg(F.sum("n").alias("n"), F.count("*").alias("size")).filter("n > 1").drop("n")
    found = join_sized(anchored, cut_lineage(counts, "recurring"), ["anchor"], "size")
    found = cut_lineage(found.select(*anchored.columns), "found")

    stretches = cut_lineage(
        found.groupBy(*KEYS).agg(F.sum("n").alias("c"), F.count("*").alias("rows"), F.min("place").alias("place")), "stretches"
    )
    groups = stretches.groupBy("anchor").agg(F.count("*").alias("members")).filter("members > 1")
    groups = cut_lineage(groups.withColumn("size", F.col("members")), "anchors")
    several = join_sized(stretches, groups, ["anchor"], "size")
    wanted = several.groupBy(*[F.col(f"place.{k}").alias(k) for k in ROW]).agg(  # at most what one text holds
        F.collect_list(F.struct(*KEYS, "c", "members", F.col("place.at").alias("at"))).alias("wanted")
    )
    cut_out = rows.join(wanted.hint("merge"), ROW).select("text", "wanted").mapInArrow(
        _cut_out(length), f"{KEY_TYPES}, c long, members long, bytes binary"
    )
    cut_out = cut_lineage(cut_out, "candidates")
    limit = most or MOST_STRETCHES
    ranges = "array<struct<begin: int, end: int>>"
    placed = cut_out.filter(F.col("members") <= limit).repartition("anchor").sortWithinPartitions("anchor")
    by_arrays = placed.mapInArrow(_sorted_shards(length), f"{KEY_TYPES}, c long, ranges {ranges}")

    windows = cut_out.filter(F.col("members") > limit).mapInArrow(
        _windows(length), f"{KEY_TYPES}, c long, w0 long, w1 long, place int"
    )
    windows = cut_lineage(windows, "windows")
    equal = cut_lineage(windows.groupBy("w0", "w1").agg(F.count("*").alias("size")).filter("size > 1"), "equal")
    one_each = F.struct(F.col("place").alias("begin"), (F.col("place") + 1).alias("end"))
    by_windows = join_sized(windows, equal, ["w0", "w1"], "size").groupBy(*KEYS, "c").agg(F.collect_list(one_each).alias("ranges"))

    whole = F.array(F.struct(F.lit(0).alias("begin"), F.col("windows").alias("end")))
    compared = by_arrays.unionByName(by_windows).filter("c = 1").select(*KEYS, F.lit(1).cast("long").alias("rows"), "ranges")
    settled = stretches.filter("c > 1").select(*KEYS, "rows", whole.alias("ranges"))
    verdicts = cut_lineage(settled.unionByName(compared), "verdicts")
    hits = join_sized(found, verdicts, KEYS, "rows")
    places = F.coalesce("more", F.array("place"))
    spans = hits.select(F.explode(places).alias("p"), "ranges").select("p.*", F.explode("ranges").alias("r"))
    return spans.select(
        *ROW, (F.col("at") + F.col("r.begin")).alias("begin"), (F.col("at") + F.col("r.end") - 1 + length).alias("end")
    )


def drop_repeats(
    docs: DataFrame, length: int = 200, id_column: str = "doc_id", text: str = "text", most: int | None = None
) -> DataFrame:
    """Id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (bytes) of every row of ``docs``.

    Removed is every byte covered by a string of ``length`` bytes that starts anywhere else
    too, in the same text or another; strings never cross texts, and overlaps count. Null
    counts as empty; a text shorter than ``length`` stays. Rows without an id, and rows that
    repeat one with the same text or another, count as texts of their own. ``n_spans``:
    maximal removed runs. Equality is that of 128-bit digests for strings in equal stretches,
    that of the bytes otherwise. Other columns are neither read nor returned.
    """
    if length < 2 * RUN:
        raise ValueError(f"strings must have {2 * RUN} bytes at least")
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(*row_keys("id", "text"), "id", "text")
    # a text this short can't repeat a string; such rows, a third of all perhaps, stay where they are
    long_enough = F.octet_length("text") >= length
    candidates = rows.filter(long_enough)
    spans = repeated_spans(candidates.drop("id"), length, most).groupBy(*ROW).agg(
        F.collect_set(F.struct("begin", "end")).alias("spans")  # at most what one text holds
    )
    joined = candidates.join(spans.hint("merge"), ROW, "left").select("id", "text", "spans")
    short = rows.filter(~long_enough).select("id", "text", F.lit(None).cast("array<struct<begin: long, end: long>>").alias("spans"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    out = joined.mapInArrow(_removed(length), schema).unionByName(short.mapInArrow(_removed(length), schema))
    return out.withColumnRenamed("id", id_column)
