"""Exact dedup by MSD radix partitioning: texts part by successive bytes until groups are single or ended.

The length and the first bytes are the first digit, counted over the whole table.
Texts that share it are gathered in slices of bounded size and parted there by further
bytes, digits doubling in width; equality is equality of all bytes, no digest decides.
Equal texts leave one row per batch before anything is shuffled, and one per slice
after, so a text with any number of copies fills no task. Groups that needed several
slices go round again with a longer first digit, which ends when the digit is the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from furlong.llm.common import cut_lineage, discard_tables, free_names, is_empty, join_sized, row_keys, whole_groups

FIRST_DIGIT = 16
#: Bytes of text that one slice of a group holds, about.
SLICE_BYTES = 16 * 1024 * 1024
LEAST_PER_SLICE = 8


def folded(column: pa.Array) -> pa.Array:
    """Texts as bytes, A-Z in lower case, null as empty."""
    return pc.ascii_lower(pc.fill_null(column, "")).cast(pa.large_binary())


def equal_groups(texts: list[bytes], members: list[int]) -> Iterator[list[int]]:
    """Lists of two or more members with equal texts, by radix digits of doubling width."""
    open_groups = [(members, 0)]
    while open_groups:
        rows, at = open_groups.pop()
        width = max(8, at)
        parts: dict[bytes, list[int]] = {}
        for row in rows:
            parts.setdefault(texts[row][at : at + width], []).append(row)
        for digit, part in parts.items():
            if len(part) < 2:
                continue
            if len(digit) < width:  # ended
                yield part
            else:
                open_groups.append((part, at + width))


def _by_length(texts: list[bytes]) -> Iterator[list[int]]:
    by_length: dict[int, list[int]] = {}
    for i, text in enumerate(texts):
        by_length.setdefault(len(text), []).append(i)
    for members in by_length.values():
        if len(members) > 1:
            yield from equal_groups(texts, members)


def _largest(group: list[int], ids: list[int | None]) -> int:
    """The member with the largest id; one without an id comes before all others."""
    return max(group, key=lambda i: (ids[i] is not None, ids[i] or 0, i))


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's representative within its batch, its first digit, its hash for the result; a representative's text."""
    for batch in batches:
        rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        column = folded(batch.column(2)).cast(pa.binary())
        texts = column.to_pylist()
        reps, counts = list(rows), [1] * len(rows)
        for group in _by_length(texts):
            rep = _largest(group, ids)
            for i in group:
                reps[i], counts[i] = rows[rep], 0
            counts[rep] = len(group)
        lasting = pa.array(n > 0 for n in counts)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(i) for i in (0, 1, 3, 4)],
                pa.array(reps, pa.int64()),
                pa.array(counts, pa.int64()),
                pa.array(map(len, texts), pa.int64()),
                pa.array([text[:FIRST_DIGIT] for text in texts], pa.binary()),
                pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string()),
                pc.if_else(lasting, column, pa.scalar(None, pa.binary())),
            ],
            names=["row", "id", "k0", "k1", "rep", "n", "length", "digit", "sha256", "text"],
        )


def _within_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The representative of each row within its slice of a group; its text where the group has further slices."""
    for table in whole_groups(batches, ["length", "digit", "slice"], least=1000):
        rows, ids, n, texts = (table.column(c).to_pylist() for c in ("row", "id", "n", "text"))
        length, digit, part, slices = (table.column(c).to_pylist() for c in ("length", "digit", "slice", "slices"))
        groups: dict[tuple, list[int]] = {}
        for i in range(len(rows)):
            groups.setdefault((length[i], digit[i], part[i]), []).append(i)
        reps, rep_ids, first = list(rows), list(ids), [True] * len(rows)
        for members in groups.values():
            for group in equal_groups(texts, members):
                rep = _largest(group, ids)
                total = sum(n[i] for i in group)
                for i in group:
                    reps[i], rep_ids[i], first[i], n[i] = rows[rep], ids[rep], i == rep, total
        more = [s > 1 for s in slices]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(reps, pa.int64()),
                pa.array(rep_ids, pa.int64()),
                pa.array(n, pa.int64()),
                pa.array(first, pa.bool_()),
                pa.array(length, pa.int64()),
                pa.array(more, pa.bool_()),
                pa.array([text if m and f else None for text, m, f in zip(texts, more, first)], pa.binary()),
            ],
            names=["row", "id", "rep", "rep_id", "n", "first", "length", "more", "text"],
        )


def _sliced(counted: DataFrame) -> DataFrame:
    """Groups of two or more rows, with the number of slices their text needs."""
    per_slice = F.greatest(F.lit(LEAST_PER_SLICE), F.floor(F.lit(SLICE_BYTES) / (F.col("length") + 64)))
    return counted.filter("rows > 1").withColumn("slices", F.ceil(F.col("rows") / per_slice).cast("long"))


def _slice_of() -> Column:
    return F.pmod(F.xxhash64("row"), F.col("slices")).alias("slice")


def _grouped(docs: DataFrame, id_column: str, text: str) -> tuple[DataFrame, list[DataFrame]]:
    """Per row ``id``, ``k0``, ``k1`` (``row_keys``), ``keep_id``, ``group_size``, ``kept``, ``sha256``; and the stored tables with texts."""
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    source = source.select(F.monotonically_increasing_id().alias("row"), "id", "text", *row_keys("id", "text"))
    schema = "row long, id long, k0 long, k1 long, rep long, n long, length long, digit binary, sha256 string, text binary"
    # written with the numbers of its rows, so these hold from here on
    rows = cut_lineage(source.mapInArrow(_first_pass, schema), "radix")

    reps = rows.filter("n > 0").select("row", "id", "n", "length", "digit", "text")
    groups = cut_lineage(_sliced(rows.filter("n > 0").groupBy("length", "digit").agg(F.count("*").alias("rows"))), "digits")
    open_rows = join_sized(reps, groups, ["length", "digit"], "rows")

    links: list[DataFrame] = []
    width = FIRST_DIGIT
    out_schema = "row long, id long, rep long, rep_id long, n long, first boolean, length long, more boolean, text binary"
    while True:
        placed = (
            open_rows.withColumn("slice", _slice_of())
            .repartition("length", "digit", "slice")
            .sortWithinPartitions("length", "digit", "slice")
            .select("row", "id", "n", "length", "digit", "slice", "slices", "text")
        )
        done = cut_lineage(placed.mapInArrow(_within_slices, out_schema), "slices")
        links.append(done)
        further = done.filter("more AND first").select("row", "id", "n", "length", "text")
        if is_empty(further):
            break
        width *= 8
        open_rows = further.withColumn("digit", F.substring("text", 1, width))
        groups = cut_lineage(_sliced(open_rows.groupBy("length", "digit").agg(F.count("*").alias("rows"))), "digits")
        # rows that no other shares this digit with are as they were
        open_rows = join_sized(open_rows, groups, ["length", "digit"], "rows")

    # from the last round back: what a representative was joined to holds for its rows
    last = links[-1].select("row", F.col("rep_id").alias("keep_id"), F.col("n").alias("group_size"))
    for done in reversed(links[:-1]):
        step = done.select("row", "rep", "rep_id", "n").join(
            last.select(F.col("row").alias("rep"), "keep_id", "group_size"), "rep", "left"
        )
        last = step.select(
            "row", _known("keep_id").otherwise(F.col("rep_id")).alias("keep_id"), F.coalesce("group_size", "n").alias("group_size")
        )
    alone = rows.filter("n > 0").select("row", "id", "n")
    found = alone.join(last, "row", "left").select(
        F.col("row").alias("rep"),
        _known("keep_id").otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", "n").alias("group_size"),
    )
    result = rows.select("id", "k0", "k1", "rep", "sha256").join(found, "rep").select(
        "id", "k0", "k1", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha256"
    )
    return result, [rows, *links]


def _known(column: str) -> Column:
    """A column of a left join's right side, null or not, where there was a match."""
    return F.when(F.col("group_size").isNotNull(), F.col(column))


def equal_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal
    texts the largest id stays. All rows count: those that repeat an id, with the same text or
    another, and those without an id. All rows with the largest id are marked as kept; a row
    without an id is kept only where no equal text has one. Other columns are neither read nor
    returned.
    """
    return _grouped(docs, id_column, text)[0].select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


def drop_equal_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``equal_texts`` keeps, all their columns."""
    grouped, texts = _grouped(docs, id_column, text)
    gone = cut_lineage(grouped.filter("NOT kept").select("k0", "k1").distinct(), "gone")
    discard_tables(texts)  # which rows go is known now
    keys = dict(zip(free_names(docs, 2), row_keys(F.col(id_column).cast("long"), F.col(text))))
    marked = docs.withColumns(keys)
    same = [marked[name] == gone[key] for name, key in zip(keys, ("k0", "k1"))]
    return marked.join(gone.hint("merge"), same, "left_anti").drop(*keys)
