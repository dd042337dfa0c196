"""What the operators of this package share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from furlong.session import cut_lineage, discard_tables

#: Rows and bytes handed to Python at once; the workers' memory follows from these.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}
#: Groups with more than this share of all rows (so fewer than this many) are joined by broadcast.
HOT_SHARE = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Bound what is handed to Python at once; changes no result."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def free_names(df: DataFrame, count: int) -> list[str]:
    """Names that no column of the table has, whatever their case."""
    taken = {name.lower() for name in df.columns}
    return [name for name in (f"__{i}" for i in range(count + len(taken))) if name not in taken][:count]


def row_keys(id_column: str | Column, text: str | Column) -> list[Column]:
    """``k0`` and ``k1``, two hashes that stand for a row with this id and text.

    Rows may lack an id, or share one with another text; rows that agree in both are the same to
    the operators.
    """
    return [F.xxhash64(id_column, text).alias("k0"), F.xxhash64(F.lit(7), text, id_column).alias("k1")]


def join_sized(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """Join rows to a table that has one row per key and, in ``size``, how many rows the key has.

    Keys with more than a thousandth of all rows, at most a thousand of them, are
    broadcast, so their rows stay where they are; no other key can fill a task. Both
    tables are read more than once: give written ones. ``size`` is not returned.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) > total // HOT_SHARE
    hot, rest = F.broadcast(groups.filter(is_hot).drop(size)), groups.filter(~is_hot).drop(size)
    apart = rows.join(F.broadcast(groups.filter(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(apart.join(rest, keys, how))


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker and kept for its later tasks.

    The library's functions come to a worker by value, with globals of their own for every
    task, so what is kept in a global is made anew each time.
    """
    kept = sys.modules.setdefault("furlong_kept", ModuleType("furlong_kept")).__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Recent:
    """Results by short text, kept for later batches: a bounded number, those asked for last the longest.

    Results of longer texts are held for the batch that needs them.
    """

    def __init__(self, limit: int, longest: int) -> None:
        self.limit, self.longest = limit, longest
        self.now: dict[str, Any] = {}
        self.older: dict[str, Any] = {}
        self.passing: list[str] = []

    def of(self, texts: set[str], make: Callable[[list[str]], Iterable[Any]]) -> dict[str, Any]:
        """A dictionary with the results of all ``texts``; ``make`` is given those that are not kept."""
        for text in self.passing:
            del self.now[text]
        if len(self.now) > self.limit:
            self.now, self.older = {}, self.now
        again = (texts & self.older.keys()) - self.now.keys()
        self.now.update(zip(again, map(self.older.__getitem__, again)))
        new = list(texts - self.now.keys())
        self.now.update(zip(new, make(new)))
        self.passing = [text for text in new if len(text) > self.longest]
        return self.now


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text after the other, and where each begins (and the end)."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with at most ``limit`` bytes of text, or a single longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held + n > limit and i > start:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield batch.slice(start)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from batches whose equal keys are neighbours.

    A group's rows are held together, so the caller bounds its groups. ``least``: rows
    to gather before a table is given out.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]
        cut = batch.num_rows  # where the last group of this batch begins
        while cut and all(batch.column(k)[cut - 1].as_py() == v for k, v in zip(keys, last)):
            cut -= 1
        same = bool(held) and all(held[-1].column(k)[held[-1].num_rows - 1].as_py() == v for k, v in zip(keys, last))
        if cut == 0 and same:
            held.append(batch)
            count += batch.num_rows
            continue
        if cut:
            held.append(batch.slice(0, cut))
            count += cut
            tail = batch.slice(cut)
        else:
            tail = batch
        if count >= least:
            yield pa.Table.from_batches(held)
            held, count = [], 0
        held.append(tail)
        count += tail.num_rows
    if held:
        yield pa.Table.from_batches(held)


__all__ = [
    "Recent", "cut_lineage", "discard_tables", "free_names", "is_empty", "join_sized", "load", "once_per_worker", "pieces", "prepare", "row_keys",
    "text_bytes", "whole_groups",
]
