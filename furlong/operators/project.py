"""Projections, filters, concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by dictionary. Every old name must be there."""
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"columns to rename are missing: {missing}")
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns. Every name must be there."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns to drop are missing: {missing}")
    return df.drop(*names)


def add_literals(df: DataFrame, values: dict[str, str | None]) -> DataFrame:
    """Attach one text value per new column; None becomes a text null."""
    return df.withColumns({name: F.lit(value).cast("string") for name, value in values.items()})


def join_text(*parts: Column | str) -> Column:
    """Concatenate; null when any part is null."""
    return F.concat(*parts)


def is_first(rank: Column | str) -> Column:
    """1.0 for rank one, else 0.0."""
    column = F.col(rank) if isinstance(rank, str) else rank
    return (column == 1).cast("double")


def drop_containing(df: DataFrame, column: str, text: str) -> DataFrame:
    """Drop rows whose text holds the given words; rows without text go too."""
    return df.filter(~F.col(column).contains(text))


def drop_listed(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Drop rows whose value is in the list; rows without a value go too."""
    return df.filter(~F.col(column).isin(*values))


def between_dates(df: DataFrame, column: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Inclusive range on yyyyMMdd text; either end may be open."""
    if first is not None:
        df = df.filter(F.col(column) >= first)
    if last is not None:
        df = df.filter(F.col(column) <= last)
    return df


def between_days(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows whose timestamp or date lies on a day from ``first`` to ``last`` (yyyyMMdd), both included.

    The bounds are compared with the column itself, so the filter reaches the scan.
    """
    kind = df.schema[column].dataType
    start, end = (F.to_date(F.lit(day), "yyyyMMdd") for day in (first, last))
    return df.filter((F.col(column) >= start.cast(kind)) & (F.col(column) < F.date_add(end, 1).cast(kind)))


def after_date(df: DataFrame, column: str, date: str) -> DataFrame:
    return df.filter(F.col(column) > date)


def concat_rows(frames: list[DataFrame]) -> DataFrame:
    """Stack frames of one schema, duplicates kept. Differing schemas are an error."""
    if not frames:
        raise ValueError("nothing to concatenate")
    expected = [(f.name, f.dataType) for f in frames[0].schema]
    for i, frame in enumerate(frames[1:], start=1):
        found = [(f.name, f.dataType) for f in frame.schema]
        if found != expected:
            raise ValueError(f"schema of frame {i} differs: {found} instead of {expected}")
    return reduce(DataFrame.unionByName, frames)


def explode_together(df: DataFrame, lists: list[str]) -> DataFrame:
    """Explode list columns in step. Lists of unequal length fail the job.

    An empty or missing list gives one row of nulls.
    """
    first, *others = lists
    same = F.lit(True)
    for other in others:
        same = same & F.size(F.coalesce(F.col(first), F.array())).eqNullSafe(
            F.size(F.coalesce(F.col(other), F.array()))
        )
    checked = F.when(same, F.arrays_zip(*lists)).otherwise(
        F.raise_error(F.lit(f"lists differ in length: {', '.join(lists)}"))
    )
    kept = [c for c in df.columns if c not in lists]
    out = df.select(*kept, F.explode_outer(checked).alias("__item"))
    return out.select(
        *[F.col(f"__item.{c}").alias(c) if c in lists else F.col(c) for c in df.columns]
    )
