"""Joins of rows to ids, payouts, means, and between page tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from furlong.functions.text import trim_space
from furlong.operators.skew import HotKeys, spread_join

_COPIES = "__copies"


def attach_ids(
    rows: DataFrame,
    ids: DataFrame,
    scope: list[str],
    name: str,
    dedupe: bool = False,
    one_page_scope: bool = False,
) -> DataFrame:
    """Left join of rows to extracted ids on a trimmed name within a scope.

    A name that occurs several times in ``ids`` repeats the row as often. Equal id
    rows travel as one row with a count, so the join itself sees each id once and
    rows are repeated only after it. With ``dedupe`` each name keeps one id, the
    smallest, and no row is repeated.

    ``one_page_scope`` says that a scope is a single page. Its rows then fit one task,
    so neither a search for hot keys nor the count is needed.
    """
    hot = HotKeys({}, 0) if one_page_scope else None
    keys = [*scope, name]
    values = [c for c in ids.columns if c not in keys]
    rows = rows.withColumn(name, trim_space(name))
    ids = ids.withColumn(name, trim_space(name))
    if dedupe:
        if len(values) == 1:
            one = ids.groupBy(*keys).agg(F.min(values[0]).alias(values[0]))
        else:
            one = ids.groupBy(*keys).agg(F.min(F.struct(*values)).alias("__one")).select(*keys, "__one.*")
        return spread_join(rows, one, keys, hot=hot)
    if one_page_scope:
        return rows.join(ids, keys, "left").select(*rows.columns, *values)
    counted = ids.groupBy(*keys, *values).agg(F.count(F.lit(1)).alias(_COPIES))
    joined = spread_join(rows, counted, keys, hot=hot)
    copies = F.coalesce(F.col(_COPIES), F.lit(1)).cast("int")
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), copies))).drop("__copy", _COPIES)


def combine_payouts(win: DataFrame, place: DataFrame, keys: list[str], reference_keys: bool = False) -> DataFrame:
    """Full outer join of win and place payouts.

    The key is taken from whichever side has it. ``reference_keys=True`` keeps the key
    of the win side only, so a place payout without a win payout is lost.
    """
    return win.join(place, keys, "left" if reference_keys else "full")


def attach_payouts(
    rows: DataFrame, payouts: DataFrame, keys: list[str], one_page_scope: bool = False
) -> DataFrame:
    """Left join of payouts onto rows; the right key does not appear."""
    return spread_join(rows, payouts, keys, hot=HotKeys({}, 0) if one_page_scope else None)


def attach_mean(rows: DataFrame, means: DataFrame, key: str, hot: HotKeys | None = None) -> DataFrame:
    """Left join of a mean per key, computed here or stored earlier.

    Rows without a key get no mean.
    """
    return spread_join(rows, means, [key], hot=hot)


def still_missing(wanted: DataFrame, held: DataFrame, keys: list[str], content: str | None = None) -> DataFrame:
    """Work-list: wanted keys that are not held, or held only with empty content."""
    if content is not None:
        held = held.filter(F.length(content) > 0)
    return wanted.select(*keys).distinct().join(held.select(*keys).distinct(), keys, "left_anti")


def first_tier(tiers: list[DataFrame], keys: list[str], content: str) -> DataFrame:
    """For each key the content of the first tier that holds a non-empty one.

    Only keys of the earlier tiers are shuffled against the content of a later tier,
    never content against content. Each tier holds a key at most once.
    """
    found: DataFrame | None = None
    for tier in tiers:
        filled = tier.select(*keys, content).filter(F.length(content) > 0)
        if found is None:
            found = filled
        else:
            found = found.unionByName(filled.join(found.select(*keys), keys, "left_anti"))
    if found is None:
        raise ValueError("no tiers given")
    return found
