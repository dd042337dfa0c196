"""Stored means and dictionaries that grow with new rows, without a look at the old ones.

Both are tables of a commit (``commits``), so an increment is taken in as a whole or not at
all, and of two writers that start from the same state one fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from furlong.operators.skew import row_numbers
from furlong.session import cut_lineage
from furlong.sources import commits
from furlong.sources.commits import Commit, Table

BUCKETS = 64
SUMS, CODES = "sums", "codes"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def grow_means(
    spark: SparkSession, root: str, rows: DataFrame, key: str, value: str, buckets: int = BUCKETS, after: Commit | None = None
) -> Commit:
    """Add new rows to the stored sum and count per key; rows without a key or value don't count.

    Keys are dealt to hash buckets, and only buckets that new rows touch are read and written
    anew; the files of the others are named by the new commit as they are.
    """
    base = after if after is not None else commits.latest(spark, root)
    new = rows.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    sums = new.groupBy(key).agg(F.sum(F.col(value).cast("double")).alias("sum"), F.count(F.lit(1)).alias("count"))
    sums = cut_lineage(sums.withColumn("bucket", _bucket(key, buckets)), "sums")
    touched = {row["bucket"] for row in sums.select("bucket").distinct().collect()}  # at most as many as there are buckets
    if base is None or SUMS not in base.tables:
        old_files, merged = [], sums
    else:
        table = base.tables[SUMS]
        old_files = [file for file in table.files if file["part"] not in touched]
        old = commits.read_table(spark, base, SUMS, touched).withColumn("bucket", _bucket(key, buckets))
        both = old.unionByName(sums.select(*old.columns))
        merged = both.groupBy(key, "bucket").agg(F.sum("sum").alias("sum"), F.sum("count").alias("count"))
    schema = sums.select(key, "sum", "count").schema.json()
    files = commits.write_files(merged.select(key, "sum", "count", "bucket"), root, by="bucket")
    return commits.commit(spark, root, {SUMS: Table(schema, old_files + files)}, base)


def stored_means(spark: SparkSession, root: str, key: str, name: str, number: int | None = None) -> DataFrame:
    """The mean per key as of the last commit, or an earlier one."""
    return commits.read_version(spark, root, SUMS, number).select(key, (F.col("sum") / F.col("count")).alias(name))


def grow_codes(spark: SparkSession, root: str, rows: DataFrame, column: str, after: Commit | None = None) -> Commit:
    """Give codes to the values of a column that have none yet: the next ones, in sort order.

    Codes given earlier never change, so what was stored with them stays right. A missing value
    has no code.
    """
    base = after if after is not None else commits.latest(spark, root)
    values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    old_files, first = [], 0
    if base is not None and CODES in base.tables:
        old_files, first = base.tables[CODES].files, base.tables[CODES].rows
        values = values.join(commits.read_table(spark, base, CODES).select(column), column, "left_anti")
    numbered = row_numbers(values, [column], "__place")
    coded = numbered.select(column, (F.col("__place") + first).cast("long").alias("code"))
    files = commits.write_files(coded, root)
    return commits.commit(spark, root, {CODES: Table(coded.schema.json(), old_files + files)}, base)


def stored_codes(spark: SparkSession, root: str, column: str, code: str, number: int | None = None) -> DataFrame:
    """The code per value as of the last commit, or an earlier one; fit for ``encode_with``."""
    return commits.read_version(spark, root, CODES, number).select(column, F.col("code").alias(code))
