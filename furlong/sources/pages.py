"""Landed page files as a table of pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from furlong.functions.encode import decode_bytes
from furlong.functions.text import path_value, stem_of_path
from furlong.operators.project import between_dates
from furlong.schemas import PAGE, PAGE_KEYS
from furlong.sources.tables import folders_in_range, read_dates

# first date, last date (either may be None) -> pages (race_date, race_id, html)
PageSource = Callable[[str | None, str | None], DataFrame]


def scan_pages(
    spark: SparkSession,
    root: str,
    first_date: str | None = None,
    last_date: str | None = None,
    charset: str | None = None,
) -> DataFrame:
    """Pages under ``<root>/race_date=<yyyyMMdd>/<race_id>.html`` within a date range.

    The range becomes a partition filter, and folders outside it are not even listed.
    Files that lie in no date folder are skipped. With ``charset`` the files are read
    as bytes and decoded; otherwise they are UTF-8 text.
    """
    reader = spark.read.option("recursiveFileLookup", "false").option("pathGlobFilter", "*.html")
    bounded = first_date is not None or last_date is not None
    folders = folders_in_range(spark, root, "race_date", first_date, last_date) if bounded else []
    dated = folders or [f"{root}/race_date=*"]
    if charset is None:
        files = reader.option("basePath", root).text(dated, wholetext=True)
        html = F.col("value")
    else:
        files = reader.option("basePath", root).format("binaryFile").load(dated)
        html = decode_bytes(F.col("content"), charset)
    # the partition value is text only when inference is off; the cast is a no-op then
    dates = files.withColumn("race_date", F.col("race_date").cast("string"))
    kept = between_dates(dates.filter(F.col("race_date").rlike(r"^\p{Nd}+")), "race_date", first_date, last_date)
    path = F.col("_metadata.file_path") if charset is None else F.col("path")
    return kept.select("race_date", stem_of_path(path).alias("race_id"), html.alias("html"))


def keys_from_paths(paths: DataFrame, path: str) -> DataFrame:
    """Date and id of a page from its path; paths without a date are dropped."""
    return (
        paths.withColumns({"race_date": path_value(path, "race_date"), "race_id": stem_of_path(path)})
        .filter(F.col("race_date").isNotNull())
    )


def page_files(spark: SparkSession, root: str, charset: str | None = None) -> PageSource:
    """Pages held as one file each. Fits up to some millions of files: Spark lists them all."""
    return lambda first, last: scan_pages(spark, root, first, last, charset)


def page_table(spark: SparkSession, table: str) -> PageSource:
    """Pages held in a table partitioned by date, as the incremental ingest leaves them."""
    return lambda first, last: read_dates(spark, table, "race_date", first, last, PAGE).select(*PAGE_KEYS, "html")
