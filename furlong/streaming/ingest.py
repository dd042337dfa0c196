"""Incremental ingest: landed files to a table with one row per page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from furlong.schemas import PAGE_KEYS
from furlong.session import cut_lineage
from furlong.sources.tables import path_exists

BATCH = "ingest_batch"
LANDED_AT = "landed_at"


def _marked(pages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The pages stored once, each with a mark of its own and a hash of its other values."""
    rest = [c for c in pages.columns if c not in keys and c not in order]
    marked = pages.withColumns({"__hash": F.xxhash64(F.lit(0), *rest), "__mark": F.monotonically_increasing_id()})
    return cut_lineage(marked, "batch")


def _first_of(marked: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keys with the mark of the copy that is first; page bodies take no part."""
    first = F.min(F.struct(*order, "__hash", "__mark")).alias("__first")
    return marked.select(*keys, *order, "__hash", "__mark").groupBy(*keys).agg(first).select(*keys, F.col("__first.__mark").alias("__mark"))


def _bodies(marked: DataFrame, chosen: DataFrame) -> DataFrame:
    return marked.join(chosen.select("__mark"), "__mark", "left_semi").drop("__hash", "__mark")


def first_copies(pages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the copy that is first by ``order``.

    Copies that ``order`` leaves equal, all of them if it is empty, are told apart by a hash of
    their other values, the smallest first; that is some copy, but always the same one.

    Which copy stays is decided on keys, order and hash alone, combined in each task before the
    shuffle, so a page that landed a million times moves a few times only, and no body is sorted.
    """
    marked = _marked(pages, keys, order)
    return _bodies(marked, _first_of(marked, keys, order)).select(*pages.columns)


def land_batch(
    batch: DataFrame, batch_id: int, table: str, keys: list[str], content: str, order: list[str], by: str | None,
    look_up: bool = True,
) -> None:
    """Append the pages of a micro-batch that are not held yet.

    Each batch owns a folder and overwrites it, so a batch that is run again after a
    failure leaves the same rows. Held keys are looked up among earlier batches, and
    only in the range of partitions this batch touches, or that have no value. ``by``
    must be one of the keys or follow from them. Without ``look_up`` held keys are not looked up.
    """
    spark = batch.sparkSession
    marked = _marked(batch.filter(F.length(content) > 0), keys, order)
    new = _first_of(marked, keys, order)
    held = read_landed(spark, table, batch.schema, by, before=batch_id) if look_up else None
    if held is not None:
        if by is not None:
            touched = batch.agg(F.min(by).alias("lo"), F.max(by).alias("hi")).first()
            held = held.filter(F.col(by).between(touched["lo"], touched["hi"]) | F.col(by).isNull())
        new = new.join(held.select(*keys), keys, "left_anti")
    # only now are bodies read, and only those that land
    writer = _bodies(marked, new).select(*batch.columns).hint("rebalance", *([F.col(by)] if by else [])).write.mode("overwrite")
    if by is not None:
        writer = writer.partitionBy(by)
    writer.parquet(f"{table}/{BATCH}={batch_id}")


def read_landed(
    spark: SparkSession, table: str, schema: StructType, by: str | None = None, before: int | None = None
) -> DataFrame | None:
    """The landed table, or None while nothing has landed. ``before`` limits it to earlier batches."""
    if not path_exists(spark, table):
        return None
    held = spark.read.schema(StructType([*schema.fields, StructField(BATCH, LongType())])).parquet(table)
    if before is not None:
        held = held.filter(F.col(BATCH) < before)
    return held.drop(BATCH)


def ingest(
    source: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str] = PAGE_KEYS,
    content: str = "html",
    order: list[str] | None = None,
    by: str | None = "race_date",
    within: str | None = None,
) -> None:
    """Process all files that are new since the last call, then stop.

    ``source`` is a streaming DataFrame. Without ``within`` no state is held between batches:
    what has landed is known from the table itself, however many pages there are. Of copies in
    one batch the first by ``order`` stays; without it, by ``landed_at`` where there is one.

    ``within``: a repeat that lands so long after the first copy at most ("2 days") is dropped by
    keyed state, and the table is not read. The state holds the keys of that time and no more:
    a page may land again once the limit is over, and one that is late by more than the limit is
    dropped. Which copy stays within one batch is not decided then.
    """
    if order is None:
        order = [LANDED_AT] if LANDED_AT in source.columns else []

    if within is not None:
        filled = source.filter(F.length(content) > 0)
        source = filled.withWatermark(LANDED_AT, within).dropDuplicatesWithinWatermark(keys)

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, table, keys, content, order, by, look_up=within is None)

    query = (
        source.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def page_stream(spark: SparkSession, root: str, max_files: int = 100_000) -> DataFrame:
    """Page files ``<root>/race_date=<yyyyMMdd>/<race_id>.html`` as a stream of pages.

    A backlog is taken in batches of at most ``max_files``.
    """
    reader = spark.readStream.schema("value string, race_date string").format("text").option("wholetext", True)
    files = reader.option("maxFilesPerTrigger", max_files).load(root)
    return files.select(
        "race_date",
        F.regexp_extract("_metadata.file_path", r"([^/]+)\.html$", 1).alias("race_id"),
        F.col("value").alias("html"),
        F.col("_metadata.file_modification_time").alias(LANDED_AT),
    )
