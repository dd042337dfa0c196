"""Partitioned and versioned tables in a shared folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict
from typing import Any

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from furlong.functions.text import year_month
from furlong.operators.project import between_dates
from furlong.plans.boosting import NODE_SCHEMA, Boosted, Node

MAX_RECORDS_PER_FILE = 5_000_000
# names with an underscore in front are passed over by readers
PUBLISHED = "_published"


def write_partitioned(
    df: DataFrame, path: str, by: str, mode: str = "errorifexists", max_records: int = MAX_RECORDS_PER_FILE
) -> None:
    """Write one folder per value of a column.

    ``mode="overwrite"`` replaces the folders of the values that are written and leaves the
    others.

    Rows are gathered by value first, so a value has few files. The rebalance hint lets
    adaptive execution split a value that is far larger than the others over several
    tasks and merge small ones.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.partitionBy(by)
        .option("maxRecordsPerFile", max_records)
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path)
    )


def spread_scan(table: DataFrame, keys: list[str]) -> DataFrame:
    """Give a scan that has fewer splits than the cluster has slots one split per slot.

    Meant for a plain scan whose rows go to Python next. A table with many files or
    row groups is returned as it is, without a shuffle.
    """
    slots = table.sparkSession.sparkContext.defaultParallelism
    # from the plan's own figures: nothing of it is run
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    split = table.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if size / split >= slots or len(table.inputFiles()) >= slots:
        return table
    return table.repartition(slots, *keys)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A folder of Parquet files as one table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def folders_in_range(spark: SparkSession, root: str, by: str, first: str | None, last: str | None) -> list[str]:
    """Folders ``<root>/<by>=<value>`` with a value in the range, read from the root alone.

    Spark lists the files of every folder it is given before it applies a partition
    filter; given these, it lists no file outside the range. Empty where the root has
    another layout or nothing lies in the range.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(place)]
    values = [name.removeprefix(f"{by}=") for name in names if name.startswith(f"{by}=")]
    kept = [v for v in values if (first is None or v >= first) and (last is None or v <= last)]
    return [f"{root}/{by}={value}" for value in sorted(kept)]


def read_dates(
    spark: SparkSession,
    path: str,
    by: str,
    first: str | None = None,
    last: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of a date-partitioned table within a range; other folders are neither read nor listed."""
    bounded = first is not None or last is not None
    folders = folders_in_range(spark, path, by, first, last) if bounded else []
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.option("basePath", path).parquet(*(folders or [path]))
    return between_dates(table.withColumn(by, F.col(by).cast("string")), by, first, last)


def write_monthly(df: DataFrame, path: str, date: str, mode: str = "errorifexists") -> None:
    """Write one folder per month, ``ym=<yyyyMM>``, of a yyyyMMdd text column."""
    year, month = F.substring(date, 1, 4).cast("int"), F.substring(date, 5, 2).cast("int")
    write_partitioned(df.withColumn("ym", year_month(year, month)), path, "ym", mode)


def version_path(root: str, version: str, name: str) -> str:
    return f"{root}/data_version={version}/{name}.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place))


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether a write to this path was finished: ``publish`` has left its mark, the last file it writes."""
    return path_exists(spark, f"{path}/{PUBLISHED}")


def _mark_published(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PUBLISHED}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True).close()


def publish(df: DataFrame, root: str, version: str, name: str, replace: bool = False) -> str:
    """Write a table under a version.

    Whatever is at the path stays as it is unless ``replace`` is set: a finished version,
    or a folder without the mark of one, which may be what a write left that broke off.
    """
    path = version_path(root, version, name)
    if not replace and path_exists(df.sparkSession, path):
        state = "is there" if is_published(df.sparkSession, path) else "holds an unfinished version"
        raise FileExistsError(f"{path} {state}")
    df.write.mode("overwrite").parquet(path)
    _mark_published(df.sparkSession, path)
    return path


def publish_all(data: dict[str, DataFrame], root: str, version: str, replace: bool = False) -> dict[str, str]:
    """Write several tables under one version."""
    return {name: publish(df, root, version, name, replace) for name, df in data.items()}


def read_version(spark: SparkSession, root: str, version: str, name: str) -> DataFrame:
    return read_table(spark, version_path(root, version, name))


def read_or_build(
    spark: SparkSession, root: str, version: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The published version if there is one, else build, publish and read it back.

    On a hit the stored table is returned as it is, whatever ``build`` would select.
    """
    if not is_published(spark, version_path(root, version, name)):
        publish(build(), root, version, name)
    return read_version(spark, root, version, name)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store a table bucketed and sorted by a key, and read it back.

    Two tables with the same key and number of buckets are joined on it without a shuffle of
    either, once they are stored. The key should not be hot: a bucket is one task.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    placed = df.repartition(buckets, key)  # one file per bucket
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return spark.table(name)


def _model_path(spark: SparkSession, root: str, name: str, version: str, replace: bool) -> str:
    path = f"{root}/{name}/model_version={version}"
    if not replace and is_published(spark, path):
        raise FileExistsError(f"{path} is there")
    if path_exists(spark, path):  # what is replaced, or what a save left that broke off
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return path


def _write_json(spark: SparkSession, path: str, parts: dict[str, Any]) -> None:
    for part, values in parts.items():
        spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.text(f"{path}/{part}")


def _read_json(spark: SparkSession, path: str, *parts: str) -> list[Any]:
    if not is_published(spark, path):
        raise FileNotFoundError(f"{path} holds no finished model")
    return [json.loads(spark.read.text(f"{path}/{part}").first()[0]) for part in parts]


def publish_model(
    spark: SparkSession,
    model: Model,
    params: dict[str, Any],
    metrics: dict[str, float],
    root: str,
    name: str,
    version: str,
    replace: bool = False,
) -> str:
    """Store a model with its parameters and metrics under a model version; it is there once its mark is.

    A finished version stays unless ``replace`` is set; what a save left that broke off is written over.
    """
    path = _model_path(spark, root, name, version, replace)
    model.write().save(f"{path}/model")
    _write_json(spark, path, {"params": params, "metrics": metrics})
    _mark_published(spark, path)
    return path


def read_model(
    spark: SparkSession, root: str, name: str, version: str, kind: type[Model] = GBTClassificationModel
) -> tuple[Model, dict[str, Any], dict[str, float]]:
    """A stored model with its parameters and metrics."""
    path = f"{root}/{name}/model_version={version}"
    params, metrics = _read_json(spark, path, "params", "metrics")
    return kind.load(f"{path}/model"), params, metrics


SET_SCHEMA = "node int, feature int, id string"


def publish_booster(
    spark: SparkSession,
    model: Boosted,
    params: dict[str, Any],
    metrics: dict[str, float],
    root: str,
    name: str,
    version: str,
    replace: bool = False,
) -> str:
    """Store boosted trees: their nodes and sets of ids as tables, beside parameters and metrics."""
    path = _model_path(spark, root, name, version, replace)
    nodes = [Row(**asdict(node)) for node in model.nodes]
    spark.createDataFrame(nodes, NODE_SCHEMA).coalesce(1).write.parquet(f"{path}/nodes")
    ids = model.ids if model.ids is not None else spark.createDataFrame([], SET_SCHEMA)
    used = [node.number for node in model.nodes if node.is_set]
    ids.filter(F.col("node").isin(used)).write.parquet(f"{path}/sets")
    shape = {"features": model.features, "sets": model.sets, "start": model.start}
    _write_json(spark, path, {"shape": shape, "params": params, "metrics": metrics})
    _mark_published(spark, path)
    return path


def read_booster(spark: SparkSession, root: str, name: str, version: str) -> tuple[Boosted, dict[str, Any], dict[str, float]]:
    """Stored boosted trees with their parameters and metrics."""
    path = f"{root}/{name}/model_version={version}"
    shape, params, metrics = _read_json(spark, path, "shape", "params", "metrics")
    nodes = [Node(**row.asDict()) for row in spark.read.parquet(f"{path}/nodes").sort("number").collect()]  # bounded by leaves and rounds
    has_sets = any(node.is_set for node in nodes)
    ids = spark.read.schema(SET_SCHEMA).parquet(f"{path}/sets") if has_sets else None
    return Boosted(shape["features"], shape["sets"], shape["start"], nodes, ids), params, metrics
