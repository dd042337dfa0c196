"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame, SparkSession

import furlong

# workers get this code with the task and need no installed copy of it
cloudpickle.register_pickle_by_value(furlong)

# Settings the operators count on. Cluster sizing is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ids and dates are text and keep their leading zeros
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a batch of pages handed to Python is bounded by bytes, not only by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    partitions = str(os.cpu_count() or 8) if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("furlong")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", partitions)
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def is_one_machine(master: str) -> bool:
    """Whether the executors are threads of the driver."""
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint folder.

    Only where neither the setting nor the context names one, and all runs on one
    machine (tests), is a folder made here. On a cluster that is an error: executors
    would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path in the shared folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def run_folder(spark: SparkSession) -> str:
    """What this application keeps in the shared folder."""
    return f"{shared_root(spark)}/furlong/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once no result is read any more.

    Nothing else deletes them: a result may be read long after the call that returned it.
    """
    discard(spark, run_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder in the shared folder that nothing reads any more."""
    if not path.startswith(run_folder(spark)):
        raise ValueError(f"{path} is not an intermediate table")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard_checkpoint(rows: RDD) -> None:
    """Delete what a checkpoint of these wrote, if there is one, once nothing is made from it any more."""
    path = rows.getCheckpointFile() if rows.isCheckpointed() else None
    if path:
        place = rows.context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(rows.context._jsc.hadoopConfiguration()).delete(place, True)


def discard_tables(tables: list[DataFrame]) -> None:
    """Delete what ``cut_lineage`` wrote for these, once nothing reads it any more."""
    for table in tables:
        folders = {os.path.dirname(file) for file in table.inputFiles()}
        for folder in folders:
            if f"/furlong/{table.sparkSession.sparkContext.applicationId}/" in folder:
                place = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write the rows once to the shared folder and read on from there.

    The plan above them runs a single time, and the jobs that follow survive the
    loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
