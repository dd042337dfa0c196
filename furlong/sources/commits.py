"""Versions of several tables as one commit.

A commit is a numbered manifest that names, per table, its files, rows and schema. It is made by
creating a file that must not be there yet, so of two writers one fails; readers see tables
through manifests only. Files are written before the manifest and never changed, so a run that
breaks off leaves the last commit as it was, an older one can be read as long as its files are
kept, and a new commit may go on naming files of the last one.
"""

from __future__ import annotations

import json
import uuid
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_commits"
END = "end"


class Table(NamedTuple):
    """A table of a commit: its files, each with its rows and the values it was written for (of a bucket, say)."""

    schema: str
    files: list[dict[str, Any]]

    @property
    def rows(self) -> int:
        return sum(file["rows"] for file in self.files)


class Commit(NamedTuple):
    number: int
    tables: dict[str, Table]
    note: str


class ConflictError(RuntimeError):
    """Another writer made this commit."""


def _place(spark: SparkSession, path: str) -> tuple[Any, Any]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/{MANIFESTS}/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the manifests that were begun, in order."""
    place, system = _place(spark, f"{root}/{MANIFESTS}")
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))


def _read(spark: SparkSession, root: str, number: int) -> Commit | None:
    """A commit; none if it was begun and not finished."""
    lines = spark.read.option("wholetext", True).text(_manifest_path(root, number)).collect()
    text = lines[0][0] if lines else ""
    try:
        found = json.loads(text)
    except json.JSONDecodeError:
        return None
    if found.get(END) != number:
        return None
    return Commit(number, {name: Table(t["schema"], t["files"]) for name, t in found["tables"].items()}, found["note"])


def latest(spark: SparkSession, root: str, at_most: int | None = None) -> Commit | None:
    """The last finished commit, or the last one up to a number."""
    for number in reversed(numbers(spark, root)):
        if (at_most is None or number <= at_most) and (commit := _read(spark, root, number)) is not None:
            return commit
    return None


def write_files(df: DataFrame, root: str, by: str | None = None) -> list[dict[str, Any]]:
    """Write a table's files where no reader looks yet, and describe them.

    ``by``: an int column that parts the rows; each file then holds one value of it (``part``).
    """
    spark, folder = df.sparkSession, f"{root}/files/{uuid.uuid4().hex}"
    writer = df.write if by is None else df.hint("rebalance", by).write.partitionBy(by)
    writer.parquet(folder)
    place, system = _place(spark, folder)
    if by is None:
        parts = {folder: None}
    else:
        found = [status.getPath() for status in system.listStatus(place) if status.isDirectory()]
        parts = {p.toString(): int(p.getName().removeprefix(f"{by}=")) for p in found if p.getName().startswith(f"{by}=")}
    names = {}
    for path, part in parts.items():
        for status in system.listStatus(_place(spark, path)[0]):
            if status.getPath().getName().endswith(".parquet"):
                names[status.getPath().toString()] = part
    if not names:
        return []
    # the readers' own count, from the files' footers
    kept = df.schema if by is None else StructType([f for f in df.schema.fields if f.name != by])
    counts = spark.read.schema(kept).parquet(*names).selectExpr("_metadata.file_path AS path").groupBy("path").count().collect()
    rows = {_name(row["path"]): row["count"] for row in counts}
    return [{"path": path, "rows": rows[_name(path)], "part": part} for path, part in sorted(names.items()) if _name(path) in rows]


def _name(path: str) -> str:
    """The last two parts of a path: schemes may be spelt in several ways."""
    return "/".join(path.split("/")[-2:])


def commit(
    spark: SparkSession, root: str, tables: dict[str, DataFrame | Table], after: Commit | None = None, note: str = ""
) -> Commit:
    """Make one commit of several tables. Tables of the last commit that are not given stay as they are.

    ``after``: the commit that this one builds on; if another one was made since, nothing is
    committed and ``ConflictError`` is raised. By default that is the last one.
    """
    base = after if after is not None else latest(spark, root)
    begun = numbers(spark, root)
    if after is not None and (now := latest(spark, root)) is not None and now.number != after.number:
        raise ConflictError(f"commit {now.number} was made since {after.number}")
    done = dict(base.tables) if base else {}
    for name, table in tables.items():
        done[name] = table if isinstance(table, Table) else Table(table.schema.json(), write_files(table, root))
    # a number that a broken-off writer holds is passed over
    number = max([base.number if base else 0, *begun]) + 1
    body = {"tables": {name: {"schema": t.schema, "files": t.files} for name, t in done.items()}, "note": note, END: number}
    place, system = _place(spark, _manifest_path(root, number))
    try:
        out = system.create(place, False)
    except Py4JJavaError as problem:
        raise ConflictError(f"commit {number} of {root} is there already") from problem
    out.write(json.dumps(body).encode())
    out.close()
    return Commit(number, done, note)


def read_table(spark: SparkSession, commit: Commit, name: str, parts: set[int] | None = None) -> DataFrame:
    """A table of a commit, from the files it names, or from those of some parts."""
    table = commit.tables[name]
    schema = StructType.fromJson(json.loads(table.schema))
    paths = [file["path"] for file in table.files if parts is None or file["part"] in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_version(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A table as of a commit, by default of the last one."""
    found = latest(spark, root, number)
    if found is None or (number is not None and found.number != number):
        raise FileNotFoundError(f"{root} has no commit {number if number is not None else ''}".rstrip())
    return read_table(spark, found, name)
