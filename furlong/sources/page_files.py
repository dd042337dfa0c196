"""Page files ``<root>/race_date=<yyyyMMdd>/<race_id>.html`` as a data source, to read and to write.

Splits hold files up to a number of bytes, however many files that are. A range of dates is
taken as a filter, and folders outside it are not listed. Writing leaves files under another
name until all tasks are done; then they are given their own, so a write that breaks off shows
no page.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

NAME = "page_files"
SCHEMA = "race_date string, race_id string, html string"
SPLIT_BYTES = 32 * 1024 * 1024
#: Bytes a file counts for in a split beside its own: opening one takes time.
OPEN_BYTES = 64 * 1024
PREFIX = "race_date="
SUFFIX = ".html"
#: Files of a write that isn't done; readers pass over names with an underscore in front.
UNFINISHED = "_unfinished-"


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageFiles)


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Pages under a folder; filters on ``race_date`` decide which folders are listed."""
    return spark.read.format(NAME).option("splitBytes", split_bytes).load(path)


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and "://" not in path else path)
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class Split(InputPartition):
    files: list[str]

    def __init__(self, files: list[str]) -> None:
        super().__init__(0)
        self.files = files


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]  # name now, name when done


class PageFiles(DataSource):
    """The data source ``page_files``; options ``path`` and ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> PageWriter:
        if overwrite:
            raise ValueError("pages are only added: mode append")
        return PageWriter(self.options, schema.names)


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.bounds: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and f.attribute == ("race_date",) and isinstance(f.value, str):
                self.bounds.append((kinds[type(f)], f.value))
            else:
                yield f

    def _wanted(self, date: str) -> bool:
        tests = {
            "==": date.__eq__, ">": date.__gt__, ">=": date.__ge__, "<": date.__lt__, "<=": date.__le__,
        }
        return all(tests[kind](value) for kind, value in self.bounds)

    def partitions(self) -> list[InputPartition]:
        system, root = _system(self.path)
        folders = [f for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.Directory]
        dated = sorted(f.path for f in folders if f.base_name.startswith(PREFIX) and self._wanted(f.base_name.removeprefix(PREFIX)))
        splits, held, size = [], [], 0
        for folder in dated:
            for info in sorted(system.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
                if info.type != fs.FileType.File or not info.base_name.endswith(SUFFIX) or info.base_name.startswith("_"):
                    continue
                held.append(info.path)
                size += info.size + OPEN_BYTES
                if size >= self.split_bytes:
                    splits.append(Split(held))
                    held, size = [], 0
        return [*splits, Split(held)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.path)
        held: list[tuple[str, str, str]] = []
        size = 0
        for path in partition.files:
            with system.open_input_stream(path) as file:
                html = file.read().decode("utf-8", "replace")
            *_, folder, name = path.split("/")
            held.append((folder.removeprefix(PREFIX), name.removesuffix(SUFFIX), html))
            size += len(html)
            if size >= 4 * 1024 * 1024:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["race_date", "race_id", "html"])


class PageWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], names: list[str]) -> None:
        missing = {"race_date", "race_id", "html"} - set(names)
        if missing:
            raise ValueError(f"no column {', '.join(sorted(missing))}")
        self.path = options["path"]

    def write(self, iterator: Iterator[Any]) -> Written:
        system, root = _system(self.path)
        made, folders = [], set()
        for row in iterator:
            if not row["race_date"] or not row["race_id"] or "/" in row["race_date"] + row["race_id"]:
                raise ValueError(f"a page needs a date and an id: {row['race_date']!r}, {row['race_id']!r}")
            folder = f"{root}/{PREFIX}{row['race_date']}"
            if folder not in folders:
                system.create_dir(folder, recursive=True)
                folders.add(folder)
            now = f"{folder}/{UNFINISHED}{uuid.uuid4().hex}"
            with system.open_output_stream(now) as out:
                out.write((row["html"] or "").encode())
            made.append((now, f"{folder}/{row['race_id']}{SUFFIX}"))
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        """Give all files their names; of pages with the same date and id one stays, a page that is there is replaced."""
        system, _ = _system(self.path)
        for message in messages:
            for now, done in message.files if message else []:
                system.move(now, done)

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what the tasks that got through have left."""
        system, _ = _system(self.path)
        for message in messages:
            for now, _done in message.files if message else []:
                if system.get_file_info(now).type == fs.FileType.File:
                    system.delete_file(now)
