"""Plugged-in sources: a generator over landed files as a Spark data source, for batches and streams.

    register(spark)
    spark.read.format("newstide_files").option("path", folder).option("scraper", "my.module:entries").load()
    spark.readStream.format("newstide_files") ...

The scraper takes a buffered binary file and yields dicts; it runs on the executors, by groups of files. Streams keep as
offset the (time, name) up to which files were read, so a restart goes on from there.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import import_module

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "url string, title string, text string, source string, scraped_at timestamp"
#: Bytes of files that one task reads.
GROUP_BYTES = 64 * 1024 * 1024


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def landed(root: str) -> list[tuple[int, str, int]]:
    """(time, path, bytes) of all files below a folder, oldest first; hidden files and those still being written are left out."""
    system, path = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
    infos = system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    shown = [i for i in infos if i.type == fs.FileType.File and not i.base_name.startswith((".", "_"))]
    return sorted((i.mtime_ns or 0, i.path, i.size or 0) for i in shown)


def grouped(files: list[tuple[int, str, int]], limit: int) -> list[Files]:
    """Files put together until they hold ``limit`` bytes; a larger file is a group of its own."""
    groups, held = [[]], 0
    for _, path, size in files:
        if groups[-1] and held + size > limit:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += size
    return [Files(tuple(g)) for g in groups if g]


def lines(file) -> Iterator[dict]:
    """The default scraper: a JSON object per line; other lines are an error."""
    for line in file:
        if line.strip():
            yield json.loads(line)


class _Reading:
    def __init__(self, schema, options):
        self.fields, self.root = schema.names, options["path"]
        self.limit = int(options.get("groupbytes", GROUP_BYTES))
        module, _, name = options.get("scraper", f"{__name__}:lines").partition(":")
        self.scraper = (module, name)

    def read(self, partition: Files) -> Iterator[tuple]:
        scrape = getattr(import_module(self.scraper[0]), self.scraper[1])
        system = fs.FileSystem.from_uri(self.root)[0] if "://" in self.root else fs.LocalFileSystem()
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for row in scrape(io.BufferedReader(file)):
                    yield tuple(row.get(name) for name in self.fields)


class FilesReader(_Reading, DataSourceReader):
    def partitions(self):
        return grouped(landed(self.root), self.limit) or [Files(())]


class FilesStream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = landed(self.root)
        return {"time": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict):
        after, until = (start["time"], start["path"]), (end["time"], end["path"])
        return grouped([f for f in landed(self.root) if after < f[:2] <= until], self.limit)


class FilesSource(DataSource):
    """Options: ``path``, ``scraper`` as ``module:function``, ``groupBytes``. A schema of the reader's own replaces the default."""

    @classmethod
    def name(cls) -> str:
        return "newstide_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FilesReader:
        return FilesReader(schema, self.options)

    def streamReader(self, schema) -> FilesStream:
        return FilesStream(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FilesSource)
