"""File listing as a Spark data source: names, lengths and times come from tasks, not from the driver.

A partition is one folder.  The driver walks folder *names* breadth first, and only until
``max_folders`` of them are known; below that, a task lists its own folder to any depth.  Folders that were
opened on the way are partitions of their own, for the files that lie directly in them.  Zero-length
files are listed like all others.  Rows are ``path``, ``length``, ``modified``.
"""

from __future__ import annotations

import datetime
import posixpath
import re
from collections import deque
from collections.abc import Iterator
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length bigint, modified timestamp"
MAX_FOLDERS = 4096


def open_store(root: str):
    """(file system, path in it, what to put before its paths)."""
    from pyarrow import fs
    uri = re.sub(r"^s3[an]:", "s3:", root)
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.rstrip("/") or "/", "file:"
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].strip("/"), "file:"
    store, path = fs.FileSystem.from_uri(uri)
    scheme, authority = re.match(r"([^:]+)://([^/]*)", root).groups()
    # object stores count the bucket as the first part of a path, others leave the authority out
    before = f"{scheme}://" if authority and path.split("/")[0] == authority else f"{scheme}://{authority}"
    return store, path.rstrip("/"), before


def _hidden(name: str) -> bool:
    """Names that Spark's own file sources pass over."""
    return name.startswith((".", "_")) and "=" not in name


class Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class Reader(DataSourceReader):
    def __init__(self, root: str, glob: str, max_folders: int):
        self.root, self.glob, self.max_folders = root, glob, max_folders

    def _children(self, store, path: str):
        from pyarrow import fs
        return [x for x in store.get_file_info(fs.FileSelector(path)) if not _hidden(x.base_name)]

    def partitions(self) -> list[Folder]:
        """Folders, opened breadth first while fewer than ``max_folders`` are known."""
        from pyarrow import fs
        store, path, _ = open_store(self.root)
        if store.get_file_info(path).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no such folder: {self.root}")
        closed, opened = deque([path]), []
        while closed and len(closed) + len(opened) < self.max_folders:
            folder = closed.popleft()
            opened.append(folder)
            closed.extend(x.path for x in self._children(store, folder) if x.type == fs.FileType.Directory)
        return [Folder(p, False) for p in opened] + [Folder(p, True) for p in closed]

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs
        store, _, before = open_store(self.root)
        todo = [partition.path]
        while todo:
            for x in self._children(store, todo.pop()):
                if x.type == fs.FileType.Directory:
                    if partition.deep:
                        todo.append(x.path)
                elif fnmatchcase(posixpath.basename(x.path), self.glob):
                    yield before + x.path, int(x.size or 0), x.mtime or datetime.datetime(1970, 1, 1)


class FileListing(DataSource):
    """``spark.read.format("file_listing").option("root", ...).option("glob", ...).load()``"""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["root"], self.options.get("glob", "*"),
                      int(self.options.get("maxFolders", MAX_FOLDERS)))


def list_files(spark: SparkSession, root: str, glob: str = "*", max_folders: int = MAX_FOLDERS) -> DataFrame:
    """Every file under ``root`` (any depth) whose name matches ``glob``: path, length, modified."""
    spark.dataSource.register(FileListing)
    return (spark.read.format("file_listing").option("root", root).option("glob", glob)
            .option("maxFolders", max_folders).load())


def find_root(spark: SparkSession, candidates: list[str]) -> str:
    """The first candidate folder that exists (the first of them wins, as an argument does over defaults)."""
    for c in candidates:
        path = spark._jvm.org.apache.hadoop.fs.Path(c)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return c
    raise FileNotFoundError("none of these folders exists: " + ", ".join(candidates))
