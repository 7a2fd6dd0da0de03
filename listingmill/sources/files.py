"""Image files named ``property-image.jpg``."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

BATCH_ROWS = 10_000
FOLDER_FILES = 10_000
MOST_LINKS = 10_000


def split_names(names: DataFrame) -> DataFrame:
    """(pid, imgid, name) and all other columns of the names that follow the
    pattern; the property ends at the first dash."""
    parts = r"^([^-]*)-(.*)\.[jJ][pP][gG]$"
    return names.where(F.col("name").rlike(parts)).select(
        F.regexp_extract("name", parts, 1).alias("pid"), F.regexp_extract("name", parts, 2).alias("imgid"), "name",
        *[names[c] for c in names.columns if c != "name"])


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class Folder(InputPartition):
    """A folder that one task lists: with all below it, or only the files that lie in it."""

    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


class FileNames(DataSource):
    """The files below a folder: folder, name, length.  Contents are never opened.

    One task per folder ``depth`` levels down (option, 1 unless given) lists it with all below, and one per folder above these
    the files in it, so that the driver lists nothing but the folders above them.  Names that begin with a dot or an underscore
    are left out, as by Spark's own readers.  An empty folder gives no rows, a missing one is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "folder string, name string, length long"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FileNamesReader(self.options["path"], int(self.options.get("depth", 1)))


class FileNamesReader(DataSourceReader):
    def __init__(self, path: str, depth: int):
        self.path, self.depth = path, depth

    def partitions(self) -> list[InputPartition]:
        system, root = filesystem(self.path)
        out, level = [], [root]
        for _ in range(self.depth):
            out += [Folder(path, False) for path in level]
            level = [f.path for path in level for f in _visible(system, path) if f.type == fs.FileType.Directory]
        return out + [Folder(path, True) for path in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(self.path)
        waiting, rows = [partition.path], []
        while waiting:
            folder = waiting.pop()
            for found in _visible(system, folder):
                if found.type == fs.FileType.File:
                    rows.append((folder, found.base_name, found.size))
                elif partition.deep and found.type == fs.FileType.Directory:
                    waiting.append(found.path)
                if len(rows) == BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _visible(system: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return [f for f in system.get_file_info(fs.FileSelector(folder)) if f.base_name[:1] not in (".", "_")]


def _batch(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    folders, names, lengths = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(folders, pa.string()), pa.array(names, pa.string()), pa.array(lengths, pa.int64())], ["folder", "name", "length"])


def image_files(spark: SparkSession, folder: str, depth: int = 1) -> DataFrame:
    """(pid, imgid, name, path) of the image files below a folder, listed by one task per folder ``depth`` levels down."""
    spark.dataSource.register(FileNames)
    found = spark.read.format(FileNames.name()).option("depth", depth).load(folder)
    return split_names(found.select("name", F.concat_ws("/", "folder", "name").alias("path")))


def touch(names: DataFrame, folder: str, prefixes: int = 64) -> None:
    """Create an empty file for every ``name``, in one of ``prefixes`` folders by its hash; a task that runs again does no harm.

    On a local disk ``MOST_LINKS`` names are links to one empty file, as tens of millions of files of their own are more than
    a file system has room to describe.
    """
    prefix = F.lpad(F.hex(F.pmod(F.xxhash64("name"), F.lit(prefixes))), max(2, len(f"{prefixes - 1:x}")), "0")

    def create(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        local = isinstance(system, fs.LocalFileSystem)
        folders, first, links = set(), None, 0
        for batch in batches:
            for p, name in zip(batch.column("prefix").to_pylist(), batch.column("name").to_pylist()):
                path = posixpath.join(root, p, name)
                if p not in folders:
                    system.create_dir(posixpath.dirname(path))
                    folders.add(p)
                if local and first and links < MOST_LINKS:
                    _link(first, path)
                    links += 1
                else:
                    system.open_output_stream(path).close()
                    first, links = path, 0
            yield batch

    names.select(prefix.alias("prefix"), "name").mapInArrow(create, "prefix string, name string").write.format("noop").mode("overwrite").save()


def _link(old: str, new: str) -> None:
    try:
        os.link(old, new)
    except FileExistsError:
        pass


def folders_for(names: int) -> int:
    """Folders for so many files, 64 at least, each with about ``FOLDER_FILES``: a folder is listed by one task."""
    return max(64, -(-names // FOLDER_FILES))
