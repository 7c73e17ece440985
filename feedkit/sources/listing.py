"""A Spark data source that lists files, empty ones included, a task per group of folders. Contents are not read."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("name", T.StringType()), T.StructField("modified", T.TimestampType()), T.StructField("size", T.LongType())]
)
#: Schemes that Arrow's file systems read, by the name they have there.
SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "gcs": "gs"}
TASKS = 64


def can_list(path: str) -> bool:
    return urlsplit(path).scheme in SCHEMES


def local_path(path: str) -> str:
    """A path of the local file system without its scheme."""
    bare = path.removeprefix("file:")
    return bare[2:] if bare.startswith("//") and bare != path else bare


def _opened(path: str):
    """(file system, path in it, what comes before that path in full names)."""
    from pyarrow import fs

    parts = urlsplit(path)
    kind = SCHEMES[parts.scheme]
    if kind == "file":
        return fs.LocalFileSystem(), local_path(path), "file:"
    store, inner = fs.FileSystem.from_uri(f"{kind}://{path.split('://', 1)[1]}")
    return store, inner, f"{parts.scheme}://" if kind in ("s3", "gs") else f"{parts.scheme}://{parts.netloc}"


def _hidden(name: str) -> bool:
    """As in Spark's own scans, names that begin with a dot or an underscore are not listed."""
    return name.startswith(("_", "."))


class _Folders(InputPartition):
    def __init__(self, folders: Sequence[str], files: Sequence[tuple]):
        self.folders, self.files = list(folders), list(files)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def _children(self, store, folder: str) -> tuple[list, list]:
        from pyarrow import fs

        inside = [f for f in store.get_file_info(fs.FileSelector(folder, recursive=False)) if not _hidden(f.base_name)]
        return [f for f in inside if f.type == fs.FileType.File], [f.path for f in inside if f.type == fs.FileType.Directory]

    def partitions(self) -> list[InputPartition]:
        """The folders of the first level that has more than a few, dealt out; what lies above is listed here."""
        from pyarrow import fs

        store, root, _ = _opened(self.path)
        info = store.get_file_info(root.rstrip("/") or "/")
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if info.type == fs.FileType.File:
            return [_Folders([], [(info.path, info.mtime_ns, info.size)])]
        files, level = [], [info.path]
        while level and len(level) < TASKS:
            below = []
            for folder in level:
                own, folders = self._children(store, folder)
                files += [(f.path, f.mtime_ns, f.size) for f in own]
                below += folders
            level = below
        deals = [_Folders(level[i::TASKS], files[i::TASKS]) for i in range(TASKS)]
        return [d for d in deals if d.folders or d.files] or [_Folders([], [])]

    def read(self, partition: _Folders) -> Iterator[tuple]:
        from datetime import datetime, timezone

        store, _, before = _opened(self.path)

        def row(path: str, modified: int, size: int) -> tuple:
            when = datetime.fromtimestamp(modified // 1000 / 1e6, timezone.utc)
            return before + path, path.rsplit("/", 1)[-1], when, size

        for file in partition.files:
            yield row(*file)
        waiting = list(partition.folders)
        while waiting:
            own, folders = self._children(store, waiting.pop())
            waiting += folders
            for f in own:
                yield row(f.path, f.mtime_ns, f.size)


class FileListing(DataSource):
    """``spark.read.format("file_listing").load(path)``: path, name, modified, size of every file below ``path``."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["path"])
