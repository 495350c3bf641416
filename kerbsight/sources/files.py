"""A sink of whole files: spark.write.format("named_files") of rows (name, content).

Tasks write where the data is, through Arrow's file systems (a local or mounted path, or a URI such as
hdfs:// or s3://), into a folder of their own attempt.  Only when all tasks have succeeded are the files
moved to their names; so a failed or repeated task leaves neither a part of a file nor a file of a job that
failed, and no content goes through the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING = "_staging"
#: Files that the driver moves at a time.
MOVES = 16
STALE_S = 86_400


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), path


def _checked(name: str | None) -> str:
    """A relative name that stays inside the folder."""
    parts = PurePosixPath(name or "").parts
    if not parts or parts[0] in ("/", STAGING) or ".." in parts:
        raise ValueError(f"not a file name inside the folder: {name!r}")
    return "/".join(parts)


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    names: list[str]


class FileSink(DataSource):
    """Options: path.  Rows: name (relative to the path) and content; of a name that comes twice, either stays."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"])


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def _staging(self, root: str) -> str:
        return f"{root.rstrip('/')}/{STAGING}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        attempt, names = uuid.uuid4().hex, []
        folder = f"{self._staging(root)}/{attempt}"
        try:
            for batch in iterator:
                for name, content in zip(batch.column("name"), batch.column("content")):
                    name = _checked(name.as_py())
                    fs.create_dir(f"{folder}/{name}".rpartition("/")[0], recursive=True)
                    with fs.open_output_stream(f"{folder}/{name}") as out:
                        if content.is_valid:
                            out.write(content.as_buffer())
                    names.append(name)
        except BaseException:
            _remove(fs, folder)
            raise
        return Written(attempt, names)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        moves = {name: f"{self._staging(root)}/{m.attempt}/{name}" for m in messages if m for name in m.names}
        for folder in {f"{root.rstrip('/')}/{name}".rpartition("/")[0] for name in moves}:
            fs.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda x: fs.move(x[1], f"{root.rstrip('/')}/{x[0]}"), moves.items()))
        self._clean(fs, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*file_system(self.path))

    def _clean(self, fs: arrow_fs.FileSystem, root: str) -> None:
        """Also what attempts left that were killed; and, as a task may write a little longer than its job has
        lived, what a job has left a day ago."""
        _remove(fs, self._staging(root))
        staging = f"{root.rstrip('/')}/{STAGING}"
        for job in _entries(fs, staging):
            if job.mtime is not None and time.time() - job.mtime.timestamp() > STALE_S:
                _remove(fs, job.path)
        if not _entries(fs, staging):
            _remove(fs, staging)


def _entries(fs: arrow_fs.FileSystem, folder: str) -> list:
    return fs.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))


def _remove(fs: arrow_fs.FileSystem, folder: str) -> None:
    if fs.get_file_info(folder).type == arrow_fs.FileType.Directory:
        fs.delete_dir(folder)
