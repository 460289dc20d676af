"""Growing text files as a stream: every finished line once, whatever is appended, renamed, cut or begun anew.

The files lie in a folder that the driver and all executors have mounted. A file is known by its inode and by a checksum of its
first bytes, so a renamed file is followed under its new name, and another file under an old inode begins anew.
"""

from __future__ import annotations

import fnmatch
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a file's beginning by which it is recognised, bytes read at a time, and bytes of one task.
HEAD = 256
CHUNK = 1 << 20
SPLIT = 64 << 20
SCHEMA = pa.schema([("file", pa.string()), ("byte", pa.int64()), ("value", pa.string())])


def local_path(folder: str) -> str:
    """The folder as a path of the mounted file system."""
    return folder.removeprefix("file://") if folder.startswith("file:///") else folder.removeprefix("file:")


def checksum(path: str, size: int) -> int:
    with open(path, "rb") as file:
        return zlib.crc32(file.read(size))


def end_of_last_line(path: str, size: int) -> int:
    """The place behind the last line feed within the first `size` bytes; 0 without one."""
    with open(path, "rb") as file:
        end = size
        while end > 0:
            begin = max(0, end - CHUNK)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


@dataclass
class Span(InputPartition):
    """The lines that begin within [begin, end) of a file; what was read of the file before ends at `begin` or earlier."""

    folder: str
    pattern: str
    identity: str
    head: int
    head_size: int
    first: int
    begin: int
    end: int


def files_in(folder: str, pattern: str) -> Iterator[tuple[str, str, int]]:
    """(identity, path, size) of the files of a folder. A file that goes while it is looked at is passed over."""
    for name in sorted(os.listdir(folder)):
        if fnmatch.fnmatch(name, pattern):
            path = os.path.join(folder, name)
            try:
                known = os.stat(path)
            except FileNotFoundError:
                continue
            if os.path.isfile(path):
                yield f"{known.st_dev}:{known.st_ino}", path, known.st_size


class GrowingFileReader(DataSourceStreamReader):
    """The offset holds, for each file, the place behind its last finished line, and a checksum of its beginning."""

    def __init__(self, options: dict):
        self.folder, self.pattern = local_path(options["path"]), options.get("pattern", "*")
        self.split = int(options.get("splitBytes", SPLIT))
        self.from_end = options.get("startingOffsets", "earliest") == "latest"

    def _now(self) -> dict:
        found = {}
        for identity, path, size in files_in(self.folder, self.pattern):
            try:
                end = end_of_last_line(path, size)
                head_size = min(HEAD, end)
                found[identity] = {"byte": end, "headSize": head_size, "head": checksum(path, head_size)}
            except FileNotFoundError:
                continue
        return found

    def initialOffset(self) -> dict:
        return {"files": self._now() if self.from_end else {}}

    def latestOffset(self) -> dict:
        return {"files": self._now()}

    def _begin(self, before: dict | None, after: dict, path: str) -> int:
        """Where the new lines of a file begin: behind those read before, or at 0 if this is another file, or one that was cut."""
        if before is None or before["byte"] > after["byte"]:
            return 0
        return before["byte"] if checksum(path, before["headSize"]) == before["head"] else 0

    def partitions(self, start: dict, end: dict) -> list[Span]:
        paths = {identity: path for identity, path, _ in files_in(self.folder, self.pattern)}
        spans = []
        for identity, after in sorted(end["files"].items()):
            before = start["files"].get(identity)
            if before == after or not after["byte"]:
                continue
            if identity not in paths:
                raise FileNotFoundError(f"a file of {self.folder} went before its lines were read up to byte {after['byte']}")
            first = self._begin(before, after, paths[identity])
            for begin in range(first, after["byte"], self.split):
                stop = min(begin + self.split, after["byte"])
                spans.append(Span(self.folder, self.pattern, identity, after["head"], after["headSize"], first, begin, stop))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        """Batches of file, byte and value. A file renamed since it was planned is found by its identity."""
        for identity, path, _ in files_in(partition.folder, partition.pattern):
            if identity == partition.identity and checksum(path, partition.head_size) == partition.head:
                return lines_of(path, partition.first, partition.begin, partition.end)
        raise FileNotFoundError(f"file {partition.identity} of {partition.folder} went, or was cut, before it was read")


def lines_of(path: str, first: int, begin: int, end: int) -> Iterator[pa.RecordBatch]:
    """The lines that begin in [begin, end); one that began before `begin`, but not before `first`, belongs to the task before."""
    name = os.path.basename(path)
    with open(path, "rb") as file:
        at = begin
        if begin > first:
            file.seek(begin - 1)
            at = begin - 1 + len(file.readline())
        else:
            file.seek(begin)
        while at < end:
            starts, values, size = [], [], 0
            while at < end and size < CHUNK:
                line = file.readline()
                if not line.endswith(b"\n"):
                    raise OSError(f"{path} was cut while it was read")
                starts.append(at)
                values.append(line[:-1].removesuffix(b"\r").decode("utf-8", "replace"))
                at += len(line)
                size += len(line)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(starts)), pa.array(starts, pa.int64()), pa.array(values, pa.string())], schema=SCHEMA)


class GrowingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing"

    def schema(self) -> str:
        return "file string, byte bigint, value string"

    def streamReader(self, schema) -> GrowingFileReader:
        return GrowingFileReader(self.options)


def growing_lines(spark: SparkSession, folder: str, pattern: str = "*", from_end: bool = False, **options) -> DataFrame:
    """The lines of all files of a folder that match `pattern`, as they are finished: file, byte where the line begins, value.

    A last line without a line feed waits for its end. A file that was renamed is followed if its new name matches too; one that
    became shorter, or whose beginning changed, is read anew. An empty file has no lines, an empty line is a line.
    Bytes that are no UTF-8 are replaced. With `from_end` only what comes after the start is read.
    """
    spark.dataSource.register(GrowingFiles)
    reader = spark.readStream.format("growing").option("pattern", pattern).options(**options)
    return reader.option("startingOffsets", "latest" if from_end else "earliest").load(folder)
