"""All-or-nothing export to a folder: tasks stage files, one manifest names those that count, and readers see only what it names.

    target/staged/<export>/<task files>     what tasks wrote, named or not
    target/manifests/<version>.json         files with their rows and bytes, and the schema; the highest version is the table

A manifest is written under another name and renamed, so a reader sees the table before an export or after it. An export that
fails, or whose commit fails, leaves the manifest before it, and with it the table, as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

STAGED, MANIFESTS = "staged", "manifests"
#: Bytes of files that one task reads.
SPLIT = 128 << 20


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URL, and the path in it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file://{path.removeprefix('file:')}")


@dataclass(frozen=True)
class Manifest:
    """Version 0 is a table that was never written."""

    version: int = 0
    schema: str = ""
    files: tuple = ()

    @property
    def rows(self) -> int:
        return sum(f["rows"] for f in self.files)


def current_manifest(path: str) -> Manifest:
    store, folder = located(path)
    found = store.get_file_info(fs.FileSelector(f"{folder}/{MANIFESTS}", allow_not_found=True))
    versions = [int(f.base_name.removesuffix(".json")) for f in found if f.base_name.removesuffix(".json").isdigit()]
    if not versions:
        return Manifest()
    with store.open_input_stream(f"{folder}/{MANIFESTS}/{max(versions)}.json") as file:
        known = json.loads(file.read())
    return Manifest(max(versions), known["schema"], tuple(known["files"]))


def publish(path: str, manifest: Manifest) -> None:
    """Makes a manifest the current one by one rename."""
    store, folder = located(path)
    store.create_dir(f"{folder}/{MANIFESTS}", recursive=True)
    draft = f"{folder}/{MANIFESTS}/{uuid.uuid4().hex}.draft"
    with store.open_output_stream(draft) as file:
        file.write(json.dumps({"schema": manifest.schema, "files": list(manifest.files)}).encode())
    store.move(draft, f"{folder}/{MANIFESTS}/{manifest.version}.json")


@dataclass
class StagedFile(WriterCommitMessage):
    """What a task that finished has written; `name` is None for a task without rows."""

    name: str | None
    rows: int = 0
    size: int = 0


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.base = current_manifest(path)
        self.export = uuid.uuid4().hex
        if not overwrite and self.base.version and StructType.fromJson(json.loads(self.base.schema)) != schema:
            raise ValueError(f"{path} holds rows of another schema")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> StagedFile:
        """One file for each attempt, under a name of its own: of attempts of one task the last one to finish is named."""
        store, folder = located(self.path)
        name = f"{STAGED}/{self.export}/{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        try:
            for batch in iterator:
                if writer is None:
                    store.create_dir(f"{folder}/{STAGED}/{self.export}", recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=store)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        if writer is None:
            return StagedFile(None)
        return StagedFile(name, rows, store.get_file_info(f"{folder}/{name}").size)

    def commit(self, messages: list[StagedFile | None]) -> None:
        """Names the files of this export, after those of the table if it appends, and takes away what no attempt's message names."""
        own = [{"name": m.name, "rows": m.rows, "size": m.size} for m in messages if m is not None and m.name]
        before = current_manifest(self.path)
        if before.version != self.base.version:
            raise RuntimeError(f"{self.path} was exported to meanwhile")
        kept = [] if self.overwrite else list(before.files)
        publish(self.path, Manifest(before.version + 1, json.dumps(self.schema.jsonValue()), tuple(kept + own)))
        self._clear({f["name"] for f in own})

    def abort(self, messages: list[StagedFile | None]) -> None:
        self._clear(set())

    def _clear(self, named: set[str]) -> None:
        store, folder = located(self.path)
        for file in store.get_file_info(fs.FileSelector(f"{folder}/{STAGED}/{self.export}", allow_not_found=True)):
            if f"{STAGED}/{self.export}/{file.base_name}" not in named:
                store.delete_file(file.path)


@dataclass
class Files(InputPartition):
    names: list[str]


class StagedReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path = path
        self.arrow = to_arrow_schema(schema)
        self.files = current_manifest(path).files

    def partitions(self) -> list[Files]:
        """Files together up to SPLIT bytes; a table without rows is one partition without files."""
        parts, size = [Files([])], 0
        for file in self.files:
            if size and size + file["size"] > SPLIT:
                parts.append(Files([]))
                size = 0
            parts[-1].names.append(file["name"])
            size += file["size"]
        return parts

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, folder = located(self.path)
        for name in partition.names:
            with store.open_input_file(f"{folder}/{name}") as file:
                for batch in pq.ParquetFile(file).iter_batches():
                    yield batch.cast(self.arrow) if batch.schema != self.arrow else batch


class StagedTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "staged"

    def schema(self) -> StructType:
        manifest = current_manifest(self.options["path"])
        if not manifest.version:
            raise FileNotFoundError(f"nothing was exported to {self.options['path']}")
        return StructType.fromJson(json.loads(manifest.schema))

    def reader(self, schema: StructType) -> StagedReader:
        return StagedReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> StagedWriter:
        return StagedWriter(self.options["path"], schema, overwrite)


def export_staged(rows: DataFrame, path: str, overwrite: bool = True) -> int:
    """Writes `rows` as the table at `path`, or appends them to it, all or nothing; returns how many rows the table has then.

    Each task writes one file, so the scan runs as wide as it is. Two exports at once: the later one fails.
    """
    rows.sparkSession.dataSource.register(StagedTable)
    rows.write.format("staged").mode("overwrite" if overwrite else "append").save(path)
    return current_manifest(path).rows


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last export that finished."""
    spark.dataSource.register(StagedTable)
    return spark.read.format("staged").load(path)
