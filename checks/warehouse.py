"""A small warehouse behind Spark's data source API, which stands for a real connector.

A table is a folder of files and a list of those that count. Tasks write their files
beside it; the commit puts the new list in place of the old one, an abort removes the
files. ``fail_at`` lets the task that meets this row number fail, after it has
written a file.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "checks_warehouse"


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class Store:
    """Files of one table below the warehouse's folder."""

    def __init__(self, options: dict[str, str]):
        self.root, self.table = options["root"].rstrip("/"), options["table"]
        self.fail_at = int(options.get("fail_at", -1))

    def _at(self, *names: str) -> tuple[pafs.FileSystem, str]:
        fs, root = pafs.FileSystem.from_uri(self.root)
        return fs, posixpath.join(root, self.table, *names)

    def list(self) -> dict | None:
        fs, path = self._at("list.json")
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(path) as file:
            return json.loads(file.read())

    def put_list(self, content: dict) -> None:
        fs, path = self._at("list.json")
        own = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            out.write(json.dumps(content).encode())
        fs.move(own, path)

    def put(self, file: str, table: pa.Table) -> None:
        fs, path = self._at(file)
        fs.create_dir(posixpath.dirname(path), recursive=True)
        with fs.open_output_stream(path) as out:
            pq.write_table(table, out)

    def get(self, file: str) -> pa.Table:
        fs, path = self._at(file)
        with fs.open_input_file(path) as source:
            return pq.read_table(source)

    def drop(self, folder: str) -> None:
        fs, path = self._at(folder)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)

    def mark(self, name: str) -> None:
        fs, path = self._at(name)
        fs.create_dir(posixpath.dirname(path), recursive=True)
        fs.open_output_stream(path).close()

    def marked(self, name: str) -> bool:
        fs, path = self._at(name)
        return fs.get_file_info(path).type == pafs.FileType.File

    def folders(self) -> list[str]:
        fs, path = self._at()
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return sorted(x.base_name for x in found if x.type == pafs.FileType.Directory)


class _Reader(DataSourceReader):
    def __init__(self, store: Store):
        self.store = store

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in self.store.list()["files"]] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value:
            yield from self.store.get(partition.value).to_batches()


class _Writer(DataSourceArrowWriter):
    def __init__(self, store: Store, schema: StructType, overwrite: bool):
        self.store, self.schema, self.overwrite = store, schema, overwrite
        self.folder = f"job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        batches = list(iterator)
        if not batches:
            return Written("", 0)
        file = f"{self.folder}/{uuid.uuid4().hex}.parquet"
        table = pa.Table.from_batches(batches)
        self.store.put(file, table)
        # The job may have been aborted while this task was still at work.
        if self.store.marked(f"{self.folder}.aborted"):
            self.store.drop(self.folder)
        if 0 <= self.store.fail_at < table.num_rows:
            raise OSError("the warehouse is full")
        return Written(file, table.num_rows)

    def commit(self, messages: list[Written]) -> None:
        before = self.store.list() or {"files": []}
        files = [m.file for m in messages if m and m.file]
        if not self.overwrite:
            files = before["files"] + files
        self.store.put_list({"schema": self.schema.json(), "files": files})
        for folder in set(self.store.folders()) - {posixpath.dirname(f) for f in files}:
            self.store.drop(folder)

    def abort(self, messages: list[Written | None]) -> None:
        self.store.mark(f"{self.folder}.aborted")
        self.store.drop(self.folder)


class Warehouse(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        found = Store(self.options).list()
        if found is None:
            raise ValueError(f"no table {self.options['table']}")
        return StructType.fromJson(json.loads(found["schema"]))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(Store(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(Store(self.options), schema, overwrite)


def register(spark: SparkSession) -> str:
    """Make the warehouse known to the session; returns its format."""
    spark.dataSource.register(Warehouse)
    return FORMAT
