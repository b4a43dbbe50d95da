"""Arrow IPC files as a Spark data source: one zstd-compressed file per partition."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "arrow_ipc"
PENDING = "_pending"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(root))
    return sorted(f.path for f in found if f.is_file and f.path.endswith(".arrow"))


@dataclass
class WrittenFile(WriterCommitMessage):
    pending: str
    name: str


class ArrowFileWriter(DataSourceArrowWriter):
    """Tasks write under ``_pending``; the files of finished tasks are moved in on commit, so a
    task that runs twice leaves one file."""

    def __init__(self, path: str, schema: StructType, compression: str, overwrite: bool):
        self.path = path
        self.schema = to_arrow_schema(schema)
        self.compression = compression
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{self.job}.arrow"
        fs, root = _open(self.path)
        folder = f"{root}/{PENDING}-{self.job}"
        fs.create_dir(folder, recursive=True)
        pending = f"{folder}/{uuid.uuid4().hex}"
        options = pa.ipc.IpcWriteOptions(
            compression=None if self.compression == "none" else self.compression
        )
        with (
            fs.open_output_stream(pending) as sink,
            pa.ipc.new_file(sink, self.schema, options=options) as out,
        ):
            for batch in iterator:
                out.write_batch(batch.cast(self.schema))
        return WrittenFile(pending, name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        before = _files(self.path) if self.overwrite else []
        for message in messages:
            if isinstance(message, WrittenFile):
                fs.move(message.pending, f"{root}/{message.name}")
        for old in before:
            fs.delete_file(old)
        self._drop_pending()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop_pending()

    def _drop_pending(self) -> None:
        fs, root = _open(self.path)
        folder = f"{root}/{PENDING}-{self.job}"
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class ArrowFileReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path = path
        self.schema = to_arrow_schema(schema)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in _files(self.path)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        fs, _ = _open(self.path)
        with fs.open_input_file(partition.value) as source:
            file = pa.ipc.open_file(source)
            for i in range(file.num_record_batches):
                yield file.get_batch(i).cast(self.schema)


class ArrowFiles(DataSource):
    """``format("arrow_ipc")``; option ``compression`` is zstd, lz4 or none."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no Arrow files in '{self.options['path']}'")
        fs, _ = _open(self.options["path"])
        with fs.open_input_file(files[0]) as source:
            return from_arrow_schema(pa.ipc.open_file(source).schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowFileReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return ArrowFileWriter(
            self.options["path"], schema, self.options.get("compression", "zstd"), overwrite
        )


def write_arrow(df: DataFrame, path: str, compression: str = "zstd") -> str:
    """A folder of Arrow files, one per partition (operator B-9); files that were there are replaced."""
    df.sparkSession.dataSource.register(ArrowFiles)
    df.write.format(FORMAT).option("compression", compression).mode("overwrite").save(path)
    return path


def read_arrow(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(ArrowFiles)
    return spark.read.format(FORMAT).load(path)
