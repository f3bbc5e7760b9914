"""Keyed rows in files, as a data source of Spark's own kind.

    register(spark)
    rows.write.format("keyed").mode("append").save(path)         # or "overwrite"
    spark.read.format("keyed").load(path)                        # everything
    spark.read.format("keyed").option("key", "a").load(path)     # the rows of one key

For what otherwise lies in a key/value store: hashes ``(key, field, value)``, and texts and
blobs ``(key, ..., value)``. A string column ``key`` must be there, all other columns are free.

Every task streams its rows into an Arrow file of its own, in compressed blocks of bounded
size, and reports the file's name and the least and greatest key. The driver then puts a
manifest in place, the last step of a write: until then readers see what was there before, and
a write that fails deletes what its finished tasks reported. Files of tasks that were lost,
killed or ran twice are in no manifest, and ``remove_superseded`` sweeps them away. A manifest
has one entry per file, not per row or key.

Reading is split by files, and large files by blocks. With the option ``key`` only files whose
range holds the key are opened, so rows that are sorted by key over the whole table
(``orderBy``) make such reads cheap; a null key is found by reading everything only.

Paths are those of ``pyarrow.fs``: local or mounted folders, ``s3``, ``gs``, ``abfs``, ``hdfs``.
One writer at a time; a second one at the same moment could take the same manifest number.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StringType, StructType

# A block of a file, and what one task reads of it.
BLOCK_BYTES = 8 << 20
SPLIT_BYTES = 64 << 20


@dataclass(frozen=True)
class Segment(WriterCommitMessage):
    """A file of rows. ``low`` and ``high`` are null if it has null keys only. Without blocks
    there is no file: a task that had no rows."""

    name: str
    rows: int
    blocks: int
    size: int
    low: str | None
    high: str | None

    def may_hold(self, key: str) -> bool:
        # As pyarrow orders strings: by their bytes, which is by code point.
        return self.low is not None and self.low <= key <= self.high


@dataclass(frozen=True)
class Blocks(InputPartition):
    name: str
    first: int
    end: int


class Folder:
    """Where the rows and manifests of one table lie."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def open(self) -> tuple[pafs.FileSystem, str]:
        # Opened where it is used, as open clients do not travel to tasks.
        return pafs.FileSystem.from_uri(self.path)

    def file(self, name: str) -> tuple[pafs.FileSystem, str]:
        files, root = self.open()
        return files, f"{root}/rows/{name}"

    def delete(self, names: Sequence[str]) -> None:
        for name in names:
            files, path = self.file(name)
            if files.get_file_info(path).type != pafs.FileType.NotFound:
                files.delete_file(path)

    def names(self, kind: str) -> list[str]:
        files, root = self.open()
        found = files.get_file_info(pafs.FileSelector(f"{root}/{kind}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file)

    def manifest(self) -> tuple[int, dict | None]:
        """The number and content of the one that counts; 0 and None if there is none yet."""
        numbers = [int(n.removesuffix(".json")) for n in self.names("manifests")]
        if not numbers:
            return 0, None
        files, root = self.open()
        with files.open_input_stream(f"{root}/manifests/{max(numbers):010d}.json") as stream:
            return max(numbers), json.loads(stream.read())

    def segments(self) -> list[Segment]:
        _, content = self.manifest()
        return [Segment(**s) for s in content["segments"]] if content else []

    def commit(self, schema: StructType, segments: Sequence[Segment]) -> None:
        files, root = self.open()
        number, _ = self.manifest()
        content = {"schema": schema.jsonValue(), "segments": [asdict(s) for s in segments]}
        hidden, final = f"{root}/new-{uuid4().hex}", f"{root}/manifests/{number + 1:010d}.json"
        files.create_dir(f"{root}/manifests", recursive=True)
        with files.open_output_stream(hidden) as stream:
            stream.write(json.dumps(content).encode())
        files.move(hidden, final)


def key_range(keys: pa.Array, low: str | None, high: str | None) -> tuple[str | None, str | None]:
    found = pc.min_max(keys)
    if not found["min"].is_valid:
        return low, high
    least, greatest = found["min"].as_py(), found["max"].as_py()
    return (least if low is None else min(low, least)), (greatest if high is None else max(high, greatest))


def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """In blocks of about ``BLOCK_BYTES``, one row at least."""
    rows = max(1, batch.num_rows * BLOCK_BYTES // max(batch.nbytes, BLOCK_BYTES))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


class KeyedWriter(DataSourceArrowWriter):
    def __init__(self, folder: Folder, schema: StructType, overwrite: bool):
        self.folder, self.schema, self.overwrite = folder, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segment:
        name = f"{uuid4().hex}.arrow"
        files, path = self.folder.file(name)
        out = writer = low = high = None
        rows = blocks = 0
        try:
            for batch in iterator:
                for block in cut(batch):
                    if writer is None:
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        out = files.open_output_stream(path)
                        options = pa.ipc.IpcWriteOptions(compression="zstd")
                        writer = pa.ipc.new_file(out, block.schema, options=options)
                    writer.write_batch(block)
                    low, high = key_range(block.column("key"), low, high)
                    rows, blocks = rows + block.num_rows, blocks + 1
            if writer is None:
                return Segment(name, 0, 0, 0, None, None)
            writer.close()
            out.close()
        except BaseException:
            if out is not None:
                out.close()
                self.folder.delete([name])
            raise
        return Segment(name, rows, blocks, files.get_file_info(path).size, low, high)

    def commit(self, messages: list[Segment]) -> None:
        kept = [] if self.overwrite else self.folder.segments()
        self.folder.commit(self.schema, [*kept, *[m for m in messages if m.blocks]])

    def abort(self, messages: list[Segment | None]) -> None:
        # Tasks that failed have none.
        self.folder.delete([m.name for m in messages if m is not None])


class KeyedReader(DataSourceReader):
    def __init__(self, folder: Folder, key: str | None):
        self.folder, self.key = folder, key

    def partitions(self) -> list[Blocks]:
        out = []
        for s in self.folder.segments():
            if self.key is None or s.may_hold(self.key):
                tasks = min(s.blocks, -(-s.size // SPLIT_BYTES))
                bounds = [s.blocks * i // tasks for i in range(tasks + 1)]
                out += [Blocks(s.name, a, b) for a, b in zip(bounds, bounds[1:])]
        # Spark wants one partition at least.
        return out or [Blocks("", 0, 0)]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        if partition.first == partition.end:
            return
        files, path = self.folder.file(partition.name)
        with files.open_input_file(path) as source, pa.ipc.open_file(source) as reader:
            for i in range(partition.first, partition.end):
                block = reader.get_batch(i)
                if self.key is not None:
                    block = block.filter(pc.equal(block.column("key"), self.key))
                if block.num_rows:
                    yield block


class KeyedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed"

    def folder(self) -> Folder:
        if "path" not in self.options:
            raise ValueError("name a path in load() or save()")
        return Folder(self.options["path"])

    def schema(self) -> StructType:
        _, content = self.folder().manifest()
        if content is None:
            raise ValueError(f"no keyed rows in {self.options['path']}")
        return StructType.fromJson(content["schema"])

    def reader(self, schema: StructType) -> KeyedReader:
        return KeyedReader(self.folder(), self.options.get("key"))

    def writer(self, schema: StructType, overwrite: bool) -> KeyedWriter:
        if "key" not in schema.names or not isinstance(schema["key"].dataType, StringType):
            raise ValueError("keyed rows have a column named key, of type string")
        _, content = self.folder().manifest()
        if content is not None and not overwrite:
            before = [(f.name, f.dataType) for f in StructType.fromJson(content["schema"])]
            if before != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"rows there have the columns {before}")
        return KeyedWriter(self.folder(), schema, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format ``keyed`` known to a session. Its classes travel to the tasks, so the
    package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(KeyedSource)


def remove_superseded(path: str) -> int:
    """Deletes files that the manifest in force does not name, and earlier manifests, once nobody
    writes, or reads what was there before. Returns the number of files of rows."""
    folder = Folder(path)
    number, _ = folder.manifest()
    kept = {s.name for s in folder.segments()}
    old = [n for n in folder.names("rows") if n not in kept] if number else []
    folder.delete(old)
    files, root = folder.open()
    for name in folder.names("manifests"):
        if int(name.removesuffix(".json")) < number:
            files.delete_file(f"{root}/manifests/{name}")
    return len(old)
