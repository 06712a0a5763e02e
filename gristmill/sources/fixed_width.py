"""`token_records`: files of little-endian int32, L ids per record, as a Spark data source.

    spark.dataSource.register(TokenRecords)
    spark.read.format("token_records").option("length", 256).load(path)
    df.write.format("token_records").option("length", 256).mode("append").save(path)

Reading splits every file into byte ranges that start on a record. Each writing task puts
out its own file; the commit lists the files of successful attempts in `_files.json`, and
a reader trusts that list where it exists, so lost or repeated tasks leave nothing behind
that is read.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

RANGE_BYTES = 64 * 1024 * 1024
BATCH_RECORDS = 4_096
LISTING = "_files.json"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        raise ValueError(f"{path} names no file system; executors can't know which one is meant")
    scheme, rest = path.split(":", 1)
    return pafs.FileSystem.from_uri(path if rest.startswith("//") else f"{scheme}://{rest}")


def _data_files(path: str) -> list[tuple[str, int]]:
    system, root = _open(path)
    info = system.get_file_info(root)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [(root, info.size)]
    entries = system.get_file_info(pafs.FileSelector(root, recursive=False))
    by_name = {posixpath.basename(e.path): e for e in entries if e.type == pafs.FileType.File}
    if LISTING in by_name:
        with system.open_input_stream(posixpath.join(root, LISTING)) as f:
            names = json.loads(f.read())
    else:
        names = sorted(n for n in by_name if n.endswith(".bin"))
    return [(by_name[n].path, by_name[n].size) for n in names]


@dataclass
class ByteRange(InputPartition):
    file: str
    start: int
    records: int
    first_record: int

    def __init__(self, file: str, start: int, records: int, first_record: int) -> None:
        self.file, self.start, self.records, self.first_record = file, start, records, first_record
        super().__init__(None)


class _Reader(DataSourceReader):
    def __init__(self, path: str, length: int) -> None:
        self.path, self.length = path, length

    def partitions(self) -> list[ByteRange]:
        width = 4 * self.length
        step = max(1, RANGE_BYTES // width)
        out, seen = [], 0
        for file, size in _data_files(self.path):
            if size % width:
                raise ValueError(f"{file}: {size} bytes are no whole number of records of {self.length} ids")
            for at in range(0, size // width, step):
                n = min(step, size // width - at)
                out.append(ByteRange(file, at * width, n, seen + at))
            seen += size // width
        return out or [ByteRange("", 0, 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if part.records == 0:
            return
        system, _ = _open(self.path)
        done = 0
        with system.open_input_file(part.file) as f:
            f.seek(part.start)
            while done < part.records:
                n = min(BATCH_RECORDS, part.records - done)
                ids = np.frombuffer(f.read(n * 4 * self.length), dtype="<i4")
                offsets = np.arange(0, (n + 1) * self.length, self.length, dtype=np.int32)
                number = np.arange(part.first_record + done, part.first_record + done + n, dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array(number), lists], names=["record_no", "input_ids"])
                done += n


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    records: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, length: int, overwrite: bool) -> None:
        self.path, self.length, self.overwrite = path, length, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        records = 0
        with system.open_output_stream(posixpath.join(root, name)) as f:
            for batch in iterator:
                column = batch.column("input_ids")
                values = column.flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(column.offsets.to_numpy())
                if len(sizes) and (sizes != self.length).any():
                    raise ValueError(f"every record needs exactly {self.length} ids")
                f.write(np.ascontiguousarray(values, dtype="<i4").tobytes())
                records += batch.num_rows
        return Written(task.partitionId(), name, records)

    def commit(self, messages: list[Written]) -> None:
        system, root = _open(self.path)
        names = [m.name for m in sorted((m for m in messages if m), key=lambda m: m.partition) if m.records]
        listing = posixpath.join(root, LISTING)
        if not self.overwrite and system.get_file_info(listing).type == pafs.FileType.File:
            with system.open_input_stream(listing) as f:
                names = json.loads(f.read()) + names
        with system.open_output_stream(listing) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list[Written]) -> None:
        system, root = _open(self.path)
        for m in messages:
            if m:
                system.delete_file(posixpath.join(root, m.name))


class TokenRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_records"

    def schema(self) -> str:
        return "record_no bigint, input_ids array<int>"

    def _args(self) -> tuple[str, int]:
        return self.options["path"], int(self.options["length"])

    def reader(self, schema) -> _Reader:
        return _Reader(*self._args())

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(*self._args(), overwrite)
