"""A streaming source that follows growing text files by byte position."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidewatch.sources.files import local_path, opened, remote_store
from tidewatch.sources.jsonl import parse_lines

FORMAT = "tailed_lines"
SCHEMA = "value binary, file string, position long"
#: Bytes of a task, of a step while reading, and of a file's beginning that identifies it.
TASK_BYTES, STEP_BYTES, HEAD_BYTES = 64 << 20, 1 << 20, 1024
ROWS = 10_000


def _listed(path: str) -> list[tuple[str, int, int]]:
    """(file, size, time of change) of a file, of a folder's files or of those that match its `*`."""
    folder, _, pattern = path.rpartition("/")
    before, star, after = pattern.partition("*")
    local = local_path(folder if star else path)
    if local:
        if os.path.isdir(local):
            found = [(x.path, x.stat()) for x in os.scandir(local) if x.is_file()]
        else:
            found = [(local, os.stat(local))] if os.path.isfile(local) else []
        files = [(name, s.st_size, s.st_mtime_ns) for name, s in found]
    else:
        fs, store, inner = remote_store(folder if star else path)
        (whole,) = store.get_file_info([inner])
        infos = [whole] if whole.type == fs.FileType.File else store.get_file_info(
            fs.FileSelector(inner, allow_not_found=True))
        scheme = path[:path.index(inner)]
        files = [(scheme + x.path, x.size, x.mtime_ns) for x in infos if x.type == fs.FileType.File]
    base = lambda name: name.rpartition("/")[2]
    return [f for f in files if base(f[0])[0] not in "._" and (
        not star or base(f[0]).startswith(before) and base(f[0]).endswith(after))]


@dataclass
class ByteRange(InputPartition):
    """Lines that start at `begin` or later and before `end`, a position behind a line's end."""

    file: str
    begin: int
    end: int
    first: bool


class TailReader(DataSourceStreamReader):
    """Offsets are {file: {at, head, crc}}: the position up to which whole lines were handed on,
    and the checksum of the file's first `head` bytes."""

    def __init__(self, path: str, task_bytes: int):
        self.path, self.task_bytes = path, task_bytes
        self.known: dict[str, tuple] = {}  # per file: size, time of change, offset

    def initialOffset(self) -> dict:
        return {}

    @staticmethod
    def _crc(file: str, size: int) -> int:
        if not size:
            return 0
        with opened(file) as source:
            return zlib.crc32(source.read(size))

    def _end(self, file: str, size: int) -> dict:
        """Where the last whole line of a file ends."""
        at, seen = 0, size
        with opened(file) as source:
            while seen > 0 and not at:
                begin = max(0, seen - STEP_BYTES)
                source.seek(begin)
                found = source.read(seen - begin).rfind(b"\n")
                at, seen = (begin + found + 1 if found >= 0 else 0), begin
        head = min(HEAD_BYTES, at)
        return {"at": at, "head": head, "crc": self._crc(file, head)}

    def latestOffset(self) -> dict:
        out = {}
        for file, size, changed in _listed(self.path):
            held = self.known.get(file)
            if held is None or held[:2] != (size, changed):
                held = size, changed, self._end(file, size)
                self.known[file] = held
            out[file] = held[2]
        return out

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        """New bytes in ranges; a file that shrank or begins with other bytes is read anew."""
        out = []
        for file, upto in sorted(end.items()):
            last = start.get(file)
            begin = 0
            if last and last["at"] <= upto["at"] and (
                    last == upto or last["crc"] == self._crc(file, last["head"])):
                begin = last["at"]
            for at in range(begin, upto["at"], self.task_bytes):
                out.append(ByteRange(file, at, min(at + self.task_bytes, upto["at"]), at == begin))
        return out

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        lines, places = [], []
        with opened(partition.file) as source:
            # a range in the middle of a line leaves that line to the range before it
            at = partition.begin if partition.first else partition.begin - 1
            source.seek(at)
            skip, rest = not partition.first, b""
            while at < partition.end or rest:
                step = source.read(STEP_BYTES)
                if not step:
                    break
                parts = (rest + step).split(b"\n")
                rest = parts.pop()
                for part in parts:
                    if not skip and at < partition.end:
                        lines.append(part)
                        places.append(at)
                    skip = False
                    at += len(part) + 1
                    if len(lines) == ROWS:
                        yield self._batch(partition.file, lines, places)
                        lines, places = [], []
                if at >= partition.end:
                    break
        if lines:
            yield self._batch(partition.file, lines, places)

    @staticmethod
    def _batch(file: str, lines: list[bytes], places: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.binary()), pa.array([file] * len(lines)), pa.array(places, pa.int64())],
            names=["value", "file", "position"])


class TailedLines(DataSource):
    """`path` is a file, a folder or a folder with one `*` in the name; `taskBytes` cuts ranges."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("taskBytes", TASK_BYTES)))


def tail_lines(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(value, file, position) of the whole lines of growing files, as a stream.

    Every trigger reads what was appended since the last one, from the byte positions in the query's
    checkpoint, in ranges spread over the executors; a line whose end isn't written yet waits. A file
    that was cut off or replaced is read from its beginning; files may come and go. The path must be
    open to the driver and the executors alike: a shared mount, or a store that Arrow reads.
    """
    spark.dataSource.register(TailedLines)
    return spark.readStream.format(FORMAT).option("taskBytes", task_bytes).load(path)


def tail_jsonl(spark: SparkSession, path: str, schema: T.StructType, source: str | None = None,
               task_bytes: int = TASK_BYTES) -> DataFrame:
    """Records of growing JSON-lines files; broken lines and lines that are no object are dropped."""
    lines = tail_lines(spark, path, task_bytes).select(
        F.col("value").cast("string").alias("value"), "file", "position")
    out = parse_lines(lines, schema, "drop")
    return out.withColumn("source", F.lit(source)) if source else out
