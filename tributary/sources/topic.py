"""Topics of text records on files, with offsets (S1, S2): a stream source, its batch form and the writer.

A topic is a folder with a folder per partition; a partition is a sequence of segments, files of one record a line
that never change, named by the offset of their first record and their number of records.  So the end of a topic is
known from a listing, and a record has the same offset for every reader and after every restart.

``read_topic`` gives (partition, offset, value).  A stream starts at ``earliest``, ``latest`` or given offsets ({partition:
offset}) and resumes from its checkpoint; ``max_records`` bounds a micro-batch.  Each task reads a bounded
range of one partition.  Paths may lie on any file system that pyarrow opens (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RECORD = "partition int, offset long, value string"
RECORDS_A_TASK = 1_000_000
ROWS_A_BATCH = 10_000


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """partition -> [(first offset, records, file)] in order, from a listing."""
    fs, root = _file_system(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        folder, _, name = info.path.rpartition("/")
        if info.type == pafs.FileType.File and name.endswith(".txt") and "/partition=" in folder and not name.startswith(("_", ".")):
            first, _, n = name.removesuffix(".txt").partition("-")
            out.setdefault(int(folder.rpartition("=")[2]), []).append((int(first), int(n), info.path))
    return {p: sorted(s) for p, s in sorted(out.items())}


def ends(path: str) -> dict[int, int]:
    """partition -> the offset behind its last record."""
    return {p: s[-1][0] + s[-1][1] for p, s in segments(path).items()}


class Range(InputPartition):
    """Records ``start`` to ``end`` of one segment file."""

    def __init__(self, partition: int, file: str, first: int, start: int, end: int):
        self.partition, self.file, self.first, self.start, self.end = partition, file, first, start, end


def ranges(path: str, start: dict[int, int], end: dict[int, int]) -> list[Range]:
    out = []
    for p, parts in segments(path).items():
        lo, hi = start.get(p, 0), end.get(p, 0)
        for first, n, file in parts:
            a, b = max(lo, first), min(hi, first + n)
            out += [Range(p, file, first, x, min(x + RECORDS_A_TASK, b)) for x in range(a, b, RECORDS_A_TASK)]
    return out


def _records(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    fs, _ = _file_system(path)
    values, at = [], part.first

    def batch() -> pa.RecordBatch:
        n = len(values)
        return pa.RecordBatch.from_arrays([pa.array([part.partition] * n, pa.int32()), pa.array(range(at - n, at), pa.int64()),
                                           pa.array(values, pa.string())], names=["partition", "offset", "value"])
    with fs.open_input_stream(part.file) as stream:
        for line in _lines(stream):
            if at >= part.end:
                break
            if at >= part.start:
                values.append(line)
                at += 1
                if len(values) >= ROWS_A_BATCH:
                    yield batch()
                    values = []
            else:
                at += 1
    if values:
        yield batch()


def _lines(stream, size: int = 1 << 20) -> Iterator[str]:
    rest = b""
    while block := stream.read(size):
        *whole, rest = (rest + block).split(b"\n")
        yield from (x.decode("utf-8") for x in whole)
    if rest:
        yield rest.decode("utf-8")


class TopicReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Range]:
        return ranges(self.path, {}, ends(self.path)) or [Range(0, "", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _records(self.path, partition) if partition.file else iter(())


class TopicStreamReader(DataSourceStreamReader):
    """Offsets are {partition: offset of the next record}."""

    def __init__(self, path: str, start: str, max_records: int | None, progress: str | None):
        self.path, self.start, self.max_records, self.progress = path, start, max_records, progress

    @staticmethod
    def _told(offsets: dict[int, int]) -> dict:
        return {str(p): n for p, n in offsets.items()}

    def initialOffset(self) -> dict:
        if self.start == "earliest":
            return {}
        if self.start == "latest":
            return self._told(ends(self.path))
        return self._told({int(p): int(n) for p, n in json.loads(self.start).items()})

    def latestOffset(self) -> dict:
        there = ends(self.path)
        if self.max_records is None:
            return self._told(there)
        # the engine does not say where it stands, so the last end that was told is kept beside the checkpoint
        last = self._last()
        left, out = self.max_records, {}
        for p, n in there.items():
            at = last.get(p, 0)
            out[p] = min(n, at + left) if n > at else at
            left -= out[p] - at
        self._keep(out)
        return self._told(out)

    def _last(self) -> dict[int, int]:
        fs, path = _file_system(self.progress)
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return {int(p): n for p, n in self.initialOffset().items()}
        with fs.open_input_stream(path) as f:
            return {int(p): n for p, n in json.loads(f.read()).items()}

    def _keep(self, offsets: dict[int, int]) -> None:
        fs, path = _file_system(self.progress)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        new = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(new) as f:
            f.write(json.dumps(self._told(offsets)).encode())
        fs.move(new, path)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(self.path, {int(p): n for p, n in start.items()}, {int(p): n for p, n in end.items()})

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _records(self.path, partition)

    def commit(self, end: dict) -> None:
        pass        # records stay; their owner removes old segments


class TopicSource(DataSource):
    """``spark.read/readStream.format("segments")`` with ``path``, ``startingOffsets``, ``maxRecordsPerTrigger`` and, where that
    is given, ``progress`` (a file of this query, beside its checkpoint)."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema) -> TopicStreamReader:
        limit = self.options.get("maxRecordsPerTrigger")
        if limit and not self.options.get("progress"):
            raise ValueError("maxRecordsPerTrigger needs the option progress")
        return TopicStreamReader(self.options["path"], self.options.get("startingOffsets", "earliest"),
                                 int(limit) if limit else None, self.options.get("progress"))


def read_topic(spark: SparkSession, path: str, stream: bool = False, start: str | dict[int, int] = "earliest",
               max_records: int | None = None, progress: str | None = None) -> DataFrame:
    """(partition, offset, value) of a topic.  ``start`` counts where a stream has no checkpoint yet."""
    if max_records is not None and not progress:
        raise ValueError("max_records needs progress, a file of this query beside its checkpoint")
    spark.dataSource.register(TopicSource)
    reader = (spark.readStream if stream else spark.read).format("segments").option("path", path)
    if stream:
        reader = reader.option("startingOffsets", start if isinstance(start, str) else json.dumps(start))
        if max_records is not None:
            reader = reader.option("maxRecordsPerTrigger", max_records).option("progress", progress)
    return reader.load()


def append_segments(rows: DataFrame, path: str, order: str) -> None:
    """Appends (partition, ``order``, value) rows to a topic: one segment a partition, in the order of ``order``.

    Line breaks inside a value become blanks, as a topic of lines must have them.  A segment is written under
    another name and moved into its place, so a reader sees whole segments only, and a task that is repeated
    writes the same one.  One producer appends at a time.
    """
    there = ends(path)
    run = uuid.uuid4().hex
    last = Window.partitionBy("partition")
    rows = rows.select("partition", F.col(order).alias("at"), F.translate("value", "\n\r", "  ").alias("value")).withColumn("n", F.count("*").over(last))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(path)
        now, out, place = None, None, None

        def close():
            if out is not None:
                out.close()
                fs.move(*place)
        for batch in batches:
            for p, n, value in zip(*(batch.column(c).to_pylist() for c in ("partition", "n", "value"))):
                if p != now:
                    close()
                    now, folder = p, f"{root}/partition={p}"
                    fs.create_dir(folder, recursive=True)
                    place = (f"{folder}/.{run}-{uuid.uuid4().hex}", f"{folder}/{there.get(p, 0):020d}-{n}.txt")
                    out = fs.open_output_stream(place[0])
                out.write((value or "").encode("utf-8") + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
        close()
    written = rows.repartition("partition").sortWithinPartitions("partition", "at").mapInArrow(task, "n long")
    written.agg(F.sum("n")).collect()
