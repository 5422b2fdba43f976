"""Run streaming queries to completion over staged topic files.

Topics are folders of packed JSON files.  ``ChunkedTopics`` writes the inputs of a job in
time-ordered chunks, cutting every topic of the job at the same instants (so both
sides of an interval join advance together); ``run_chunks`` appends one chunk, runs
the query with ``availableNow`` on the same checkpoint, and repeats.  Each chunk is
therefore one micro-batch, every restart resumes from the checkpoint (exactly-once file
sink), and no row is late merely because of how files were batched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path

# A packed file is read by one task: a chunk of a topic is dealt over many files, of bounded length at any size.
CHUNK_FILES = 32
LEAST_FILE_RECORDS, MOST_FILE_RECORDS = 5_000, 500_000


class ChunkedTopics:
    def __init__(self, spark: SparkSession, frames: dict[str, tuple[DataFrame, Column]],
                 n_chunks: int = 4, name: str = "job"):
        """``frames``: topic name -> (rows, epoch-ms event-time column)."""
        self.spark = spark
        self.n = n_chunks
        self.root = scratch_path(spark, "topics", f"{name}-{uuid.uuid4().hex}")
        # Each input is computed once, into a packed table beside its time; the range and every chunk are read from there.
        self.schemas = {}
        for topic, (df, t) in frames.items():
            self.schemas[topic] = df.schema
            df.withColumn("__at", t).write.option("compression", "zstd").parquet(self._staged(topic))
        # Global time range and rows over all topics: three numbers per topic reach the driver.
        bounds = [self._rows(topic).select(F.min("__at").alias("lo"), F.max("__at").alias("hi"), F.count("*").alias("n")).first()
                  for topic in frames]
        lo = min(b["lo"] for b in bounds if b["lo"] is not None)
        hi = max(b["hi"] for b in bounds if b["hi"] is not None)
        self._file_records = {topic: min(max(b["n"] // (n_chunks * CHUNK_FILES), LEAST_FILE_RECORDS), MOST_FILE_RECORDS)
                              for topic, b in zip(frames, bounds)}
        width = (hi - lo) // n_chunks + 1
        self.cuts = [lo + width * i for i in range(1, n_chunks)]

    def path(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def _staged(self, topic: str) -> str:
        return f"{self.root}/_staged/{topic}"

    def _rows(self, topic: str) -> DataFrame:
        return self.spark.read.parquet(self._staged(topic))

    def _in_chunk(self, i: int) -> Column:
        """Plain bounds, which the reader compares with those of a file's row groups; a row without a time comes with the
        first chunk."""
        at, last = F.col("__at"), self.n - 1
        if i == 0:
            return at.isNull() | (at < self.cuts[0]) if last else F.lit(True)
        return (at >= self.cuts[i - 1]) & ((at < self.cuts[i]) if i < last else F.lit(True))

    def chunk(self, topic: str, i: int) -> DataFrame | None:
        """The staged rows of chunk ``i``; None if no row of the topic falls into it."""
        rows = self._rows(topic).where(self._in_chunk(i)).drop("__at")
        return None if rows.isEmpty() else rows

    def _release(self, i: int, folder: str) -> None:
        for topic in self.schemas:
            part = self.chunk(topic, i)
            if part is not None:
                (part.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", self._file_records[topic])
                     .json(f"{self.path(topic)}/{folder}"))

    def write_chunk(self, i: int) -> None:
        self._release(i, f"chunk-{i:04d}")

    def write_replay(self, i: int, tag: str = "replay") -> None:
        """Append chunk ``i`` again as a new, later arrival (late data for the watermark)."""
        self._release(i, f"chunk-{tag}-{i:04d}")

    def read(self, topic: str, schema=None) -> DataFrame:
        """The topic as a stream (every chunk folder, in arrival order); the schema defaults
        to the schema the topic was staged with."""
        return (self.spark.readStream.schema(schema or self.schemas[topic])
                .json(f"{self.path(topic)}/*"))


def run_chunks(spark: SparkSession, topics: ChunkedTopics, build: Callable[[], DataFrame],
               name: str, output_mode: str = "append") -> DataFrame:
    """Run ``build()`` once per chunk with ``availableNow``; return the sink as a table."""
    out = scratch_path(spark, "sinks", f"{name}-{uuid.uuid4().hex}")
    ckpt = scratch_path(spark, "checkpoints", f"{name}-{uuid.uuid4().hex}")
    schema = None
    for i in range(topics.n):
        topics.write_chunk(i)
        df = build()
        schema = df.schema
        q = (df.writeStream.format("parquet").option("path", out)
               .option("checkpointLocation", ckpt).outputMode(output_mode)
               .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(schema).parquet(out)


@contextmanager
def without_empty_batches(spark: SparkSession):
    """No micro-batches without new data: a query with processing-time expiry would ask for one
    after another and a finite run would never end."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_chunks_foreach(spark: SparkSession, topics: ChunkedTopics, build: Callable[[], DataFrame],
                       handler: Callable[[DataFrame, int], None], name: str,
                       extra: Callable[[], None] | None = None) -> None:
    """Like :func:`run_chunks` but every micro-batch goes to ``handler(batch, batch_id)``.
    ``extra`` runs after the last chunk (for example a replay of old data) followed by one
    more ``availableNow`` run."""
    ckpt = scratch_path(spark, "checkpoints", f"{name}-{uuid.uuid4().hex}")
    steps = [lambda i=i: topics.write_chunk(i) for i in range(topics.n)]
    if extra is not None:
        steps.append(extra)
    for step in steps:
        step()
        q = (build().writeStream.foreachBatch(handler).option("checkpointLocation", ckpt)
               .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()


def run_available(df: DataFrame, handler: Callable[[DataFrame, int], None],
                      checkpoint: str) -> None:
    """Run ``df`` to completion with ``availableNow``, calling ``handler(batch, batch_id)``."""
    q = (df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()


def start_continuous(df: DataFrame, checkpoint: str, path: str | None = None,
                     handler: Callable[[DataFrame, int], None] | None = None,
                     interval: str = "5 seconds", output_mode: str = "append",
                     fmt: str = "parquet", name: str | None = None):
    """Start a long-running query: a micro-batch every ``interval``, state and progress
    checkpointed to ``checkpoint`` each batch (restarts resume exactly once).  Either a
    file sink at ``path`` or a ``foreachBatch`` ``handler``."""
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode) \
          .trigger(processingTime=interval)
    if name:
        w = w.queryName(name)
    if handler is not None:
        return w.foreachBatch(handler).start()
    return w.format(fmt).option("path", path).start()
