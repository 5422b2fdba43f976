"""A ledger of committed micro-batches (T12): readers see whole batches only, each exactly once.

A micro-batch may write to several outputs, and the job may die between any two writes, or after the last
one and before the stream's checkpoint notes the batch; the batch then runs again, possibly cut otherwise.
So every run of a batch writes to folders of its own, ``<output>/batch=<id>/attempt=<a>``, and one small record in
the ledger then names the attempt that counts.  A batch that the ledger holds is not written again, and folders
that the ledger does not name are never read.

The record is one file, moved into its place by Spark's own output commit, so a reader finds all of it or
nothing.  ``read`` joins the folders' partition columns to the ledger; Spark prunes the folders it does not name.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD = "batch long, attempt string, note string"

#: Places at which a test may make a job fail: before a batch is written, after it is written and before the
#: ledger holds it, and after that, before the stream's own checkpoint does.
POINTS = ("begun", "written", "committed")
Fault = Callable[[str, int], None]


def exists(spark: SparkSession, path: str) -> bool:
    """True if there is such a folder."""
    try:
        spark.read.schema(RECORD).json(path)
        return True
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    @property
    def path(self) -> str:
        return os.path.join(self.root, "ledger")

    def _record(self, batch_id: int) -> str:
        return os.path.join(self.path, f"entry={batch_id:012d}")

    def note(self, batch_id: int) -> str | None:
        """The note of a committed batch; None if the ledger does not hold it."""
        if not exists(self.spark, self._record(batch_id)):
            return None
        row = self.spark.read.schema(RECORD).json(self._record(batch_id)).first()  # one row, or none yet
        return row["note"] if row else None

    def holds(self, batch_id: int) -> bool:
        return self.note(batch_id) is not None

    def commit(self, batch_id: int, attempt: str, note: str = "") -> None:
        (self.spark.createDataFrame([(batch_id, attempt, note)], RECORD).coalesce(1)
             .write.mode("overwrite").json(self._record(batch_id)))

    def entries(self) -> DataFrame:
        """(batch, attempt, note) of every committed batch."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], RECORD)
        return self.spark.read.schema(RECORD).json(os.path.join(self.path, "*"))

    def folder(self, output: str, batch_id: int, attempt: str) -> str:
        return os.path.join(self.root, output, f"batch={batch_id:012d}", f"attempt={attempt}")

    def read(self, output: str, schema: str, fmt: str = "parquet") -> DataFrame:
        """The committed rows of an output, with their ``batch``."""
        path = os.path.join(self.root, output)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        rows = self.spark.read.schema(f"{schema}, batch long, attempt string").format(fmt).load(path)
        return rows.join(self.entries().select("batch", "attempt"), ["batch", "attempt"], "left_semi").drop("attempt")


def ledgered(spark: SparkSession, root: str, write: Callable[[DataFrame, int, Callable[[str], str]], None],
             fault: Fault | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that writes each micro-batch once, whatever fails.

    ``write(batch, batch_id, folder)`` writes the outputs to ``folder(output)``.  ``fault`` is called at ``POINTS``
    (tests let it raise).
    """
    ledger = Ledger(spark, root)
    at = fault or (lambda point, batch_id: None)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if ledger.holds(batch_id):
            return
        attempt = uuid.uuid4().hex[:16]
        at("begun", batch_id)
        write(batch, batch_id, lambda output: ledger.folder(output, batch_id, attempt))
        at("written", batch_id)
        ledger.commit(batch_id, attempt)
        at("committed", batch_id)
    return handle


def fail_once(points: set[tuple[str, int]]) -> Fault:
    """A fault for tests and drills: raises the first time each (point, batch) of ``points`` is reached."""
    left = set(points)

    def fault(point: str, batch_id: int) -> None:
        if (point, batch_id) in left:
            left.discard((point, batch_id))
            raise RuntimeError(f"injected failure: {point} of batch {batch_id}")
    return fault
