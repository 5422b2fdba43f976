"""Snapshot handoff of the ``initial`` startup mode (S3): a table's rows, then its changes, without a lock.

The snapshot is read in chunks of keys while the change log goes on.  For a chunk the log's position is taken
before (``low``) and after (``high``) the read.  A row read in between may or may not show the changes of that
stretch; so rows whose key changed in it are left out, and the changes themselves tell them.  Of a chunk's
changes those up to ``low`` are in its rows and go, the later ones are passed on.  No key is told twice by the
snapshot and no change is lost.

``begin`` notes ``low`` before anything is read and ``finish`` commits a chunk's rows with its positions (``sinks.ledger``), so a
job that dies in the middle goes on with the first chunk that is not finished, at the ``low`` it had noted:
changes that were passed on since then are not told again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.cdc import _empty_map
from tributary.plans.layers import materialize
from tributary.sinks.ledger import Fault, Ledger, ledgered

ENVELOPE = "offset long, database string, tableName string, before map<string,string>, after map<string,string>, type string"
NOWHERE = -(2 ** 62)    # the position of an empty log


class SnapshotHandoff:
    def __init__(self, spark: SparkSession, root: str, chunks: int, chunk_of: Column, key: str = "id"):
        """``chunk_of``: the chunk number (0 to ``chunks`` - 1) of a row by its key column ``pk`` (text)."""
        self.spark, self.root, self.chunks, self.chunk_of, self.key = spark, root, chunks, chunk_of, key
        self.begun = Ledger(spark, f"{root}/begun")
        self.done = Ledger(spark, f"{root}/snapshot")
        self.changes = Ledger(spark, f"{root}/changes")

    def _with_chunk(self, env: DataFrame) -> DataFrame:
        pk = F.coalesce(F.col("after")[self.key], F.col("before")[self.key])
        return env.withColumn("pk", pk).withColumn("chunk", self.chunk_of)

    def next_chunk(self) -> int | None:
        """The first chunk that is not finished."""
        return next((c for c in range(self.chunks) if not self.done.holds(c)), None)

    def begin(self, chunk: int, position: Callable[[], int]) -> int:
        """The chunk's ``low``: where the log stood when the chunk was begun, also if that was before a failure."""
        note = self.begun.note(chunk)
        if note is None:
            note = str(position())
            self.begun.commit(chunk, "low", note)
        return int(note)

    def finish(self, chunk: int, rows: DataFrame, log: DataFrame, position: Callable[[], int], fault: Fault | None = None) -> None:
        """Commits the chunk's rows (envelopes of type ``read``) but for the keys that ``log`` tells changes of since ``low``."""
        rows = materialize(rows, "snapshot-chunk")      # the read is over before the position is taken
        low, high = int(self.begun.note(chunk)), position()
        moved = self._with_chunk(log.where((F.col("offset") > low) & (F.col("offset") <= high)))
        moved = moved.where(F.col("chunk") == chunk).select("pk").distinct()

        def write(batch: DataFrame, _id: int, folder: Callable[[str], str]) -> None:
            told = self._with_chunk(batch).join(moved, "pk", "left_anti")
            told.withColumn("offset", F.lit(low)).select(*batch.columns).write.mode("overwrite").parquet(folder("rows"))
        ledgered(self.spark, self.done.root, write, fault)(rows, chunk)

    def change_writer(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` handler of the change topic: passes on what the snapshot does not hold.

        A chunk that was not begun yet will hold all changes that are there now.
        """
        def write(batch: DataFrame, _id: int, folder: Callable[[str], str]) -> None:
            lows = self.begun.entries().select(F.col("batch").cast("int").alias("chunk"), F.col("note").cast("bigint").alias("low"))
            passed = self._with_chunk(batch).join(lows, "chunk").where("offset > low")     # a row a chunk
            passed.select(*batch.columns).write.mode("overwrite").parquet(folder("rows"))
        return ledgered(self.spark, self.changes.root, write)

    def events(self) -> DataFrame:
        """The envelopes told so far: the snapshot's rows at their chunk's ``low``, and the changes."""
        return self.done.read("rows", ENVELOPE).unionByName(self.changes.read("rows", ENVELOPE)).drop("batch")


def read_events(rows: DataFrame, database: str, table: str, columns: list[str]) -> DataFrame:
    """Rows of the source table as ``read`` envelopes (the snapshot's form); NULL fields are absent."""
    image = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.col(c).cast("string") for c in columns)))
    return rows.select(F.lit(NOWHERE).cast("bigint").alias("offset"), F.lit(database).alias("database"), F.lit(table).alias("tableName"),
                       _empty_map().alias("before"), F.map_filter(image, lambda _k, v: v.isNotNull()).alias("after"), F.lit("read").alias("type"))
