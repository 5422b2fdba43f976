"""Window statistics on streams, a micro-batch at a time (A2, A3).

Spark's own append mode passes every group through the state store, a chained aggregate through two, and keeps each version of
them on the executors' disks and in the checkpoint, although nearly all windows end in the micro-batch that their events
arrive in.  Here the events of windows that have ended are aggregated by the batch form of the operator, and only those of
windows that are still open wait, as a compacted table, for the next micro-batch.

The rules are those of append mode where a micro-batch without data follows one with data, as it does in a finite run.  The
watermark is the latest event time seen, less the delay, and at least 0.  An event is late, and dropped, if its window
had ended by the watermark that stood before its micro-batch; the windows that have ended by the watermark after it are told.
Events without a time lie in no window.  Rows told, waiting events and the time seen are committed together
(``sinks.ledger``), so a batch that runs again finds what the first run found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.functions.timefmt import duration_ms, event_time
from tributary.sinks.ledger import Fault, Ledger, ledgered

SEEN = "latest long"


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_rows(rows: DataFrame, _id: int, folder: Callable[[str], str]) -> None:
    rows.write.mode("overwrite").parquet(folder("rows"))


def window_writer(spark: SparkSession, root: str, ts: str, size: str, delay: str, compact: Callable[[DataFrame], DataFrame],
                  tell: Callable[[DataFrame], DataFrame], write: Callable[..., None] = write_rows, fault: Fault | None = None):
    """A ``foreachBatch`` handler over events whose time is ``ts`` (epoch ms).

    ``tell`` makes the rows of whole windows of ``size`` from their events, ``write`` writes them; ``compact`` makes
    fewer events of some, in the same windows and for the same rows, with the same columns."""
    ledger = Ledger(spark, root)
    ends = F.unix_millis(F.col("__window.end"))

    def advance(batch: DataFrame, batch_id: int, folder: Callable[[str], str]) -> None:
        seen = ledger.read("seen", SEEN, "json").where(F.col("batch") == batch_id - 1).first()
        before = seen["latest"] if seen else 0
        latest = max(batch.agg(F.max(ts)).first()[0] or 0, before)
        late, ended = (max(t - duration_ms(delay), 0) for t in (before, latest))
        waiting = ledger.read("waiting", _ddl(compact(batch).schema)).where(F.col("batch") == batch_id - 1).drop("batch")
        events = waiting.unionByName(batch).withColumn("__window", F.window(event_time(ts), size))
        write(tell(events.where((ends > late) & (ends <= ended)).drop("__window")), batch_id, folder)
        compact(events.where(ends > ended).drop("__window")).write.mode("overwrite").parquet(folder("waiting"))
        spark.createDataFrame([(latest,)], SEEN).coalesce(1).write.mode("overwrite").json(folder("seen"))
    return ledgered(spark, root, advance, fault)


def told(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The committed rows of the windows told."""
    return Ledger(spark, root).read("rows", _ddl(schema)).select(*schema.names)
