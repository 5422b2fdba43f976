"""Interval joins on streams, a micro-batch at a time.

Spark's own stream-stream join passes every row of both sides through the state store, one lookup and two writes a row and
a removal later, although nearly all rows meet their partners in the micro-batch that they arrive in.  Here a
micro-batch is landed as a table and joined by a batch join, and only the rows that may still meet a later one wait, as a
small table of their own, for the next micro-batch.

The rules are those of Spark's join.  The watermark of a micro-batch is the least over both sides of the latest event
time seen before it, less the delay (0 until both have rows); rows at or below it are late and dropped, rows without a
key or a time meet nothing.  A row waits as long as a row above the watermark may lie in its interval.  Joined rows, waiting rows and
times seen are committed together (``sinks.ledger``), so a batch that runs again finds what the first run found.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sinks.ledger import Fault, Ledger, ledgered

SEEN = "left long, right long"
SIDES = ("left", "right")


@dataclass(frozen=True)
class Side:
    """``key``: the join column; ``at``: the event time in epoch ms; ``waits_ms``: how far above its own time a row's
    latest partner may lie."""

    key: str
    at: Column
    waits_ms: int


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two topics as one stream, so that their micro-batches advance together."""
    frames = {"left": left, "right": right}
    return left.select(*_tagged(frames, "left")).unionByName(right.select(*_tagged(frames, "right")))


def _tagged(frames: dict[str, DataFrame], side: str) -> list[Column]:
    return [(F.struct(*df.columns) if s == side else F.lit(None).cast(df.schema)).alias(s) for s, df in frames.items()]


def interval_join_writer(spark: SparkSession, root: str, left: Side, right: Side, delay_ms: int,
                         join: Callable[[DataFrame, DataFrame], DataFrame], fault: Fault | None = None):
    """A ``foreachBatch`` handler over :func:`both`; ``join`` is the join of two batch tables (with its interval)."""
    ledger = Ledger(spark, root)
    sides = dict(zip(SIDES, (left, right)))

    def write(batch: DataFrame, batch_id: int, folder: Callable[[str], str]) -> None:
        seen = ledger.read("seen", SEEN, "json").where(F.col("batch") == batch_id - 1).first()
        seen = {s: seen[s] if seen else 0 for s in SIDES}
        watermark = max(min(seen.values()) - delay_ms, 0)
        new, waiting = {}, {}
        for s, side in sides.items():
            rows = batch.where(F.col(s).isNotNull()).select(f"{s}.*")
            (rows.withColumn("__at", side.at).where(F.col(side.key).isNotNull() & F.col("__at").isNotNull())
                 .write.mode("overwrite").option("compression", "zstd").parquet(folder(f"landed/{s}")))
            landed = spark.read.parquet(folder(f"landed/{s}"))
            seen[s] = max(landed.agg(F.max("__at")).first()[0] or 0, seen[s])
            new[s] = landed.where(F.col("__at") > watermark)
            waiting[s] = (ledger.read(f"waiting/{s}", _ddl(landed)).where(F.col("batch") == batch_id - 1).drop("batch"))
        met = join(new["left"].drop("__at"), new["right"].unionByName(waiting["right"]).drop("__at"))
        met = met.unionByName(join(waiting["left"].drop("__at"), new["right"].drop("__at")))
        met.write.mode("overwrite").parquet(folder("joined"))
        after = max(min(seen.values()) - delay_ms, 0)
        for s, side in sides.items():
            (new[s].unionByName(waiting[s]).where(F.col("__at") > after - side.waits_ms)
                .write.mode("overwrite").parquet(folder(f"waiting/{s}")))
        spark.createDataFrame([tuple(seen[s] for s in SIDES)], SEEN).coalesce(1).write.mode("overwrite").json(folder("seen"))
    return ledgered(spark, root, write, fault)


def joined(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The committed rows of the join, with the columns of ``like``."""
    return Ledger(spark, root).read("joined", _ddl(like)).select(*like.columns)
