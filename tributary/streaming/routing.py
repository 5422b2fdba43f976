"""The change-routing job on a stream (BaseDB job): live rules, facts, dimensions.

``foreachBatch`` gives the three behaviours the original got from a broadcast state
and two sinks:

* T11 live config: the rule table is re-read at the start of every micro-batch, so a
  rule written between two batches applies from the next one (the latest version per
  key wins; deleted rules are ignored).  ``streaming.ordered`` applies rules record by record;
* K2: routed facts, a folder per topic;
* K3/D5: dimension changes as one run of the dimension store (``sinks.dims``);
* K4: a dimension rule creates its table if there is none yet.

Unmatched changes are an output of their own (the original only printed them).  All outputs of a micro-batch
are committed together by the job's ledger, so a batch that failed half way leaves nothing to be read and
one that runs again is not written twice (T12).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import cdc
from tributary.schemas import DEFAULT_FACT_TOPIC
from tributary.sinks.dims import DimensionStore, dimension_deltas
from tributary.sinks.ledger import Fault, Ledger, ledgered

FACTS = "offset long, value string, topic string"


def routing_batch_handler(spark: SparkSession, rules_loader: Callable[[], DataFrame], out_root: str, fault: Fault | None = None):
    store = DimensionStore(spark, out_root)

    def write(batch: DataFrame, batch_id: int, folder: Callable[[str], str]) -> None:
        versions = rules_loader()
        rules = cdc.latest_rules(versions)
        store.create(versions)
        routed = cdc.route(cdc.drop_deletes(batch), rules).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (cdc.fact_records(cdc.facts(routed))
                .withColumn("topic", F.coalesce("topic", F.lit(DEFAULT_FACT_TOPIC)))
                .write.mode("overwrite").partitionBy("topic").json(folder("facts")))
            store.write(dimension_deltas(cdc.dimensions(routed)), folder)
            (cdc.unmatched(routed).select("offset", "tableName", "type")
                .write.mode("overwrite").json(folder("unmatched")))
        finally:
            routed.unpersist()
    return ledgered(spark, out_root, write, fault)


def route_stream(changes: DataFrame, rules_loader: Callable[[], DataFrame], out_root: str,
                 checkpoint: str, fault: Fault | None = None) -> None:
    """Run the routing job over a change-envelope stream to completion (``availableNow``)."""
    q = (changes.writeStream.foreachBatch(routing_batch_handler(changes.sparkSession, rules_loader, out_root, fault))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def routed_facts(spark: SparkSession, out_root: str) -> DataFrame:
    """(offset, value, topic) of the committed facts."""
    return Ledger(spark, out_root).read("facts", FACTS, "json").drop("batch")
