"""Routing rules applied record by record (T11): the rule topic and the change topic in one stateful operator.

A rule holds for the changes behind it in the sequence of the two topics, also when both come in the same
micro-batch.  The operator is keyed by (salt, rule key): changes of a busy table are dealt over the salts, and every rule is
sent to each of them.  State is the versions of one rule key, which is configuration.  A rule that arrives in a later
micro-batch than a change behind it comes too late for that change, as it did in the original.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tributary.operators import cdc
from tributary.schemas import CHANGE_EVENT, DEFAULT_PK, ROUTING_RULE

SALTS = 16
ROUTED = "offset long, payload string, valid_from long, rule string"


class RuleRouter(StatefulProcessor):
    """Attaches to every change the last rule of its key before it.

    The changes of a key and salt in one micro-batch wait until its rules are known (rows come in no order), so
    bound micro-batches, or raise the salts, where one table brings very many changes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getListState("rules", "seq long, rule string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = {int(s): r for s, r in self.rules.get()} if self.rules.exists() else {}
        before, waiting = len(known), []
        for pdf in rows:
            is_rule = pdf["is_rule"].to_numpy(bool)
            known.update({int(s): r for s, r in pdf.loc[is_rule, ["seq", "payload"]].itertuples(index=False)})
            if not is_rule.all():
                waiting.append(pdf.loc[~is_rule, ["seq", "payload"]])
        if len(known) != before:
            self.rules.put(sorted(known.items()))
        since = np.array(sorted(known), "int64")
        texts = np.array([known[s] for s in since.tolist()] + [None], object)
        numbers = pd.array([*since.tolist(), None], "Int64")
        for pdf in waiting:
            of = np.searchsorted(since, pdf["seq"].to_numpy("int64"), "left") - 1   # -1: the None at the end
            yield pd.DataFrame({"offset": pdf["seq"].to_numpy("int64"), "payload": pdf["payload"].to_numpy(),
                                "valid_from": numbers[of], "rule": texts[of]})

    def close(self) -> None:
        pass


def route_ordered(changes: DataFrame, rules: DataFrame, salts: int = SALTS) -> DataFrame:
    """J6 + P8 + T11 on streams: the columns of ``cdc.route(..., seq="offset")`` for each change.

    ``changes``: envelopes; ``rules``: rows of ``cdc.rules_from_changes`` (``rule_seq`` in the same sequence).
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    r = rules.select(every, cdc.rule_key(F.col("sourceTable"), F.col("operateType")).alias("rule_key"), F.lit(True).alias("is_rule"),
                     F.col("rule_seq").alias("seq"), F.to_json(F.struct(*cdc.RULE_FIELDS)).alias("payload"))
    fields = [f.name for f in CHANGE_EVENT.fields]
    c = changes.select(F.pmod(F.xxhash64("offset"), F.lit(salts)).cast("int").alias("salt"),
                       cdc.rule_key(F.col("tableName"), F.col("type")).alias("rule_key"), F.lit(False).alias("is_rule"),
                       F.col("offset").alias("seq"), F.to_json(F.struct(*fields)).alias("payload"))
    both = r.unionByName(c).groupBy("salt", "rule_key")
    routed = both.transformWithStateInPandas(RuleRouter(), ROUTED, "Append", "None")
    routed = routed.select("offset", F.from_json("payload", CHANGE_EVENT).alias("e"), "valid_from",
                           F.from_json("rule", T.StructType(ROUTING_RULE.fields)).alias("r"))
    matched = F.col("valid_from").isNotNull()
    return routed.select("offset", *(F.col(f"e.{f}").alias(f) for f in fields), matched.alias("matched"),
                         F.col("r.sinkType"), F.col("r.sinkTable"), F.col("r.sinkColumns"),
                         F.coalesce(F.col("r.sinkPk"), F.lit(DEFAULT_PK)).alias("sinkPk"), "valid_from",
                         F.when(matched, cdc.filter_columns(F.col("e.after"), F.col("r.sinkColumns"))).alias("data"))
