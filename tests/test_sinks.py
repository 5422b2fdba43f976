"""Topic sinks (K1, K2) and the rule topic; dimension store and ledger have tests of their own."""

import os
import uuid

from tributary.session import scratch_path
from tributary.sinks import topics


def test_dynamic_topics_and_default(spark):
    path = scratch_path(spark, "test-topics", uuid.uuid4().hex)
    recs = spark.createDataFrame([("dwd_a", '{"id":"1"}'), ("dwd_b", '{"id":"2"}'),
                                  (None, '{"id":"3"}')], "topic string, value string")
    topics.write_dynamic_topics(recs, path=path)
    got = sorted(d for d in os.listdir(path) if d.startswith("topic="))
    assert got == ["topic=dwd_a", "topic=dwd_b", "topic=dwd_default_topic"]


def test_topic_round_trip_keeps_offsets(spark):
    from tributary.sources.logs import read_log_topic
    path = scratch_path(spark, "test-topics", uuid.uuid4().hex)
    spark.createDataFrame([(7, '{"a":1}'), (9, '{"a":2}')], "offset long, value string") \
         .write.json(path)
    got = sorted((r.offset, r.value) for r in read_log_topic(spark, path, records=True).collect())
    assert got == [(7, '{"a":1}'), (9, '{"a":2}')]
    streamed = read_log_topic(spark, path, records=True, stream=True)
    assert streamed.isStreaming and streamed.columns == ["offset", "value"]


def test_fixed_topic_records_omit_nulls(spark):
    path = scratch_path(spark, "test-topics", uuid.uuid4().hex)
    df = spark.createDataFrame([(1, "a", None)], "id long, name string, note string")
    recs = topics.as_topic_records(df)
    assert [r.value for r in recs.collect()] == ['{"id":1,"name":"a"}']
    topics.write_topic(recs, path=path)
    assert [r.value for r in spark.read.text(path).collect()] == ['{"id":1,"name":"a"}']


def test_rule_topic_keeps_rule_order_and_drops_bad_records(spark):
    from tributary.operators import cdc
    from tributary.sources import changes
    path = scratch_path(spark, "test-rules", uuid.uuid4().hex)
    for seq, cols in ((2, "id,name"), (1, "id")):
        changes.rule_events(spark, [(seq, "t", "insert", "kafka", "dwd_t", cols, None, None)]).write.mode("append").json(path)
    changes.rule_events(spark, [(3, None, None, None, None, None, None, None)]).write.mode("append").json(path)
    spark.createDataFrame([(4, '{"tableName": ')], "offset long, value string").write.mode("append").json(path)
    rules = changes.read_rule_changes(spark, path)
    assert sorted(r.rule_seq for r in rules.collect()) == [1, 2]
    assert [r.sinkColumns for r in cdc.latest_rules(rules).collect()] == ["id,name"]
