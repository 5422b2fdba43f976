"""Recovery (T12): a job that fails at any place and is started again leaves every row once, for each sink."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException

from tributary.session import scratch_path
from tributary.sinks.ledger import POINTS, Ledger, fail_once, ledgered

TOPIC = "k long, v string"


def run(spark, batches, handler, fault):
    """Each batch as a new file; the stream runs until it ends without an injected failure.  Returns the failures."""
    src, ck = (scratch_path(spark, "test-ledger", uuid.uuid4().hex) for _ in range(2))
    failures = 0
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TOPIC).coalesce(1).write.json(f"{src}/b{i:03d}")
        while True:
            stream = spark.readStream.schema(TOPIC).json(f"{src}/*")
            try:
                stream.writeStream.foreachBatch(handler(fault)).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
                break
            except StreamingQueryException as e:
                assert "injected failure" in str(e)
                failures += 1
    return failures


BATCHES = [[(1, "a"), (2, "b")], [(3, "c")], [(4, "d"), (5, "e")]]
EVERYWHERE = {(point, batch) for point in POINTS for batch in range(3)}


def test_rows_of_two_outputs_once_whatever_fails(spark):
    root = scratch_path(spark, "test-ledger", uuid.uuid4().hex)

    def handler(fault):
        def write(batch, _id, folder):
            batch.write.mode("overwrite").json(folder("all"))
            batch.where("k % 2 = 1").write.mode("overwrite").partitionBy("v").json(folder("odd"))
        return ledgered(spark, root, write, fault)
    assert run(spark, BATCHES, handler, fail_once(EVERYWHERE)) == 9
    ledger = Ledger(spark, root)
    assert sorted((r.k, r.v, r.batch) for r in ledger.read("all", TOPIC, "json").collect()) == [(1, "a", 0), (2, "b", 0), (3, "c", 1), (4, "d", 2), (5, "e", 2)]
    assert sorted((r.k, r.v) for r in ledger.read("odd", TOPIC, "json").collect()) == [(1, "a"), (3, "c"), (5, "e")]
    # what failed attempts have written is there, and not read
    raw = spark.read.schema(f"{TOPIC}, batch long, attempt string").json(f"{root}/all")
    assert raw.count() > 5 and ledger.entries().count() == 3


def test_an_uncommitted_batch_is_not_read(spark):
    root = scratch_path(spark, "test-ledger", uuid.uuid4().hex)
    batch = spark.createDataFrame(BATCHES[0], TOPIC)
    ledger = Ledger(spark, root)
    assert ledger.read("all", TOPIC).count() == 0 and ledger.entries().count() == 0 and not ledger.holds(0)
    with pytest.raises(RuntimeError):
        ledgered(spark, root, lambda b, _i, folder: b.write.parquet(folder("all")), fail_once({("written", 0)}))(batch, 0)
    assert ledger.read("all", TOPIC).count() == 0 and not ledger.holds(0)
    ledger.commit(7, "x", "a note")
    assert ledger.note(7) == "a note" and ledger.note(8) is None


def test_topics_of_the_log_split_after_failures(spark):
    """K1: the start, page and display topics of a micro-batch are committed together."""
    import json

    from tributary.operators import logs
    root = scratch_path(spark, "test-ledger", uuid.uuid4().hex)
    common = {"mid": "a", "is_new": "0"}
    records = [{"common": common, "start": {"entry": "icon"}, "ts": 1}, {"common": common, "page": {"page_id": "p"}, "displays": [{"item": "7"}], "ts": 2},
               {"common": common, "page": {"page_id": "q"}, "ts": 3}]
    batches = [[(i, json.dumps(r))] for i, r in enumerate(records)]

    def handler(fault):
        def write(batch, _id, folder):
            good = logs.valid_logs(logs.parse_logs(batch.selectExpr("k AS offset", "v AS value")), raw="value")
            for topic, rows in logs.split_topics(good.selectExpr("offset", "common.is_new AS is_new", "value")).items():
                rows.write.mode("overwrite").json(folder(topic))
        return ledgered(spark, root, write, fault)
    run(spark, batches, handler, fail_once(EVERYWHERE))
    ledger = Ledger(spark, root)
    got = {t: sorted(r.offset for r in ledger.read(t, "offset long, value string", "json").collect()) for t in ("start", "page", "display")}
    assert got == {"start": [0], "page": [1, 2], "display": [1]}


def test_facts_and_dimensions_of_the_routing_job_after_failures(spark):
    """K2 and K3."""
    from tributary.sinks.dims import DimensionStore
    from tributary.sources.changes import routing_rules
    from tributary.streaming.routing import routed_facts, routing_batch_handler
    root = scratch_path(spark, "test-ledger", uuid.uuid4().hex)
    rules = routing_rules(spark, [(0, "u", "insert", "hbase", "dim_u", "id,v", None, None), (0, "f", "insert", "kafka", "dwd_f", "id,v", None, None)])

    def handler(fault):
        inner = routing_batch_handler(spark, lambda: rules, root, fault)

        def handle(batch, batch_id):
            env = batch.selectExpr("k AS offset", "'shop' AS database", "if(k % 2 = 0, 'u', 'f') AS tableName",
                                   "cast(map() as map<string,string>) AS before", "map('id', cast(k div 4 as string), 'v', v) AS after", "'insert' AS type")
            inner(env, batch_id)
        return handle
    run(spark, [[(0, "a"), (1, "b")], [(2, "c"), (3, "d")], [(4, "e"), (6, "f"), (5, "g")]], handler, fail_once(EVERYWHERE))
    assert sorted((r.offset, r.topic) for r in routed_facts(spark, root).collect()) == [(1, "dwd_f"), (3, "dwd_f"), (5, "dwd_f")]
    assert sorted(tuple(r) for r in DimensionStore(spark, root).table("dim_u").collect()) == [("0", "c"), ("1", "f")]


def test_statistics_table_after_failures(spark):
    """K5."""
    from pyspark.sql import types as T

    from tributary.schemas import KEYWORD_STATS_COLUMNS
    from tributary.sinks.olap import olap_batch_writer, read_olap
    root = scratch_path(spark, "test-ledger", uuid.uuid4().hex)

    def handler(fault):
        inner = olap_batch_writer(spark, "keyword_stats", path=root, fault=fault)
        return lambda batch, i: inner(batch.selectExpr("1L AS ts", "'e' AS edt", "'s' AS stt", "'search' AS source", "k AS ct", "v AS keyword", "9 AS extra"), i)
    run(spark, BATCHES, handler, fail_once(EVERYWHERE))
    schema = T.StructType([T.StructField(c, T.LongType() if c in ("ct", "ts") else T.StringType()) for c in KEYWORD_STATS_COLUMNS])
    got = read_olap(spark, "keyword_stats", root, schema)
    assert got.columns == KEYWORD_STATS_COLUMNS and sorted(r.ct for r in got.collect()) == [1, 2, 3, 4, 5]
