"""Window statistics a micro-batch at a time: the rows of Spark's append mode, no state store, and little waits."""

import datetime as dt
import os
import uuid
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tributary.operators import stats
from tributary.plans.warehouse import Warehouse
from tributary.session import scratch_path
from tributary.sinks.ledger import POINTS, Ledger, fail_once, ledgered
from tributary.sinks.olap import olap_rows_writer, read_olap
from tributary.streaming import jobs, windows
from tributary.streaming.runner import ChunkedTopics, run_chunks

T0 = 1_700_000_000_000
EVENT = ", ".join(f"{c} {t}" for c, t in stats.PRODUCT_EVENT_COLUMNS.items())
SIZE, DELAY = "10 seconds", "2 seconds"


def _topics(spark):
    """80 s of events, three a 400 ms, for a few skus; orders come twice, some events a chunk or more late or without a time."""
    rows = []
    for i in range(600):
        ts = T0 + 400 * (i // 3)
        late = {5: 3_000, 11: 25_000, 17: 60_000}.get(i % 29, 0)
        event = dict.fromkeys(stats.PRODUCT_EVENT_COLUMNS) | {"sku_id": None if i % 41 == 3 else i % 4, "ts": None if i % 37 == 4 else ts}
        if i % 5 < 2:
            event |= {"order_id": i // 12, "order_amount": Decimal(i) / 4, "order_sku_num": 1}
        elif i % 5 == 2:
            event |= {"paid_order_id": i // 30, "payment_amount": Decimal(i)}
        elif i % 5 == 3:
            event |= {"refund_order_id": i // 50, "refund_amount": None if i % 3 else Decimal(i) / 16}
        else:
            event |= {"display_ct": 1, "click_ct": i % 2}
        rows.append((*event.values(), ts + late))
    return ChunkedTopics(spark, {"events": (spark.createDataFrame(rows, f"{EVENT}, arrives long"), F.col("arrives"))}, 4, "test-windows")


def _by_batches(spark, topics, fault=None):
    out, ckpt = (scratch_path(spark, "test-windows", uuid.uuid4().hex) for _ in range(2))
    handler = windows.window_writer(spark, out, "ts", SIZE, DELAY, lambda e: stats.compact_product_events(e, SIZE),
                                    lambda e: stats.product_stats_raw(e, SIZE, DELAY), fault=fault)
    for i in range(topics.n):
        topics.write_chunk(i)
        while True:
            try:
                (topics.read("events").drop("arrives").writeStream.foreachBatch(handler).option("checkpointLocation", ckpt)
                    .trigger(availableNow=True).start().awaitTermination())
                break
            except StreamingQueryException as e:
                assert "injected failure" in str(e)
    schema = stats.product_stats_raw(spark.createDataFrame([], EVENT), SIZE).schema
    return sorted(map(str, windows.told(spark, out, schema).collect())), out


def test_rows_of_the_append_mode(spark):
    topics = _topics(spark)
    expected = sorted(map(str, run_chunks(spark, topics, lambda: stats.product_stats_raw(topics.read("events"), SIZE, DELAY), "test-windows").collect()))
    full = spark.read.schema(topics.schemas["events"]).json(f"{topics.path('events')}/*")
    whole = set(map(str, stats.product_stats_raw(full, SIZE).collect()))
    assert 10 < len(set(expected) & whole) < len(expected)       # some windows lost late events, some are whole
    found, out = _by_batches(spark, _topics(spark))
    assert found == expected
    waiting = Ledger(spark, out).read("waiting", "ts long").groupBy("batch").agg(F.count("*").alias("n"), F.min("ts"), F.max("ts")).collect()
    assert len(waiting) == 4 and max(r["n"] for r in waiting) < 90
    assert all(r["max(ts)"] - r["min(ts)"] < 20_000 for r in waiting)       # the open windows' alone


def test_a_failed_micro_batch_is_told_once(spark):
    expected, _ = _by_batches(spark, _topics(spark))
    found, _ = _by_batches(spark, _topics(spark), fail_once({(p, i) for i, p in enumerate(POINTS)}))
    assert found == expected


def test_compacted_events_give_the_same_statistics(spark):
    rows = [(7, T0 + d, 0, 0, 0, 0, 2, Decimal("99999999999999.99"), o, 0, p, Decimal("0.0001"), r, 1, 1)
            for d, o, p, r in [(9, 1, None, None), (3, 1, None, None), (4, None, 1, None), (5, None, None, 1), (6, 2, None, None), (8, None, None, None)]]
    events = spark.createDataFrame([(*x[:9], Decimal(x[9]), *x[10:]) for x in rows], EVENT)
    once = stats.compact_product_events(events, SIZE)
    twice = stats.compact_product_events(once, SIZE)
    assert once.schema == twice.schema and once.columns == events.columns and once.count() == 5
    expected = stats.product_stats_raw(events, SIZE).collect()
    assert stats.product_stats_raw(once, SIZE).collect() == expected == stats.product_stats_raw(twice, SIZE).collect()
    assert (expected[0].order_ct, expected[0].paid_order_ct, expected[0].refund_order_ct, expected[0].ts) == (2, 1, 1, T0 + 3)


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(2024, 1, 2)
    rows = {
        "region": ([(1, "r1")], "r_regionkey int, r_name string"),
        "nation": ([(1, "n1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c1", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([(i, 1, "FO"[i % 2], 10.0, day + dt.timedelta(days=i)) for i in range(8)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        "lineitem": ([(i, 6, 1 + k, 5.0, 9.0 + k, 0.1) for i in range(8) for k in range(2)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"),
        "part": ([(6, "p6", "Brand#3", 4, 1.5)], "p_partkey long, p_name string, p_brand string, p_size int, p_retailprice double"),
        "events": ([(i, day + dt.timedelta(hours=7 * i), i % 3, ["view", "click", "purchase", "signup"][i % 4], 1.0, '{"k": 6}') for i in range(1, 30)],
                   "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("job", [jobs.product_sink_stream, jobs.product_stats_stream])
def test_product_jobs_keep_no_state_store_and_no_layer_read_once(spark, tables, monkeypatch, job):
    def folders(kind):
        path = scratch_path(spark, kind)
        return {f"{path}/{x}" for x in os.listdir(path)} if os.path.isdir(path) else set()
    monkeypatch.setattr(jobs, "N_CHUNKS", 2)
    before = {k: folders(k) for k in ("checkpoints", "layers")}
    found = sorted(map(str, job(spark, tables).collect()))
    checkpoints, layers = (folders(k) - before[k] for k in before)
    expected = Warehouse(spark, tables).product_stats.where("edt < '2024-01-10 00:00:00'").collect()
    assert found[:len(expected)] == sorted(map(str, expected)) and len(expected) == 7
    assert checkpoints and not any("state" in names for path in checkpoints for _, names, _ in os.walk(path))
    assert sorted(os.path.basename(x).split("-")[0] for x in layers) == ["dwd_valid_log", "dwm_order_wide"]


def test_the_sink_reads_back_its_declared_columns(spark):
    out = scratch_path(spark, "test-windows", uuid.uuid4().hex)
    table = spark.createDataFrame([(T0, "b", "a", "s", 1, "x")], "ts long, edt string, stt string, source string, ct long, keyword string")
    ledgered(spark, out, olap_rows_writer("keyword_stats"))(table, 0)
    assert read_olap(spark, "keyword_stats", out, table.schema).collect() == [("x", 1, "s", "a", "b", T0)]
