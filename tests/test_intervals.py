"""Interval joins a micro-batch at a time: Spark's stream-stream join gives the same rows, and little waits."""

import uuid
from decimal import Decimal

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tributary.operators import orders
from tributary.session import scratch_path
from tributary.sinks.ledger import POINTS, Ledger, fail_once
from tributary.streaming import intervals
from tributary.streaming.runner import ChunkedTopics, run_chunks

T0 = 1_700_000_000_000
INFO = "id long, province_id long, user_id long, order_status string, total_amount decimal(16,2), create_time string, arrives long"
DETAIL = "id long, order_id long, sku_id long, sku_num long, order_price decimal(16,2), create_time string, arrives long"


def _sides():
    return [intervals.Side(key, orders.create_second_ms("create_time"), 5000) for key in ("id", "order_id")]


def _topics(spark):
    """Orders a second apart, details up to 7 s beside them; of each some come a chunk or two late, twice, without a key or a time."""
    info, detail = [], []
    for i in range(120):
        late = {7: 40_000, 11: 80_000}.get(i % 13, 0)
        row = (None if i % 29 == 5 else i, 1, i, "F", Decimal(i), None if i % 31 == 3 else str(T0 + 1000 * i + 123), 1000 * i + late)
        info += [row] * (2 if i % 17 == 1 else 1)
        for d in (-6, -5, 0, 5, 7):
            late = {8: 3_000, 9: 45_000}.get((i + d) % 19, 0)
            text = "soon" if (i + d) % 37 == 2 else str(T0 + 1000 * (i + d) + 999 * (d % 2))
            detail.append((10 * i + d, None if (i + d) % 23 == 4 else i, i, 1, Decimal(d), text, 1000 * (i + d) + late))
    return ChunkedTopics(spark, {"info": (spark.createDataFrame(info, INFO), F.col("arrives")),
                                 "detail": (spark.createDataFrame(detail, DETAIL), F.col("arrives"))}, 4, "test-intervals")


def _batch_join(info, detail):
    return orders.order_wide_base(info, detail).select("order_id", "detail_id", "create_time", "total_amount", "order_price")


def _by_batches(spark, topics, fault=None):
    out, ckpt = (scratch_path(spark, "test-intervals", uuid.uuid4().hex) for _ in range(2))
    handler = intervals.interval_join_writer(spark, out, *_sides(), 0, _batch_join, fault)
    for i in range(topics.n):
        topics.write_chunk(i)
        while True:
            try:
                (intervals.both(topics.read("info"), topics.read("detail")).writeStream.foreachBatch(handler)
                    .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
                break
            except StreamingQueryException as e:
                assert "injected failure" in str(e)
    like = _batch_join(*(spark.createDataFrame([], topics.schemas[t]) for t in ("info", "detail")))
    return sorted(map(str, intervals.joined(spark, out, like).collect())), out


def test_rows_of_the_stream_stream_join(spark):
    topics = _topics(spark)
    expected = sorted(map(str, run_chunks(spark, topics, lambda: _batch_join(topics.read("info"), topics.read("detail")), "test-intervals").collect()))
    full = _batch_join(*(spark.read.schema(topics.schemas[t]).json(f"{topics.path(t)}/*") for t in ("info", "detail"))).count()
    assert 200 < len(expected) < full                       # some rows are late
    found, out = _by_batches(spark, _topics(spark))
    assert found == expected
    # of 600 details only those within 5 s of a micro-batch's end wait for the next
    for side in intervals.SIDES:
        waiting = Ledger(spark, out).read(f"waiting/{side}", "__at long").groupBy("batch").count().collect()
        assert waiting and max(r["count"] for r in waiting) <= 6 * 11


def test_a_failed_micro_batch_joins_once(spark):
    expected, _ = _by_batches(spark, _topics(spark))
    found, _ = _by_batches(spark, _topics(spark), fail_once({(p, i) for i, p in enumerate(POINTS)}))
    assert found == expected


def test_topic_files_are_many_at_every_size(spark):
    """A gzip file is one task's work, so a chunk is dealt over many files before they are full."""
    rows = spark.range(400_000).coalesce(1).selectExpr("id")
    topics = ChunkedTopics(spark, {"t": (rows, F.col("id"))}, 2, "files")
    topics.write_chunk(0)
    assert len(spark.read.schema("id long").json(f"{topics.path('t')}/*").inputFiles()) >= 20
