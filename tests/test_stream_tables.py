"""Declared stream tables, the same SQL on a batch table and on a stream."""

import json
import uuid

from tributary.plans import stream_tables
from tributary.session import scratch_path

T0 = 1_700_000_000_000


def _topic(spark, rows):
    return spark.createDataFrame([(json.dumps(r) if isinstance(r, dict) else r,) for r in rows], "value string")


def test_declared_columns_computed_time_and_views(spark):
    table = stream_tables.StreamTable("t", "a MAP<STRING,STRING>, ts BIGINT", {"rt": "timestamp_millis(ts)", "day": "date(rt)"}, ("rt", "1 second"))
    topic = _topic(spark, [{"a": {"x": 1}, "ts": T0}, "no json", {"ts": "soon"}])
    rows = table.rows(topic)
    assert rows.columns == ["a", "ts", "rt", "day"]
    assert sorted((r.x, r.ts) for r in rows.selectExpr("a.x AS x", "coalesce(ts, -1) AS ts").collect() if r.ts > 0) == [("1", T0)]
    first, second = table.create_view(topic), table.create_view(topic)
    assert first != second and spark.sql(f"SELECT count(*) FROM {first}").first()[0] == 3


def _orders():
    # order 1 has three rows and order 2 one in province 1; another window, another province, a date text
    row = lambda p, o, at, amount="10.50": {"province_id": p, "province_name": f"p{p}", "order_id": o, "total_amount": amount, "create_time": at}
    return [row(1, 1, str(T0)), row(1, 1, str(T0 + 1000)), row(1, 1, str(T0 + 2000)), row(1, 2, str(T0 + 3000)), row(2, 1, str(T0)),
            row(1, 3, "2023-11-14 22:13:40"), row(1, 4, "not a time")]


WANT = [("2023-11-14 22:13:20", 1, "42.00", 2), ("2023-11-14 22:13:20", 2, "10.50", 1), ("2023-11-14 22:13:40", 1, "10.50", 1)]


def test_distinct_orders_in_a_batch(spark):
    out = stream_tables.province_stats_sql(spark, _topic(spark, _orders()), "10 seconds")
    assert sorted((r.stt, r.province_id, str(r.order_amount), r.order_count) for r in out.where("stt is not null").collect()) == WANT


def test_distinct_orders_on_a_stream(spark):
    src, out, ck = (scratch_path(spark, "test-sql", uuid.uuid4().hex) for _ in range(3))
    batches = [_orders()[:3], _orders()[3:], [{"province_id": 9, "order_id": 9, "total_amount": "1.00", "create_time": str(T0 + 60_000)}]]
    for i, rows in enumerate(batches):
        _topic(spark, rows).coalesce(1).write.json(f"{src}/b{i}")
        topic = spark.readStream.schema("value string").json(f"{src}/*")
        df = stream_tables.province_stats_sql(spark, topic, "10 seconds")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(df.schema).parquet(out).collect()
    assert sorted((r.stt, r.province_id, str(r.order_amount), r.order_count) for r in got) == WANT


def test_keywords_on_a_stream_equal_the_batch(spark):
    page = lambda item, ts, last="search": {"common": {"mid": "m"}, "page": {"item": item, "last_page_id": last}, "ts": ts}
    rows = [page("red blue", T0), page("red", T0 + 999), page("blue", T0 + 10_000), page("red", T0, "home"), page(None, T0), page("end", T0 + 50_000)]
    batch = stream_tables.keyword_stats_sql(spark, _topic(spark, rows), "10 seconds")
    want = sorted(tuple(r) for r in batch.collect())
    src, out, ck = (scratch_path(spark, "test-sql", uuid.uuid4().hex) for _ in range(3))
    for i in range(2):
        _topic(spark, rows[3 * i:3 * i + 3]).coalesce(1).write.json(f"{src}/b{i}")
        df = stream_tables.keyword_stats_sql(spark, spark.readStream.schema("value string").json(f"{src}/*"), "10 seconds")
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(out).collect())
    assert ("red", 2, "search", "2023-11-14 22:13:20", "2023-11-14 22:13:30") in got
    assert got == [w for w in want if w[0] != "end"]           # its window is still open
