"""T1 and T4 stream processors on the literal fixtures (10 s pattern window, 1 s delay)."""

import json
import uuid

from tributary.operators import logs
from tributary.schemas import BOUNCE_WITHIN
from tributary.session import scratch_path
from tributary.streaming import stateful

TOPIC = "offset long, value string"
T0 = 1_700_000_000_000          # events at epoch 0 would sit on the initial watermark


def _run(spark, batches, build):
    """Write each batch as a new file, run availableNow once per batch, return all output."""
    src = scratch_path(spark, "test-streams", uuid.uuid4().hex)
    out = scratch_path(spark, "test-streams", uuid.uuid4().hex + "-out")
    ck = scratch_path(spark, "test-streams", uuid.uuid4().hex + "-ck")
    schema = None
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, TOPIC).coalesce(1).write.json(f"{src}/b{i:03d}")
        df = build(spark.readStream.schema(TOPIC).json(f"{src}/*"))
        schema = df.schema
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
               .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(schema).parquet(out).collect()


def _page(off, mid, ts, entry):
    page = {"page_id": "p"} if entry else {"page_id": "p", "last_page_id": "home"}
    return (off, json.dumps({"common": {"mid": mid, "is_new": "1"}, "page": page, "ts": T0 + ts}))


def test_bounce_stream_fixture(spark):
    ev = [("a", 0, True), ("a", 4000, True), ("a", 6000, False), ("b", 0, True),
          ("b", 9999, False), ("c", 0, True), ("c", 10000, False), ("d", 0, True)]
    rows = [_page(i, m, t, e) for i, (m, t, e) in enumerate(ev)]
    rows.reverse()                                             # shuffled arrival in the batch
    flush = [_page(100, "z", 60_000, False)]                   # moves the watermark past 10 s

    def build(src):
        pages = logs.page_logs(logs.valid_logs(logs.parse_logs(src)))
        return stateful.bounce_stream(pages, within=BOUNCE_WITHIN)
    out = _run(spark, [rows, flush], build)
    assert sorted((r.mid, r.ts - T0) for r in out) == [("a", 0), ("c", 0), ("d", 0)]


def _bounce_run(spark, batches):
    def build(src):
        return stateful.bounce_stream(logs.page_logs(logs.valid_logs(logs.parse_logs(src))), within=BOUNCE_WITHIN)
    return sorted((r.mid, r.ts - T0) for r in _run(spark, batches, build))


def test_bounces_over_bucket_ends_and_late_pages_equal_the_batch(spark):
    """Random visits in random order of arrival: the watermark is far behind, then passes everything."""
    import random

    from tributary.operators import visits
    r = random.Random(11)
    rows = [_page(i, f"m{r.randrange(4)}", r.randrange(0, 60_000), r.random() < .4) for i in range(400)]
    rows += [_page(400 + i, "edge", 10_000 * i + d, e) for i, (d, e) in enumerate([(0, True), (0, False), (-1, True), (0, True), (9_999, False)])]
    flush = [_page(900, "z", 200_000, False)]
    r.shuffle(rows)
    got = _bounce_run(spark, [rows, flush])
    pages = logs.page_logs(logs.valid_logs(logs.parse_logs(spark.createDataFrame(rows, TOPIC))))
    assert got == sorted((x.common.mid, x.ts - T0) for x in visits.bounces(pages, within=BOUNCE_WITHIN).collect())


def test_bounces_decided_over_several_batches(spark):
    """An entry waits over batches for the page that decides it, within its bucket and in the next."""
    batches = [[_page(0, "a", 0, True), _page(1, "b", 0, True)],
               [_page(3, "a", 400, False), _page(2, "c", 9_500, True)],
               [_page(5, "c", 10_100, False), _page(6, "d", 10_200, True)],
               [_page(7, "y", 60_000, False)], [_page(8, "y", 90_000, False)]]
    assert _bounce_run(spark, batches) == [("b", 0), ("d", 10_200)]


def test_records_without_a_time_take_no_part(spark):
    from tributary.operators import visits
    spoilt = [(0, json.dumps({"common": {"mid": "a"}, "page": {"page_id": "p"}, "ts": "soon"})), (1, json.dumps({"common": {"mid": "a"}, "page": {"page_id": "p"}})),
              _page(2, "a", 0, True), _page(3, "b", 0, True), (4, json.dumps({"common": {}, "page": {"page_id": "p"}, "ts": T0}))]
    assert [m for m, _ in sorted(((m or "", t) for m, t in _bounce_run_null(spark, [spoilt, [_page(9, "z", 60_000, False)]])))] == ["", "a", "b"]
    pages = logs.page_logs(logs.valid_logs(logs.parse_logs(spark.createDataFrame(spoilt, TOPIC))))
    assert sorted(r.offset for r in visits.untimed(pages).collect()) == [0, 1]
    assert sorted(r.offset for r in visits.bounces(pages, within=BOUNCE_WITHIN).collect()) == [2, 3, 4]


def _bounce_run_null(spark, batches):
    def build(src):
        return stateful.bounce_stream(logs.page_logs(logs.valid_logs(logs.parse_logs(src))), within=BOUNCE_WITHIN)
    return [(r.mid, r.ts - T0) for r in _run(spark, batches, build)]


def test_state_of_a_busy_visitor_is_small(spark):
    """100,000 pages of one visitor in one micro-batch: what is held are undecided entries and what is beside them."""
    src, out, ck = (scratch_path(spark, "test-streams", uuid.uuid4().hex) for _ in range(3))
    page = ('concat(\'{"common":{"mid":"busy"},"page":{"page_id":"p"\', if(id % 1000 = 7, \'\', \',"last_page_id":"home"\'), '
            f'\'}},"ts":\', {T0} + id % 30000, \'}}\')')
    spark.range(100_000).selectExpr("id AS offset", f"{page} AS value").coalesce(1).write.json(f"{src}/b0")
    pages = logs.page_logs(logs.valid_logs(logs.parse_logs(spark.readStream.schema(TOPIC).json(f"{src}/*"))))
    df = stateful.bounce_stream(pages, within=BOUNCE_WITHIN)
    from tributary.streaming.runner import without_empty_batches
    with without_empty_batches(spark):              # no second batch: nothing is decided yet
        (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True)
           .start().awaitTermination())
    held = (spark.read.format("statestore").option("path", ck).option("stateVarName", "held").option("flattenCollectionTypes", True).load())
    entries = 100
    assert entries <= held.count() <= 3 * entries + 2 * 4      # four buckets and their ends
    assert held.selectExpr("key.bucket").distinct().count() >= 3


def test_new_flag_stream_fixture(spark):
    def rec(off, mid, flag, ts):
        return (off, json.dumps({"common": {"mid": mid, "is_new": flag}, "page": {"page_id": "p"},
                                 "ts": ts}))
    first = [rec(3, "a", "1", 13), rec(2, "a", "0", 12), rec(1, "a", "1", 11), rec(0, "a", "1", 10),
             rec(4, "b", "0", 10)]
    second = [rec(5, "b", "1", 20), rec(6, "b", "1", 21), rec(7, "a", "1", 22)]

    def build(src):
        return stateful.new_flag_stream(logs.valid_logs(logs.parse_logs(src)))
    out = {r.offset: r.is_new for r in _run(spark, [first, second], build)}
    assert [out[i] for i in range(8)] == ["1", "0", "0", "0", "0", "1", "0", "0"]


def test_unique_visit_stream_emits_at_once_and_keeps_late_entries(spark):
    from tributary.streaming.runner import without_empty_batches
    hour, day = 3_600_000, 86_400_000
    start = T0 - T0 % day
    rec = lambda off, mid, at: _page(off, mid, start + at - T0, True)
    batches = [[rec(0, "a", hour), rec(1, "a", hour - 5), rec(2, "c", day + 6 * hour)],
               [rec(3, "b", day + 2 * hour), rec(4, "a", 0), rec(5, "d", 3 * hour)],     # all late
               [rec(6, "z", 2 * day + 12 * hour), rec(7, "c", day)]]

    def build(src):
        uv = stateful.unique_visit_stream(logs.page_logs(logs.valid_logs(logs.parse_logs(src))))
        return uv.select("offset", "common.mid", "visit_day", "ts")
    with without_empty_batches(spark):
        out = _run(spark, batches, build)
    assert sorted((r.mid, r.offset) for r in out) == [("a", 1), ("b", 3), ("c", 2), ("d", 5), ("z", 6)]
    assert len({r.visit_day for r in out}) == 3


def test_continuous_runner_processes_and_stops(spark):
    from tributary.streaming.runner import start_continuous
    src = scratch_path(spark, "test-streams", uuid.uuid4().hex)
    spark.createDataFrame([_page(0, "m", 0, True)], TOPIC).write.json(src)
    stream = logs.page_logs(logs.valid_logs(logs.parse_logs(spark.readStream.schema(TOPIC).json(src))))
    out = scratch_path(spark, "test-streams", uuid.uuid4().hex + "-out")
    q = start_continuous(stream.select("offset", "ts"), scratch_path(spark, "test-streams", uuid.uuid4().hex),
                         path=out, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [r.offset for r in spark.read.parquet(out).collect()] == [0]
