"""Unique visits (T2) and bounces (T4) on literal fixtures with the 10 s default."""

import json

from tributary.operators import logs, visits

DAY = 86_400_000


def _pages(spark, events):
    """events: (mid, ts_ms, entry?)"""
    rows = []
    for i, (mid, ts, entry) in enumerate(events):
        page = {"page_id": "p"} if entry else {"page_id": "p", "last_page_id": "home"}
        rows.append((i, json.dumps({"common": {"mid": mid}, "page": page, "ts": ts})))
    lines = spark.createDataFrame(rows, "offset long, value string")
    return logs.page_logs(logs.valid_logs(logs.parse_logs(lines)))


def test_bounce_fixture(spark):
    ev = [("a", 0, True), ("a", 4000, True), ("a", 6000, False),
          ("b", 0, True), ("b", 9999, False),
          ("c", 0, True), ("c", 10000, False),
          ("d", 0, True)]
    out = visits.bounces(_pages(spark, ev))
    got = sorted((r.mid, r.ts) for r in out.select("common.mid", "ts").collect())
    assert got == [("a", 0), ("c", 0), ("d", 0)]


def test_bounce_across_bucket_boundary(spark):
    # entry at 9.5 s, next page at 10.5 s: different 10 s buckets, gap 1 s -> no bounce
    ev = [("x", 9500, True), ("x", 10500, False), ("y", 9500, True), ("y", 19600, False)]
    out = visits.bounces(_pages(spark, ev))
    assert sorted(r.mid for r in out.select("common.mid").collect()) == ["y"]


def test_unique_visit_fixture(spark):
    ev = [("a", 1000, True), ("a", 2000, True), ("a", 3000, False), ("a", DAY + 5, True),
          ("b", 1000, False)]
    out = visits.unique_visits(_pages(spark, ev))
    got = sorted((r.mid, r.visit_day, r.ts) for r in out.select("common.mid", "visit_day", "ts").collect())
    assert got == [("a", "1970-01-01", 1000), ("a", "1970-01-02", DAY + 5)]


def test_shuffled_arrival_does_not_change_visits(spark):
    ev = [("a", 0, True), ("a", 4000, True), ("a", 6000, False), ("c", 0, True),
          ("c", 10000, False), ("d", 0, True), ("a", DAY + 5, True)]
    # arrival order reversed, offsets follow arrival: the rules use (ts, offset)
    fwd, rev = _pages(spark, ev), _pages(spark, list(reversed(ev)))

    def key(df):
        return sorted((r.mid, r.ts) for r in df.select("common.mid", "ts").collect())
    assert key(visits.bounces(fwd)) == key(visits.bounces(rev))
    assert key(visits.unique_visits(fwd)) == key(visits.unique_visits(rev))
