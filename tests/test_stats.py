"""Windowed statistics with the original 10 s defaults; sink column orders."""

import json

from tributary.operators import logs, stats, visits
from tributary.schemas import PRODUCT_STATS_COLUMNS, VISITOR_STATS_COLUMNS
from tributary.sinks.olap import sink_columns


def _pages(spark, recs):
    lines = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(recs)],
                                  "offset long, value string")
    return logs.page_logs(logs.valid_logs(logs.parse_logs(lines)))


def test_visitor_stats_10s(spark):
    c = {"mid": "m", "is_new": "1", "vc": "v", "ch": "c", "ar": "a"}
    recs = [{"common": c, "page": {"page_id": "home", "during_time": 100}, "ts": 1_000},
            {"common": c, "page": {"page_id": "x", "last_page_id": "home"}, "ts": 2_000},
            {"common": c, "page": {"page_id": "home", "during_time": 5}, "ts": 15_000}]
    pages = _pages(spark, recs)
    ev = stats.visitor_events(visits.unique_visits(pages), visits.bounces(pages), pages)
    out = sorted(stats.visitor_stats(ev).collect(), key=lambda r: r.stt)
    assert [r.stt for r in out] == ["1970-01-01 00:00:00", "1970-01-01 00:00:10"]
    first, second = out
    assert (first.uv_ct, first.pv_ct, first.sv_ct, first.uj_ct, first.dur_sum, first.ts) == (1, 2, 1, 0, 100, 1000)
    assert (second.pv_ct, second.sv_ct, second.uj_ct, second.dur_sum) == (1, 1, 1, 5)
    assert out[0].edt == "1970-01-01 00:00:10"
    assert stats.visitor_stats(ev).columns == VISITOR_STATS_COLUMNS


def test_product_sink_has_25_columns(spark):
    assert len(PRODUCT_STATS_COLUMNS) == 25
    df = spark.createDataFrame([tuple(range(25))], ",".join(f"{c} long" for c in reversed(PRODUCT_STATS_COLUMNS)))
    assert sink_columns(df, "product_stats").columns == PRODUCT_STATS_COLUMNS
