"""Log split (P1-P4) and new-visitor repair (T1) on literal fixtures."""

import json

from tributary.operators import logs


def _lines(spark, records):
    rows = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "offset long, value string")


def test_log_split_fixture(spark):
    common = {"mid": "a", "is_new": "1"}
    recs = [
        {"common": common, "start": {"entry": "icon"}, "ts": 1},
        {"common": common, "start": "", "page": {"page_id": "home"}, "ts": 2},
        {"common": common, "page": {"page_id": "good_list"},
         "displays": [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "activity_id"}],
         "ts": 3},
        '{"common": {"mid": "a"',
        "[1, 2]",
        {"page": {"page_id": "home"}, "ts": 4},
    ]
    out = logs.split_logs(_lines(spark, recs))
    assert out["start"].count() == 1
    assert out["page"].count() == 2
    d = sorted((r.page_id, r.item, r.item_type) for r in out["display"].collect())
    assert d == [("good_list", "1", "sku_id"), ("good_list", "2", "activity_id")]
    reasons = sorted(r.dirty_reason for r in out["dirty"].collect())
    assert reasons == ["malformed", "malformed", "no_common"]


def test_start_empty_object_is_start(spark):
    df = logs.parse_logs(_lines(spark, [{"common": {"mid": "a"}, "start": {}, "ts": 1}]))
    assert logs.start_logs(logs.valid_logs(df)).count() == 1


def test_strict_parse_fails(spark):
    import pytest
    with pytest.raises(Exception):
        logs.parse_logs(_lines(spark, ['{"common": ']), on_bad="fail").collect()


def test_new_flag_fixture(spark):
    recs = []
    for i, f in enumerate(["1", "1", "0", "1"]):
        recs.append({"common": {"mid": "a", "is_new": f}, "page": {"page_id": "p"}, "ts": 10 + i})
    for i, f in enumerate(["0", "1", "1"]):
        recs.append({"common": {"mid": "b", "is_new": f}, "page": {"page_id": "p"}, "ts": 10 + i})
    # shuffled arrival order: the rule follows (ts, offset), not the row order
    recs = list(reversed(recs))
    rep = logs.repair_new_flag(logs.valid_logs(logs.parse_logs(_lines(spark, recs))))
    got = {}
    for r in rep.select("common.mid", "common.is_new", "ts").collect():
        got.setdefault(r.mid, []).append((r.ts, r.is_new))
    assert [f for _, f in sorted(got["a"])] == ["1", "0", "0", "0"]
    assert [f for _, f in sorted(got["b"])] == ["0", "1", "0"]


def test_fields_that_no_schema_names_are_forwarded(spark):
    rec = {"common": {"mid": "a", "is_new": "1", "uid": "u1"}, "page": {"page_id": "home", "x": [1, {"y": None}]},
           "displays": [{"item": "7", "order": 1}, {"item": "8", "pos": {"z": 2}}], "actions": [{"id": 1}], "ts": 5}
    later = {"common": {"mid": "a", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 6}
    out = logs.split_logs(_lines(spark, [rec, later]))
    assert [json.loads(r.value) for r in out["page"].collect()] == [rec]
    later["common"]["is_new"] = "0"
    assert [json.loads(r.value) for r in out["start"].collect()] == [later]
    shown = [json.loads(r.value) for r in out["display_records"].collect()]
    assert shown == [{"item": "7", "order": 1, "page_id": "home"}, {"item": "8", "pos": {"z": 2}, "page_id": "home"}]


def test_validity_comes_from_the_text_alone(spark):
    common = '"common": {"mid": "a"}'
    texts = ['{%s, "ts": "1620000000000"}' % common, '{%s, "ts": 1, "page": {"during_time": "12"}}' % common,
             '{%s, "ts": 1, "displays": {}}' % common, '{%s, "ts": 1} trailing' % common,
             '{%s}] {}' % common, '{%s}} {}' % common, '{%s},{}' % common, '{%s}, "a": 1' % common, ' {%s} ' % common]
    got = {r.offset: r for r in logs.parse_logs(_lines(spark, texts)).collect()}
    assert [got[i].dirty_reason for i in range(9)] == [None] * 3 + ["malformed"] * 5 + [None]
    assert got[0].ts == 1620000000000 and got[1].page.during_time == 12
