"""Change capture, routing rules, partial upsert, snapshot and retract stream."""

from pyspark.sql import functions as F

from tributary.operators import cdc
from tributary.sources.changes import RULE_ROW


def _env(spark, rows):
    """rows: (offset, table, type, before dict|None, after dict|None)"""
    return spark.createDataFrame(
        [(o, "db", t, ty, b or {}, a or {}) for o, t, ty, b, a in rows],
        "offset long, database string, tableName string, type string, "
        "before map<string,string>, after map<string,string>")


def test_normalize(spark):
    raw = spark.createDataFrame(
        [(1, "srv.shop.user_info", "c", None, {"id": "1", "birthday": "0"}),
         (2, "srv.shop.user_info", "u", {"id": "1"}, {"id": "1", "birthday": "-3653"}),
         (3, "srv.shop.user_info", "d", {"id": "1"}, None),
         (4, "srv.shop.user_info", "r", None, {"id": "2"})],
        "offset long, topic string, op string, before map<string,string>, after map<string,string>")
    out = {r.offset: r for r in cdc.normalize_changes(raw).collect()}
    assert [out[i].type for i in (1, 2, 3, 4)] == ["insert", "update", "delete", "read"]
    assert out[1].database == "shop" and out[1].tableName == "user_info"
    assert out[1].after["birthday"] == "1970-01-01"
    assert out[2].after["birthday"] == "1960-01-01"
    assert out[3].after == {} and out[4].before == {}


def test_drop_deletes_keeps_missing_type(spark):
    env = _env(spark, [(1, "t", "delete", None, None), (2, "t", None, None, {"id": "1"}),
                       (3, "t", "insert", None, {"id": "2"})])
    assert sorted(r.offset for r in cdc.drop_deletes(env).collect()) == [2, 3]


def test_rules_fixture(spark):
    rules = spark.createDataFrame([
        (1, "user_info", "insert", "hbase", "dim_user", "id,a", None, None),
        (2, "user_info", "insert", "hbase", "dim_user", "id,a,b", None, None),   # changed twice:
        (3, "user_info", "insert", "hbase", "dim_user2", "id,b", None, None),    # last one wins
        (4, "order_info", "insert", "kafka", "dwd_order", "id, name", None, None),
        (5, "sku_info", "insert", "clickhouse", "ck_sku", "id", None, None),
    ], RULE_ROW)
    deleted = spark.createDataFrame([(6,)], "offset long").select(
        "offset", F.lit(None).cast("map<string,string>").alias("after"))
    assert cdc.rules_from_changes(deleted).count() == 0            # a deleted rule never matches
    env = _env(spark, [
        (10, "user_info", "insert", None, {"id": "1", "a": "x", "b": "y", "c": "z"}),
        (11, "order_info", "insert", None, {"id": "7", "name": "n"}),
        (12, "unknown", "insert", None, {"id": "9"}),
        (13, "sku_info", "insert", None, {"id": "3"}),
    ])
    routed = cdc.route(env, cdc.latest_rules(rules))
    dims = cdc.dimensions(routed).collect()
    assert [(r.sinkTable, sorted(r.data)) for r in dims] == [("dim_user2", ["b", "id"])]
    fact = cdc.facts(routed).collect()
    assert [(r.sinkTable, r.data) for r in fact] == [("dwd_order", {"id": "7"})]  # ' name' kept its blank
    assert [r.offset for r in cdc.unmatched(routed).collect()] == [12]
    assert [r.offset for r in cdc.dropped(routed).collect()] == [13]


def test_rule_versions_apply_by_arrival(spark):
    rules = spark.createDataFrame([(5, "t", "insert", "kafka", "v1", "id", None, None),
                                   (20, "t", "insert", "kafka", "v2", "id", None, None)], RULE_ROW)
    env = _env(spark, [(3, "t", "insert", None, {"id": "1"}), (10, "t", "insert", None, {"id": "2"}),
                       (25, "t", "insert", None, {"id": "3"})])
    routed = cdc.route(env, cdc.rule_versions(rules), seq="offset")
    got = sorted((r.offset, r.sinkTable) for r in routed.collect())
    assert got == [(3, None), (10, "v1"), (25, "v2")]


def test_partial_upsert_fixture(spark):
    env = _env(spark, [(1, "user_info", "insert", None, {"id": "1", "a": "x", "b": "y"}),
                       (2, "user_info", "update", None, {"id": "1", "a": "z"}),
                       (3, "user_info", "update", None, {"id": "1"})])   # b = NULL is absent
    routed = env.selectExpr("offset", "'dim_user' AS sinkTable", "'id' AS sinkPk", "after AS data")
    out = cdc.upsert_dimensions(routed).collect()
    assert [(r.pk, r.row["a"], r.row["b"]) for r in out] == [("1", "z", "y")]
    existing = spark.createDataFrame([("dim_user", "2", {"id": "2", "a": "old"})],
                                     "sink_table string, pk string, row map<string,string>")
    both = {r.pk: r.row for r in cdc.upsert_dimensions(routed, existing).collect()}
    assert both["2"]["a"] == "old" and both["1"]["a"] == "z"


def test_retract_fixture(spark):
    env = _env(spark, [(1, "t", "insert", None, {"id": "1", "v": "r1"}),
                       (2, "t", "update", {"id": "1", "v": "r1"}, {"id": "1", "v": "r2"}),
                       (3, "t", "delete", {"id": "1", "v": "r2"}, None)])
    out = [(r.flag, r.v) for r in cdc.retract_stream(env, ["id", "v"]).orderBy("seq", "pos").collect()]
    assert out == [(True, "r1"), (False, "r1"), (True, "r2"), (False, "r2")]


def test_snapshot_drops_deleted(spark):
    env = _env(spark, [(1, "t", "insert", None, {"id": "1", "v": "a"}),
                       (2, "t", "insert", None, {"id": "2", "v": "b"}),
                       (3, "t", "update", None, {"id": "2", "v": "c"}),
                       (4, "t", "delete", {"id": "1"}, None)])
    out = {r.pk: r.row["v"] for r in cdc.snapshot(env).collect()}
    assert out == {"2": "c"}


def test_snapshot_rows_match_read_rules_unless_read_as(spark):
    rules = spark.createDataFrame([(0, "t", "insert", "kafka", "dwd_t", "id", None, None)], RULE_ROW)
    env = _env(spark, [(1, "t", "read", None, {"id": "1"}), (2, "t", "insert", None, {"id": "2"})])
    plain = cdc.route(env, cdc.latest_rules(rules))
    assert sorted(r.offset for r in cdc.facts(plain).collect()) == [2]
    as_insert = cdc.route(env, cdc.latest_rules(rules), read_as="insert")
    assert sorted(r.offset for r in cdc.facts(as_insert).collect()) == [1, 2]


def test_plain_normalize_keeps_raw_dates(spark):
    raw = spark.createDataFrame([(1, "srv.shop.user_info", "c", None, {"birthday": "0"})],
                                "offset long, topic string, op string, before map<string,string>, "
                                "after map<string,string>")
    assert cdc.normalize_changes(raw, date_fields=()).first().after["birthday"] == "0"
