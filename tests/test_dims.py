"""The dimension store (K3, K4, D4): upserts, buckets, compaction, what a read opens."""

import uuid

import pytest

from tributary.session import scratch_path
from tributary.sinks.dims import DimensionStore, bucket_of, dimension_deltas
from tributary.sources.changes import RULE_ROW

ROUTED = "offset long, sinkTable string, sinkPk string, data map<string,string>"


@pytest.fixture()
def store(spark):
    return DimensionStore(spark, scratch_path(spark, "test-dims", uuid.uuid4().hex), buckets=8)


def write(store, batch_id, rows):
    store.write_batch(dimension_deltas(store.spark.createDataFrame(rows, ROUTED)), batch_id)


def rows(store, table="d", columns="id,a,b", **kw):
    return {r.id: (r.a, r.b) for r in store.table(table, columns, **kw).collect()}


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULE_ROW)


def test_last_value_of_every_column(store):
    write(store, 0, [(1, "d", None, {"id": "1", "a": "x", "b": "y"})])
    write(store, 0, [(1, "d", None, {"id": "1", "a": "x", "b": "y"})])          # the batch runs again
    write(store, 1, [(2, "d", None, {"id": "1", "a": "z"}), (3, "d", None, {"id": "2", "a": "q"})])
    write(store, 2, [(0, "d", None, {"id": "2", "a": "older", "b": "w"})])      # arrives late
    assert rows(store) == {"1": ("z", "y"), "2": ("q", "w")}
    assert {(r.sink_table, r.pk): r.row for r in store.current().collect()} == {
        ("d", "1"): {"id": "1", "a": "z", "b": "y"}, ("d", "2"): {"id": "2", "a": "q", "b": "w"}}


def test_an_empty_batch_and_an_empty_store(store):
    assert rows(store) == {} and store.current().count() == 0 and store.compact(runs=0) == 0
    write(store, 0, [])
    assert rows(store) == {}
    write(store, 1, [(1, "d", None, {"a": "no key"}), (2, "d", None, {"id": "1", "a": None})])
    assert rows(store) == {"1": (None, None)}


def test_compaction_changes_no_row_and_folds_only_full_buckets(store):
    for batch in range(5):
        write(store, batch, [(10 * batch + k, "d", None, {"id": str(k), "a": f"{batch}"} | ({"b": "first"} if not batch else {}))
                             for k in range(0 if batch < 3 else 4, 8)])
    before = rows(store)
    live = store._live(store_all()).count()
    assert store.compact(runs=3) > 0 and rows(store) == before and store._live(store_all()).count() < live
    assert store.compact(runs=3) == 0
    write(store, 5, [(99, "d", None, {"id": "0", "b": "w"})])
    assert rows(store) == before | {"0": (before["0"][0], "w")}
    assert store.compact(runs=0) > 0 and rows(store) == before | {"0": (before["0"][0], "w")}
    assert store._live(store_all()).where("base").count() == store._live(store_all()).count()


def store_all():
    from pyspark.sql import functions as F
    return F.lit(True)


def test_one_key_opens_the_files_of_one_bucket(spark, store):
    store.create(rules(spark, (0, "t", "insert", "hbase", "d", "id,a,b", None, None), (0, "u", "insert", "hbase", "e", "id,a", None, None)))
    write(store, 0, [(k, t, None, {"id": str(k), "a": f"{t}{k}"}) for k in range(200) for t in ("d", "e")])
    write(store, 1, [(1000, "d", None, {"id": "17", "b": "later"})])
    own = spark.range(1).select(bucket_of(_lit("17"), 8)).first()[0]
    one = store.get("d", "17")
    assert [tuple(r) for r in one.collect()] == [("17", "d17", "later")]
    files = one.inputFiles()
    assert files and all("/sink_table=d/" in f and f"/bucket={own}/" in f for f in files)
    # a micro-batch opens the buckets of its keys, and cells of other keys go before the merge
    keys = spark.createDataFrame([(17, 1), (None, 2)], "user_id long, n int")
    some = store.table("d", keys=keys, key="user_id")
    assert [tuple(r) for r in some.collect()] == [("17", "d17", "later")]
    assert all(f"/bucket={own}/" in f for f in some.inputFiles())


def _lit(x):
    from pyspark.sql import functions as F
    return F.lit(x)


def test_tables_are_created_once_by_the_first_rule(spark, store):
    later = rules(spark, (2, "user_info", "update", "hbase", "dim_user", "id", None, None), (1, "user_info", "insert", "hbase", "dim_user", "id,name", None, None),
                  (0, "base_trademark", "insert", "hbase", "dim_tm", "tm_id,tm_name", "tm_id", None),
                  (0, "order_info", "insert", "kafka", "dwd_order_info", "id", None, None))
    assert store.create(later) == ["dim_tm", "dim_user"] and store.create(later) == []
    assert DimensionStore(spark, store.root).create(later) == []                # another process
    assert {(r.sink_table, r.columns, r.pk, r.buckets) for r in store.catalog().collect()} == {
        ("dim_tm", "tm_id,tm_name", "tm_id", 8), ("dim_user", "id,name", "id", 8)}
    assert store.table("dim_tm").columns == ["tm_id", "tm_name"] and store.table("dim_tm").count() == 0
    write(store, 0, [(1, "dim_tm", "tm_id", {"tm_id": "7", "tm_name": "x"})])
    # the number of buckets is the table's, whatever the store was opened with
    assert [tuple(r) for r in DimensionStore(spark, store.root, buckets=3).get("dim_tm", "7").collect()] == [("7", "x")]
