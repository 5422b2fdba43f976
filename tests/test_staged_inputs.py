"""What jobs write of their inputs before they run: each staged once, with no column that nobody reads, cut by plain bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.operators import cdc
from tributary.plans import warehouse
from tributary.streaming import jobs
from tributary.streaming.runner import ChunkedTopics


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(2024, 1, 2)
    rows = {
        "customer": ([(1, "c1", 1, "AUTO"), (2, "c2", 2, None)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "orders": ([(1, 1, "F", 10.0, day, "1-URGENT"), (2, 2, "O", 20.0, day, None)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 6, 1, 5.0, 9.0, 0.1), (2, 6, 1, 1.0, 8.0, None)],
                     "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"),
        "part": ([(6, "p6")], "p_partkey long, p_name string"),
        "events": ([(1, day, 1, "view", 1.0, '{"k": 6}')], "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def layers(monkeypatch):
    """(name, columns) of every layer that is asked for."""
    seen = []
    monkeypatch.setattr(warehouse, "materialize", lambda df, name: seen.append((name, df.columns)) or df)
    return seen


@pytest.mark.parametrize("job, topics", [(jobs.route_recovered_stream, 1), (jobs.dim_freshness_stream, 2)])
def test_inputs_that_are_staged_are_not_written_as_layers_too(spark, tables, layers, monkeypatch, job, topics):
    staged = []

    class Stop(Exception):
        pass

    def stage(_spark, frames, *_):
        staged.append(frames)
        if len(staged) == topics:
            raise Stop
    monkeypatch.setattr(jobs, "ChunkedTopics", stage)
    with pytest.raises(Stop):
        job(spark, tables)
    assert len(staged) == topics and layers == []


def test_the_layer_of_the_product_statistics_has_the_columns_that_are_read(spark, tables, layers):
    events = warehouse.Warehouse(spark, tables).product_events
    assert layers == [("dwm_order_wide", list(warehouse.PRODUCT_ORDER_COLUMNS))]
    assert [(r.sku_id, r.order_id, r.order_sku_num) for r in events.where("order_id is not null").orderBy("order_id").collect()] == [(6, 1, 5), (6, 2, 1)]


def test_a_chunk_is_read_by_plain_bounds(spark, capsys):
    rows = spark.createDataFrame([(i, None if i == 3 else i) for i in range(10)], "id long, at long")
    topics = ChunkedTopics(spark, {"t": (rows, F.col("at"))}, 4, "bounds")
    got = [sorted(r.id for r in topics.chunk("t", i).collect()) for i in range(4)]
    assert got == [[0, 1, 2, 3], [4, 5], [6, 7, 8], [9]]
    topics.chunk("t", 2).explain()
    assert "GreaterThanOrEqual(__at," in capsys.readouterr().out


def test_names_of_a_rule_are_split_once_a_rule(spark, capsys):
    env = spark.createDataFrame([(1, "t", "insert", {"a": "1", "b": "2"}), (2, "u", "insert", {"a": "3"})],
                                "offset long, tableName string, type string, after map<string,string>")
    rules = spark.createDataFrame([(1, "t", "insert", "kafka", "x", "b, a", None, None), (2, "u", "insert", "kafka", "y", None, None, None)],
                                  "rule_seq long, sourceTable string, operateType string, sinkType string, sinkTable string, sinkColumns string, "
                                  "sinkPk string, sinkExtend string")
    routed = cdc.route(env, cdc.latest_rules(rules))
    assert {r.offset: r.data for r in routed.collect()} == {1: {"b": "2"}, 2: {}}
    routed.explain()
    plan = capsys.readouterr().out
    assert "map_filter(" in plan and "split(" not in "".join(x.split("map_filter(")[1] for x in plan.splitlines() if "map_filter(" in x)


def test_images_without_a_date_field_are_left_as_they_are(spark):
    raw = spark.createDataFrame([(1, "s.d.t", "c", None, {"id": "1", "n": None}), (2, "s.d.t", "u", {"birthday": None}, {"birthday": "x", "n": "1"})],
                                "offset long, topic string, op string, before map<string,string>, after map<string,string>")
    got = {r.offset: (r.before, r.after) for r in cdc.normalize_changes(raw).collect()}
    assert got == {1: ({}, {"id": "1", "n": None}), 2: ({"birthday": None}, {"birthday": None, "n": "1"})}
