"""Interval-join bounds (J1, J3) and merge rules."""

from decimal import Decimal

from pyspark.sql import functions as F

from tributary.operators import orders

T0 = 1_700_000_000_000


def test_order_join_bounds(spark):
    info = spark.createDataFrame([(1, 7, 3, "F", Decimal("10.00"), str(T0))],
                                 "id long, province_id long, user_id long, order_status string, "
                                 "total_amount decimal(16,2), create_time string")
    details = [(10 + i, 1, 100 + i, 1, Decimal("1.00"), str(T0 + off * 1000))
               for i, off in enumerate([-6, -5, 0, 5, 6])]
    detail = spark.createDataFrame(details, "id long, order_id long, sku_id long, sku_num long, "
                                   "order_price decimal(16,2), create_time string")
    out = orders.order_wide_base(info, detail)
    assert sorted(r.sku_id for r in out.collect()) == [101, 102, 103]
    row = out.first()
    assert row.expire_time is None and row.split_feight_fee is None
    assert row.order_status == "F" and row.create_date == "2023-11-14"


def test_payment_join_bounds(spark):
    pay = spark.createDataFrame([(500, 1, 9, Decimal("99.00"), "1101", str(T0))],
                                "id long, order_id long, user_id long, total_amount decimal(16,2), "
                                "payment_type string, create_time string")
    rows = [(20 + i, 1, 3, Decimal("10.00"), str(T0 + off * 1000))
            for i, off in enumerate([-901, -900, 0, 5, 6])]
    wide = spark.createDataFrame(rows, "detail_id long, order_id long, user_id long, "
                                 "total_amount decimal(16,2), create_time string")
    out = orders.payment_wide(pay, wide).collect()
    assert sorted(r.detail_id for r in out) == [21, 22, 23]
    assert {r.total_amount for r in out} == {Decimal("99.00")}
    assert {r.user_id for r in out} == {9}
    assert {r.payment_create_time for r in out} == {str(T0)}


def test_unparsable_times_go_to_side_output(spark):
    pay = spark.createDataFrame([(1, 1, str(T0)), (2, 1, "yesterday"), (3, 1, None)],
                                "id long, order_id long, create_time string")
    assert sorted(r.id for r in orders.time_parse_errors(pay).collect()) == [2, 3]


def test_facts_are_not_shuffled_for_the_spu(spark):
    """The spu joins the skus and the facts never meet it; facts without a sku, skus without an spu and repeated spus as before."""
    text = {"dim_user_info": "gender birthday", "dim_base_province": "name area_code iso_code iso_3166_2", "dim_base_trademark": "tm_name",
            "dim_sku_info": "sku_name price category3_id spu_id tm_id", "dim_spu_info": "spu_name", "dim_base_category3": "name"}
    rows = {"dim_sku_info": [("7", "s", "1", "3", "70", "2"), ("8", "t", "1", "x", "y", "z"), ("9", "u", "1", "3", "71", "2"), (None, "v", "1", "3", "70", "2")],
            "dim_spu_info": [("70", "spu a"), ("70", "spu b"), (None, "spu n")], "dim_base_trademark": [("2", "tm")], "dim_base_category3": [("3", "c")]}
    dims = {d: spark.createDataFrame(rows.get(d, []), f"id string, {', '.join(f'{c} string' for c in cols.split())}") for d, cols in text.items()}
    facts = spark.createDataFrame([(i, i, "own") for i in (7, 8, 9, 10, None)], "detail_id long, sku_id long, sku_name string")
    facts = facts.select("*", *(F.lit(1 if c in ("user_id", "province_id") else None).cast(orders.WIDE_TYPES[c]).alias(c)
                                for c in orders.ORDER_WIDE_COLUMNS if c not in facts.columns))
    wide = orders.enrich_order_wide(facts, dims)
    assert sorted(((r.detail_id or 0, r.sku_name, r.spu_id, r.spu_name, r.tm_name, r.category3_name) for r in wide.collect()), key=str) == sorted([
        (0, "own", None, None, None, None), (10, "own", None, None, None, None), (8, "t", None, None, None, None),
        (7, "s", 70, "spu a", "tm", "c"), (7, "s", 70, "spu b", "tm", "c"), (9, "u", 71, None, "tm", "c")], key=str)
    lines = wide._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {c: next(i for i, line in enumerate(lines) if "Join" in line and "__dim_key" in line and c in line) for c in ("spu_id", "sku_id")}
    assert depth["sku_id"] < depth["spu_id"]         # the skus take their spu before the facts meet them
