"""Adapters: derive the warehouse's inputs from the provided TPC-H-like tables.

Each function mirrors one view of FIXTURES.md §2 so the DuckDB oracle (which runs the
same definitions in SQL) and the Spark jobs start from identical inputs.  The action
log and change events are rendered as JSON text here and parsed again by the engine's
sources, so parsing is exercised exactly as on a real topic.

Everything is a lazy DataFrame over the parquet tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import MONEY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table.  Parquet timestamps load as TIMESTAMP_NTZ; the engine works in
    session-zone TIMESTAMP, so they are cast."""
    df = _read(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp_ntz":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp"))
    return df


# The provided tables are read-only, so one DataFrame (a plan, not data) per session and
# path is reused instead of listing files and reading footers again for every adapter.
_READS: dict[tuple[str, str], DataFrame] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, path)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _READS[key] = spark.read.parquet(path)
    return df


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts)


# --------------------------------------------------------------------------- logs
def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        "event_id", "ts", _ms(F.col("ts")).alias("ts_ms"),
        F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.when(F.col("event_id") % 3 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("vc"),
        F.concat(F.lit("ch"), (F.col("user_id") % 4).cast("string")).alias("ch"),
        F.concat(F.lit("ar"), (F.col("user_id") % 5).cast("string")).alias("ar"),
        F.when(et == "signup", F.lit(None).cast("string")).when(et == "error", "")
         .when(et == "view", "search").when(et == "click", "good_list").otherwise("cart")
         .alias("last_page_id"),
        F.when(et == "click", "good_detail").when(et == "view", "good_list")
         .when(et == "purchase", "trade").otherwise("home").alias("page_id"),
        F.when(et == "click", "sku_id").when(et == "view", "keyword").alias("item_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        (F.col("event_id") % 50 == 0).alias("is_dirty"),
        ((F.col("event_id") % 50 != 0) & (F.col("event_id") % 11 == 1)).alias("is_start"),
        "event_type",
    )


def log_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_log`` plus the page item (sku id / search phrase) and display count."""
    r = raw_log(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = r.join(part, r["k"] == part["p_partkey"], "left")
    et = F.col("event_type")
    return j.select(
        *[r[c] for c in r.columns],
        F.when(et == "click", F.col("k").cast("string"))
         .when(et == "view", F.when(F.col("k") % 7 == 0, F.lit(None)).otherwise(F.col("p_name")))
         .alias("item"),
        F.when(et.isin("click", "view"), F.col("k") % 4).otherwise(F.lit(0)).alias("n_displays"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The action log as a topic would carry it: ``offset BIGINT, value STRING`` (JSON text).

    Start records carry ``start``; page records carry ``page`` and, for clicks and views,
    ``displays`` (display i shows item k+i, a sku when i is even).  Every 50th record is
    truncated JSON (dirty).
    """
    r = log_records(spark, sf_dir)
    # ``uid`` and ``order`` are fields that no typed schema names: they must pass the split
    common = F.struct("mid", "is_new", "vc", "ch", "ar", F.substring("mid", 5, 20).alias("uid"))
    n = F.col("n_displays")
    displays = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct((F.col("k") + i).cast("string").alias("item"),
                           F.when(i % 2 == 0, "sku_id").otherwise("activity_id").alias("item_type"),
                           (i + 1).alias("order"))))
    page = F.struct("page_id", "last_page_id", "item", "item_type", "during_time")
    page_json = F.to_json(F.struct(common.alias("common"), page.alias("page"),
                                   displays.alias("displays"), F.col("ts_ms").alias("ts")))
    start = F.struct(F.lit("icon").alias("entry"), F.col("during_time").alias("loading_time"))
    start_json = F.to_json(F.struct(common.alias("common"), start.alias("start"),
                                    F.col("ts_ms").alias("ts")))
    value = F.when(F.col("is_start"), start_json).otherwise(page_json)
    value = F.when(F.col("is_dirty"), F.substring(value, F.lit(1), (F.length(value) / 2).cast("int"))).otherwise(value)
    return r.select(F.col("event_id").alias("offset"), value.alias("value"),
                    F.col("ts_ms").alias("ts_ms"))


# ------------------------------------------------------------------- order facts
def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    create_ms = _ms(F.col("o_orderdate")) + (F.col("o_orderkey") % 86400) * 1000 + 123
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        create_ms.cast("string").alias("create_time"),
    )


def _detail_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"])


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _detail_base(spark, sf_dir)
    split_total = (F.col("l_extendedprice").cast("decimal(12,2)")
                   * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))
                   ).cast("decimal(18,4)")
    create_ms = (_ms(F.col("o_orderdate"))
                 + ((F.col("o_orderkey") % 86400) + (F.col("l_partkey") % 13) - 6) * 1000)
    return j.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.col("l_extendedprice").cast(MONEY).alias("order_price"),
        split_total.alias("split_total_amount"),
        create_ms.cast("string").alias("create_time"),
    )


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    create_ms = _ms(F.col("o_orderdate")) + ((F.col("o_orderkey") % 86400)
                                             + (F.col("o_orderkey") % 1001)) * 1000
    return o.select(
        (F.col("o_orderkey") + 1000000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.concat(F.lit("110"), ((F.col("o_orderkey") % 3) + 1).cast("string")).alias("payment_type"),
        create_ms.cast("string").alias("create_time"),
    )


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_log(spark, sf_dir)
    return r.filter(F.col("event_type") == "view").select(
        F.col("k").alias("sku_id"), F.col("ts_ms").alias("create_time"))


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_log(spark, sf_dir)
    return r.filter(F.col("event_type") == "purchase").select(
        F.col("k").alias("sku_id"), F.col("ts_ms").alias("create_time"))


def order_refund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = order_detail(spark, sf_dir)
    return d.filter(F.col("sku_num") % 5 == 0).select(
        "order_id", "sku_id", F.col("split_total_amount").alias("refund_amount"),
        F.col("create_time").cast("bigint").alias("create_time"))


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_log(spark, sf_dir)
    return r.filter(F.col("event_type") == "signup").select(
        F.col("k").alias("sku_id"),
        F.concat(F.lit("120"), ((F.col("event_id") % 4) + 1).cast("string")).alias("appraise"),
        F.col("ts_ms").alias("create_time"))


# ------------------------------------------------------------------- dimensions
def dim_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 97 != 0)
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
         .cast("string").alias("birthday"))


def dim_base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
        F.col("r_name").alias("area_code"),
        F.concat(F.lit("N-"), F.col("n_nationkey").cast("string")).alias("iso_code"),
        F.concat(F.lit("NN-"), F.col("n_nationkey").cast("string")).alias("iso_3166_2"))


def dim_sku_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("sku_name"),
        F.col("p_retailprice").cast(MONEY).cast("string").alias("price"),
        F.col("p_size").cast("string").alias("category3_id"),
        F.floor(F.col("p_partkey") / 10).cast("string").alias("spu_id"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("tm_id"))


def dim_spu_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    spu = F.floor(F.col("p_partkey") / 10)
    return p.select(spu.alias("spu")).distinct().select(
        F.col("spu").cast("string").alias("id"),
        F.concat(F.lit("spu_"), F.col("spu").cast("string")).alias("spu_name"))


def dim_base_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).alias("id"),
                    F.col("p_brand").alias("tm_name")).distinct()


def dim_base_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_size").cast("string").alias("id"),
                    F.concat(F.lit("category_"), F.col("p_size").cast("string")).alias("name")
                    ).distinct()


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "dim_user_info": dim_user_info(spark, sf_dir),
        "dim_base_province": dim_base_province(spark, sf_dir),
        "dim_sku_info": dim_sku_info(spark, sf_dir),
        "dim_spu_info": dim_spu_info(spark, sf_dir),
        "dim_base_trademark": dim_base_trademark(spark, sf_dir),
        "dim_base_category3": dim_base_category3(spark, sf_dir),
    }


# ------------------------------------------------------------- change capture
DATABASE = "shop"
SERVER = "mysql_binlog"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relational form of the change log (FIXTURES ``changes``) plus before images.

    Columns: seq, table_name, type, id, name, segment, birthday (epoch days, user rows
    only), b_name, b_segment (the row image before the change; NULL for inserts).
    """
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    k = F.col("c_custkey")
    upd_segment = F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))
    birthday = (k % 15000 - 3653).cast("string")      # days since 1970 of 1960-01-01 + k % 15000
    null = F.lit(None).cast("string")
    ins = c.select((k * 3).alias("seq"), F.lit("user_info").alias("table_name"),
                   F.lit("insert").alias("type"), k.alias("id"), F.col("c_name").alias("name"),
                   F.col("c_mktsegment").alias("segment"), birthday.alias("birthday"),
                   null.alias("b_name"), null.alias("b_segment"))
    upd = c.filter(k % 3 == 0).select(
        (k * 3 + 1).alias("seq"), F.lit("user_info"), F.lit("update"), k, null, upd_segment,
        null, F.col("c_name"), F.col("c_mktsegment"))
    dele = c.filter(k % 11 == 0).select(
        (k * 3 + 2).alias("seq"), F.lit("user_info"), F.lit("delete"), k, null, null, null,
        F.col("c_name"), F.when(k % 3 == 0, upd_segment).otherwise(F.col("c_mktsegment")))
    oi = o.select((F.col("o_orderkey") * 3).alias("seq"), F.lit("order_info"), F.lit("insert"),
                  F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"),
                  null, null, null)
    return ins.unionByName(upd.toDF(*ins.columns)).unionByName(dele.toDF(*ins.columns)) \
              .unionByName(oi.toDF(*ins.columns))


def _image(id_: Column, name: Column, segment: Column, birthday: Column | None = None) -> Column:
    """A row image as MAP<STRING,STRING>; NULL fields are absent (JSON drops nulls)."""
    entries = [("id", id_.cast("string")), ("name", name), ("segment", segment)]
    if birthday is not None:
        entries.append(("birthday", birthday))
    m = F.map_from_arrays(F.array(*[F.lit(k) for k, _ in entries]), F.array(*[v for _, v in entries]))
    return F.map_filter(m, lambda _k, v: v.isNotNull())


def raw_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Debezium-like records: ``offset, topic (server.db.table), op (c/u/d), before, after``."""
    ch = changes(spark, sf_dir)
    t = F.col("type")
    after = F.when(t == "delete", F.lit(None)).otherwise(
        _image(F.col("id"), F.col("name"), F.col("segment"), F.col("birthday")))
    before = F.when(t == "insert", F.lit(None)).otherwise(
        _image(F.col("id"), F.col("b_name"), F.col("b_segment")))
    return ch.select(
        F.col("seq").alias("offset"),
        F.concat_ws(".", F.lit(SERVER), F.lit(DATABASE), F.col("table_name")).alias("topic"),
        F.when(t == "insert", "c").when(t == "update", "u").otherwise("d").alias("op"),
        before.alias("before"), after.alias("after"))


def snapshot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial-snapshot records (op ``r``) of ``user_info``: the customers as they are."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        (F.col("c_custkey") - F.lit(10_000_000_000)).alias("offset"),
        F.lit(f"{SERVER}.{DATABASE}.user_info").alias("topic"), F.lit("r").alias("op"),
        F.lit(None).cast("map<string,string>").alias("before"),
        _image(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")).alias("after"))
