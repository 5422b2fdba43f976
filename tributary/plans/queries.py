"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the provided tables (through the adapters) and returns only plain
columns (text, numbers), aliased exactly like the oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.keywords import keyword_tokens
from tributary.operators import cdc, logs, orders, stats, visits
from tributary.plans.warehouse import Warehouse
from tributary.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]

# Which layers each plan reads more than once (and therefore writes once).
LOG_ONCE = frozenset({"dwd_valid_log"})              # repair reads the parsed log twice
LOG_FANOUT = frozenset({"dwd_valid_log", "dwd_log"})  # the repaired log feeds several branches
NONE = frozenset()


def _w(spark, sf_dir, layers=NONE):
    return Warehouse(spark, sf_dir, layers=layers)


def _kept_keys(m: str = "data"):
    return F.array_join(F.array_sort(F.map_keys(F.col(m))), ",").alias("kept_keys")


# ------------------------------------------------------------------ log split
def log_valid(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    return w.valid.select("offset", F.col("common.mid").alias("mid"),
                          F.col("common.is_new").alias("is_new"), "ts")


def log_dirty(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    return logs.dirty_logs(w.parsed).select("offset", "dirty_reason")


def log_start(spark, sf_dir):
    w = _w(spark, sf_dir, LOG_ONCE)
    return w.starts.select("offset", F.col("common.mid").alias("mid"),
                           F.col("common.is_new").alias("is_new"), "ts",
                           F.get_json_object("start", "$.entry").alias("start_entry"),
                           F.get_json_object("start", "$.loading_time").cast("bigint")
                            .alias("loading_time"))


def log_page(spark, sf_dir):
    return logs.flat_log(_w(spark, sf_dir, LOG_ONCE).pages)


def log_display(spark, sf_dir):
    return logs.display_logs(_w(spark, sf_dir, NONE).page_views, carry=("offset",))


def visitor_new_flag(spark, sf_dir):
    w = _w(spark, sf_dir, LOG_ONCE)
    return w.repaired.select("offset", F.col("common.mid").alias("mid"),
                             F.col("common.is_new").alias("is_new"))


# ---------------------------------------------------------------- visit detail
def unique_visit(spark, sf_dir):
    return visits.unique_visit_times(_w(spark, sf_dir, NONE).page_views).select("offset", "mid", "visit_day", "ts")


def bounce_detail(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    return visits.bounces(w.page_views, within=w.within).select("offset", F.col("common.mid").alias("mid"), "ts")


def visitor_events(spark, sf_dir):
    return _w(spark, sf_dir, LOG_FANOUT).visitor_events


def visitor_stats(spark, sf_dir):
    return _w(spark, sf_dir, LOG_FANOUT).visitor_stats


def daily_active(spark, sf_dir):
    return stats.daily_active(_w(spark, sf_dir, LOG_FANOUT).visitor_stats)


def bounce_rate(spark, sf_dir):
    return stats.bounce_rate(_w(spark, sf_dir, LOG_FANOUT).visitor_stats)


# ------------------------------------------------------------------ order path
def order_times(spark, sf_dir):
    info = orders.order_times(testdata.order_info(spark, sf_dir))
    return info.select("id", "create_date", "create_hour", "create_ts")


def time_errors(spark, sf_dir):
    """Side output of the order path: records whose time is not epoch-ms text (every 50th order
    here carries a date text or nothing instead)."""
    info = testdata.order_info(spark, sf_dir)
    spoilt = F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.concat(F.lit("at "), F.col("create_time")))
    info = info.withColumn("create_time", F.when(F.col("id") % 50 == 0, spoilt).otherwise(F.col("create_time")))
    return orders.time_parse_errors(info).select("id", "user_id", "create_time")


ORDER_BASE_COLUMNS = ["detail_id", "order_id", "sku_id", "order_price", "sku_num", "province_id",
                      "order_status", "user_id", "total_amount", "split_total_amount",
                      "create_time", "create_date", "create_hour"]


def order_wide_base(spark, sf_dir):
    return _w(spark, sf_dir, NONE).order_wide_base.select(*ORDER_BASE_COLUMNS)


def dim_user(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    from tributary.functions.timefmt import age_in_years
    from tributary.operators.lookup import lookup
    j = lookup(w.order_wide_base, w.dims["dim_user_info"], "user_id",
               {"gender": "user_gender", "birthday": "birthday"})
    return j.select("detail_id", "user_id", "user_gender",
                    age_in_years("birthday", w.as_of_col).alias("user_age"))


def dim_province(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    from tributary.operators.lookup import lookup
    j = lookup(w.order_wide_base, w.dims["dim_base_province"], "province_id",
               {"name": "province_name", "area_code": "province_area_code",
                "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})
    return j.select("detail_id", "province_id", "province_name", "province_area_code",
                    "province_iso_code", "province_3166_2_code")


def dim_sku(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    from tributary.operators.lookup import lookup
    j = lookup(w.order_wide_base, w.dims["dim_sku_info"], "sku_id",
               {"sku_name": "sku_name", "category3_id": "category3_id", "spu_id": "spu_id",
                "tm_id": "tm_id"}, overwrite=("sku_name",))
    return j.select("detail_id", "sku_id", "sku_name",
                    F.col("category3_id").try_cast("bigint").alias("category3_id"),
                    F.col("spu_id").try_cast("bigint").alias("spu_id"),
                    F.col("tm_id").try_cast("bigint").alias("tm_id"))


ORDER_WIDE_OUT = ["detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
                  "province_id", "order_status", "user_id", "total_amount", "split_total_amount",
                  "create_time", "create_date", "create_hour", "province_name",
                  "province_area_code", "province_iso_code", "province_3166_2_code", "user_age",
                  "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
                  "category3_name"]


def order_wide(spark, sf_dir):
    return _w(spark, sf_dir, NONE).order_wide().select(*ORDER_WIDE_OUT)


def dim_join(spark, sf_dir):
    """Generic enrichment with the observed missing-row rule: facts without a user row drop."""
    w = _w(spark, sf_dir, NONE)
    from tributary.operators.lookup import lookup
    j = lookup(w.order_wide_base, w.dims["dim_user_info"], "user_id",
               {"gender": "user_gender"}, missing="drop")
    return j.select("detail_id", "user_id", "user_gender")


def order_wide_merge(spark, sf_dir):
    """First-non-null merge: each joined row's detail half completed by its order's fields."""
    w = _w(spark, sf_dir, NONE)
    base = w.order_wide_base.select(*ORDER_BASE_COLUMNS)
    info_cols = ["province_id", "order_status", "user_id", "total_amount", "create_time",
                 "create_date", "create_hour"]
    detail_half = base.select(*[F.lit(None).cast(base.schema[c].dataType).alias(c)
                                if c in info_cols else F.col(c) for c in base.columns])
    info = orders.order_times(w.order_info)
    order_half = info.select(F.col("id").alias("order_id"),
                             *[F.col(c).cast(base.schema[c].dataType).alias(c) for c in info_cols])
    return orders.merge_order_wide(detail_half, order_half, key="order_id")


PAYMENT_OUT = ["payment_id", "payment_type", "payment_create_time", "order_create_time",
               "detail_id", "order_id", "sku_id", "order_price", "user_id", "total_amount",
               "province_id", "order_status"]


def payment_wide(spark, sf_dir):
    return _w(spark, sf_dir, NONE).payment_wide.select(*PAYMENT_OUT)


def province_stats(spark, sf_dir):
    return _w(spark, sf_dir, NONE).province_stats


# ----------------------------------------------------------------- product path
def product_clicks(spark, sf_dir):
    return stats.product_clicks(_w(spark, sf_dir, NONE).page_views)


def product_displays(spark, sf_dir):
    return stats.product_displays(_w(spark, sf_dir, NONE).page_views)


def product_events(spark, sf_dir):
    return _w(spark, sf_dir, frozenset({"dwm_order_wide"})).product_events


def product_stats(spark, sf_dir):
    return _w(spark, sf_dir, frozenset({"dwm_order_wide"})).product_stats


# ------------------------------------------------------------------ search path
def search_terms(spark, sf_dir):
    return _w(spark, sf_dir, NONE).search_terms.select("offset", "full_word", "ts")


def keyword_split(spark, sf_dir):
    return _w(spark, sf_dir, NONE).keyword_words.select("offset", "word")


def keyword_tokens_query(spark, sf_dir):
    t = _w(spark, sf_dir, NONE).search_terms
    toks = keyword_tokens("full_word")
    return t.select("offset", "full_word", F.size(toks).cast("bigint").alias("n_words"),
                    F.array_join(toks, " ").alias("words"))


# Letters written as Han characters (fixed values of this check): phrases without blanks, to be told apart by a dictionary.
LETTERS, HAN = "abcdefghijklmnopqrstuvwxyz", "一二三四五六七八九十百千天地人水火木金土日月山川田石"


def keyword_dictionary(spark, sf_dir):
    """Search phrases without blanks, in Han letters, segmented by the dictionary of all first words of the
    part names; how often each word occurs in each phrase."""
    from tributary.functions.keywords import dictionary_words

    def han(text):
        return F.translate(text, LETTERS, HAN)
    terms = _w(spark, sf_dir, NONE).search_terms
    phrases = terms.select("offset", han(F.translate("full_word", " ", "")).alias("full_word"))
    first = testdata.table(spark, sf_dir, "part").select(han(F.split("p_name", " ")[0]).alias("word"))
    words = dictionary_words(phrases, first, key=["offset"])
    return words.groupBy("offset", "word").agg(F.count("*").alias("n"))


def keyword_stats(spark, sf_dir):
    return _w(spark, sf_dir, NONE).keyword_stats


# ------------------------------------------------------------------- CDC path
def cdc_normalize(spark, sf_dir):
    env = cdc.normalize_changes(testdata.raw_change_records(spark, sf_dir))
    return env.select("offset", "database", F.col("tableName").alias("table_name"), "type",
                      F.col("after")["id"].alias("after_id"),
                      F.col("after")["name"].alias("after_name"),
                      F.col("after")["segment"].alias("after_segment"),
                      F.col("after")["birthday"].alias("after_birthday"),
                      F.col("before")["id"].alias("before_id"),
                      F.col("before")["segment"].alias("before_segment"))


def cdc_table_filter(spark, sf_dir):
    env = cdc.filter_tables(_w(spark, sf_dir, NONE).envelopes, tables=["shop.user_info"])
    return env.select("offset", F.col("tableName").alias("table_name"), "type")


def cdc_initial(spark, sf_dir):
    w = _w(spark, sf_dir, NONE)
    snap = cdc.normalize_changes(testdata.snapshot_records(spark, sf_dir))
    env = cdc.with_startup(snap, w.envelopes, mode="initial")
    return env.select("offset", F.col("tableName").alias("table_name"), "type",
                      F.coalesce(F.col("after")["id"], F.col("before")["id"]).alias("id"))


def cdc_no_delete(spark, sf_dir):
    env = cdc.drop_deletes(_w(spark, sf_dir, NONE).envelopes)
    return env.select("offset", F.col("tableName").alias("table_name"), "type")


def route_columns(spark, sf_dir):
    r = _w(spark, sf_dir, NONE).routed.filter("matched")
    return r.select("offset", F.col("sinkType").alias("sink_type"),
                    F.col("sinkTable").alias("sink_table"), _kept_keys())


def route_facts(spark, sf_dir):
    r = cdc.facts(_w(spark, sf_dir, NONE).routed)
    return r.select("offset", F.col("sinkTable").alias("topic"),
                    F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"),
                    _kept_keys())


def route_dims(spark, sf_dir):
    r = cdc.dimensions(_w(spark, sf_dir, NONE).routed)
    return r.select("offset", F.col("sinkTable").alias("sink_table"),
                    F.col("data")["id"].alias("id"), F.col("data")["name"].alias("name"),
                    F.col("data")["segment"].alias("segment"), _kept_keys())


def route_unmatched(spark, sf_dir):
    """Changes no rule version covered when they arrived (the update rule comes late)."""
    r = cdc.unmatched(_w(spark, sf_dir, NONE).routed_versions)
    return r.select("offset", F.col("tableName").alias("table_name"), "type")


def route_rules(spark, sf_dir):
    r = _w(spark, sf_dir, NONE).routed_versions.filter("matched")
    return r.select("offset", F.col("tableName").alias("table_name"), "type",
                    F.col("valid_from").alias("rule_version"),
                    F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
                    _kept_keys())


def route_dropped(spark, sf_dir):
    """Matched changes whose sink type is neither a topic nor a dimension: the snapshot's rows under a
    ``read`` rule of another sink type."""
    from tributary.sources.changes import rule_change_log
    snap = cdc.normalize_changes(testdata.snapshot_records(spark, sf_dir))
    r = cdc.dropped(cdc.route(snap, cdc.latest_rules(rule_change_log(spark))))
    return r.select("offset", F.col("tableName").alias("table_name"), "type", F.col("sinkType").alias("sink_type"),
                    F.col("sinkTable").alias("sink_table"))


def dim_upsert_pk(spark, sf_dir):
    """D3: a rule names another key than ``id``: one row per segment, last user by change order."""
    from tributary.sources.changes import routing_rules
    rules = [(0, "user_info", op, "hbase", "dim_segment", "id,name,segment", "segment", None) for op in ("insert", "update")]
    env = cdc.drop_deletes(_w(spark, sf_dir, NONE).envelopes)
    d = cdc.upsert_dimensions(cdc.dimensions(cdc.route(env, cdc.latest_rules(routing_rules(spark, rules)))))
    return d.select("sink_table", "pk", F.col("row")["id"].alias("last_id"), F.col("row")["name"].alias("last_name"))


def dim_read(spark, sf_dir):
    """A dimension read from files as an all-text table and joined to the order wide rows."""
    from tributary.operators.lookup import lookup
    from tributary.sources.dims import read_dimension
    nation = read_dimension(spark, f"{sf_dir}/nation.parquet")
    j = lookup(_w(spark, sf_dir, NONE).order_wide_base, nation, "province_id",
               {"n_name": "nation_name", "n_regionkey": "region_key"}, dim_key="n_nationkey")
    return j.select("detail_id", "province_id", "nation_name", "region_key")


def bounce_untimed(spark, sf_dir):
    """T4 side output: page records without a usable time (every ninth log record here says ``soon``)."""
    lines = testdata.log_lines(spark, sf_dir)
    spoilt = F.regexp_replace("value", r'"ts":\d+}$', '"ts":"soon"}')
    lines = lines.withColumn("value", F.when(F.col("offset") % 9 == 0, spoilt).otherwise(F.col("value")))
    pages = logs.page_logs(logs.valid_logs(logs.parse_logs(lines.drop("ts_ms"))))
    return visits.untimed(pages).select("offset", F.col("common.mid").alias("mid"))


def dim_upsert(spark, sf_dir):
    d = cdc.upsert_dimensions(cdc.dimensions(_w(spark, sf_dir, NONE).routed))
    return d.select("sink_table", "pk", F.col("row")["name"].alias("name"),
                    F.col("row")["segment"].alias("segment"))


def cdc_snapshot(spark, sf_dir):
    s = cdc.snapshot(_w(spark, sf_dir, frozenset({"ods_base_db"})).envelopes)
    return s.select(F.col("tableName").alias("table_name"), "pk",
                    F.col("row")["name"].alias("name"), F.col("row")["segment"].alias("segment"))


def cdc_retract(spark, sf_dir):
    r = cdc.retract_stream(_w(spark, sf_dir, NONE).envelopes, ["id", "name", "segment"])
    return r.select("seq", F.col("tableName").alias("table_name"), F.col("pos").cast("bigint")
                    .alias("pos"), "flag", "id", "name", "segment")


QUERIES: dict[str, Query] = {
    "log_valid": log_valid,
    "log_dirty": log_dirty,
    "log_start": log_start,
    "log_page": log_page,
    "log_display": log_display,
    "visitor_new_flag": visitor_new_flag,
    "unique_visit": unique_visit,
    "bounce_detail": bounce_detail,
    "visitor_events": visitor_events,
    "visitor_stats": visitor_stats,
    "daily_active": daily_active,
    "bounce_rate": bounce_rate,
    "order_times": order_times,
    "time_errors": time_errors,
    "order_wide_base": order_wide_base,
    "dim_user": dim_user,
    "dim_province": dim_province,
    "dim_sku": dim_sku,
    "order_wide": order_wide,
    "dim_join": dim_join,
    "order_wide_merge": order_wide_merge,
    "payment_wide": payment_wide,
    "province_stats": province_stats,
    "product_clicks": product_clicks,
    "product_displays": product_displays,
    "product_events": product_events,
    "product_stats": product_stats,
    "search_terms": search_terms,
    "keyword_split": keyword_split,
    "keyword_tokens": keyword_tokens_query,
    "keyword_dictionary": keyword_dictionary,
    "keyword_stats": keyword_stats,
    "cdc_normalize": cdc_normalize,
    "cdc_table_filter": cdc_table_filter,
    "cdc_initial": cdc_initial,
    "cdc_no_delete": cdc_no_delete,
    "route_columns": route_columns,
    "route_facts": route_facts,
    "route_dims": route_dims,
    "route_unmatched": route_unmatched,
    "route_rules": route_rules,
    "route_dropped": route_dropped,
    "dim_upsert": dim_upsert,
    "dim_upsert_pk": dim_upsert_pk,
    "dim_read": dim_read,
    "bounce_untimed": bounce_untimed,
    "cdc_snapshot": cdc_snapshot,
    "cdc_retract": cdc_retract,
}


def _sql_queries() -> dict[str, Query]:
    from tributary.plans import sql
    return {"keyword_stats_sql": sql.keyword_stats_sql_query,
            "province_stats_sql": sql.province_stats_sql_query}


QUERIES.update(_sql_queries())
