"""Record schemas, output column orders and the reference's constants.

Every tunable (window size, watermark delay, join bounds, pattern window, state expiry)
is a keyword argument of the operator that uses it; the defaults below are the values
the original jobs hard-code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the original jobs (behavioural constants).
# ---------------------------------------------------------------------------
WINDOW_SIZE = "10 seconds"            # tumbling window of all four statistics jobs
BOUNCE_WITHIN = "10 seconds"          # bounce pattern window
ORDER_JOIN_LOWER_S = -5               # order x detail interval join, seconds, inclusive
ORDER_JOIN_UPPER_S = 5
PAYMENT_JOIN_LOWER_S = -15 * 60       # payment x order-wide interval join, seconds, inclusive
PAYMENT_JOIN_UPPER_S = 5
VISIT_STATE_TTL = "24 hours"          # unique-visit state expiry
WATERMARK_DELAY = {                   # bounded out-of-orderness per job
    "order_wide": "0 seconds",
    "payment_wide": "0 seconds",
    "province_stats": "0 seconds",
    "bounce": "1 second",
    "keyword_stats": "1 second",
    "product_stats": "2 seconds",
    "visitor_stats": "11 seconds",
}
APPRAISE_GOOD = "1201"                # appraise code counted as a good comment
SINK_TYPE_HBASE = "hbase"             # rule sink types
SINK_TYPE_KAFKA = "kafka"
SINK_TYPE_CLICKHOUSE = "clickhouse"
DEFAULT_PK = "id"                     # dimension primary key when a rule names none
DEFAULT_FACT_TOPIC = "dwd_default_topic"
KEYWORD_SOURCE = "search"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
DAY_TEXT = "yyyy-MM-dd"
# Debezium operation letters and the type names the envelope carries
# ("create" is renamed "insert", everything else is the lower-case operation name).
CDC_OPERATIONS = {"c": "insert", "u": "update", "d": "delete", "r": "read",
                  "t": "truncate", "m": "message"}

# ---------------------------------------------------------------------------
# Input records
# ---------------------------------------------------------------------------
COMMON = T.StructType([
    T.StructField("mid", T.StringType()),
    T.StructField("is_new", T.StringType()),
    T.StructField("vc", T.StringType()),
    T.StructField("ch", T.StringType()),
    T.StructField("ar", T.StringType()),
])
PAGE = T.StructType([
    T.StructField("page_id", T.StringType()),
    T.StructField("last_page_id", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("during_time", T.LongType()),
])
DISPLAY = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("item_type", T.StringType()),
])
# `start` is read as raw text on purpose: `"start": {}` is a start log (text "{}" is
# non-empty) while `"start": ""` is a page log.
ACTION_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", T.StringType()),
    T.StructField("page", PAGE),
    T.StructField("displays", T.ArrayType(DISPLAY)),
    T.StructField("ts", T.LongType()),
])

STRING_MAP = T.MapType(T.StringType(), T.StringType())
CHANGE_EVENT = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("tableName", T.StringType()),
    T.StructField("before", STRING_MAP),
    T.StructField("after", STRING_MAP),
    T.StructField("type", T.StringType()),
])
ROUTING_RULE = T.StructType([
    T.StructField("sourceTable", T.StringType()),
    T.StructField("operateType", T.StringType()),
    T.StructField("sinkType", T.StringType()),
    T.StructField("sinkTable", T.StringType()),
    T.StructField("sinkColumns", T.StringType()),
    T.StructField("sinkPk", T.StringType()),
    T.StructField("sinkExtend", T.StringType()),
])

MONEY = T.DecimalType(16, 2)
MONEY_SUM = T.DecimalType(38, 2)

# ---------------------------------------------------------------------------
# Output column orders (OLAP sink order = declared field order, transient sets skipped)
# ---------------------------------------------------------------------------
VISITOR_STATS_COLUMNS = ["stt", "edt", "vc", "ch", "ar", "is_new",
                         "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
PRODUCT_STATS_COLUMNS = ["stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name",
                         "tm_id", "tm_name", "category3_id", "category3_name",
                         "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                         "order_amount", "order_ct", "payment_amount", "paid_order_ct",
                         "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts"]
PROVINCE_STATS_COLUMNS = ["stt", "edt", "province_id", "province_name", "province_area_code",
                          "province_iso_code", "province_3166_2_code", "order_amount",
                          "order_count", "ts"]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]

ORDER_WIDE_COLUMNS = ["detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
                      "province_id", "order_status", "user_id", "total_amount",
                      "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
                      "feight_fee", "split_feight_fee", "split_activity_amount",
                      "split_coupon_amount", "split_total_amount", "expire_time", "create_time",
                      "operate_time", "create_date", "create_hour", "province_name",
                      "province_area_code", "province_iso_code", "province_3166_2_code",
                      "user_age", "user_gender", "spu_id", "tm_id", "category3_id",
                      "spu_name", "tm_name", "category3_name"]
PAYMENT_WIDE_COLUMNS = ["payment_id", "subject", "payment_type", "payment_create_time",
                        "callback_time", "detail_id", "order_id", "sku_id", "order_price",
                        "sku_num", "sku_name", "province_id", "order_status", "user_id",
                        "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
                        "original_total_amount", "feight_fee", "split_feight_fee",
                        "split_activity_amount", "split_coupon_amount", "split_total_amount",
                        "order_create_time", "province_name", "province_area_code",
                        "province_iso_code", "province_3166_2_code", "user_age", "user_gender",
                        "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
