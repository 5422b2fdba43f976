"""Summary layer: visitor, product, province and keyword statistics in tumbling
event-time windows, plus the indicators derived from them.

Each statistic is "map every input to one common row shape, union, window-aggregate".
The same functions run on batch tables and on streams; on a stream the caller's
watermark delay is applied to the event-time column right before the window.
Dimension lookups happen after aggregation, so they touch one row per window and key
instead of one per event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.keywords import keyword_tokens
from tributary.functions.timefmt import (event_time, flexible_event_time, second_event_time,
                                         window_text_columns)
from tributary.operators.lookup import lookup, skus_with_spu
from tributary.operators.visits import is_entry_page
from tributary.schemas import (APPRAISE_GOOD, DISPLAY, KEYWORD_SOURCE, MONEY, MONEY_SUM,
                               PRODUCT_STATS_COLUMNS, PROVINCE_STATS_COLUMNS,
                               VISITOR_STATS_COLUMNS, WATERMARK_DELAY, WINDOW_SIZE)

REFUND_TYPE = "decimal(18,4)"
REFUND_SUM = "decimal(38,4)"


def _windowed(df: DataFrame, time_col: Column, size: str, delay: str | None) -> tuple[DataFrame, Column]:
    """Attach the event-time column ``__et`` (with a watermark on streams) and its window."""
    df = df.withColumn("__et", time_col)
    if df.isStreaming and delay is not None:
        df = df.withWatermark("__et", delay)
    return df, F.window("__et", size)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


# ------------------------------------------------------------------ visitor stats
VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]
VISITOR_METRICS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _visitor_rows(df: DataFrame, uv=0, pv=0, sv: Column | int = 0, uj=0,
                  dur: Column | int = 0) -> DataFrame:
    def lit(v):
        return (v if isinstance(v, Column) else F.lit(v)).cast("bigint")
    return df.select(*[F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS],
                     lit(uv).alias("uv_ct"), lit(pv).alias("pv_ct"), lit(sv).alias("sv_ct"),
                     lit(uj).alias("uj_ct"), lit(dur).alias("dur_sum"), F.col("ts"))


def visitor_events(unique_visits: DataFrame, bounces: DataFrame, pages: DataFrame) -> DataFrame:
    """P12 + U2: unique visits (uv), bounces (uj) and page views (pv, sv, duration)."""
    uv = _visitor_rows(unique_visits, uv=1)
    uj = _visitor_rows(bounces, uj=1)
    pv = _visitor_rows(pages, pv=1, sv=F.when(is_entry_page(), 1).otherwise(0),
                       dur=F.coalesce(F.col("page.during_time"), F.lit(0)))
    return union_all([uv, uj, pv])


def visitor_stats(events: DataFrame, size: str = WINDOW_SIZE,
                  delay: str | None = WATERMARK_DELAY["visitor_stats"]) -> DataFrame:
    """A1: sums per (ar, ch, is_new, vc) and tumbling window; ``ts`` = first event's ts."""
    df, win = _windowed(events, event_time("ts"), size, delay)
    agg = df.groupBy(win.alias("window"), *VISITOR_KEYS).agg(
        *[F.sum(m).cast("bigint").alias(m) for m in VISITOR_METRICS], F.min("ts").alias("ts"))
    return agg.select(*window_text_columns(), *VISITOR_KEYS, *VISITOR_METRICS, "ts") \
              .select(*VISITOR_STATS_COLUMNS)


def daily_active(stats: DataFrame) -> DataFrame:
    """Daily active visitors = unique visits per day."""
    return (stats.groupBy(F.substring("stt", 1, 10).alias("day"))
                 .agg(F.sum("uv_ct").cast("bigint").alias("dau")))


def bounce_rate(stats: DataFrame) -> DataFrame:
    """Bounce rate per day = bounces / entries."""
    agg = (stats.groupBy(F.substring("stt", 1, 10).alias("day"))
                .agg(F.sum("sv_ct").cast("bigint").alias("sv_ct"),
                     F.sum("uj_ct").cast("bigint").alias("uj_ct")))
    return agg.withColumn("bounce_rate",
                          F.try_divide(F.col("uj_ct").cast("double"), F.col("sv_ct").cast("double")))


# ------------------------------------------------------------------ product stats
PRODUCT_EVENT_COLUMNS = {
    "sku_id": "bigint", "ts": "bigint", "display_ct": "bigint", "click_ct": "bigint",
    "favor_ct": "bigint", "cart_ct": "bigint", "order_sku_num": "bigint",
    "order_amount": MONEY.simpleString(), "order_id": "bigint",
    "payment_amount": MONEY.simpleString(), "paid_order_id": "bigint",
    "refund_amount": REFUND_TYPE, "refund_order_id": "bigint", "comment_ct": "bigint",
    "good_comment_ct": "bigint",
}


DISPLAYS = T.ArrayType(DISPLAY).simpleString()
ZERO_DEFAULT = {c for c in PRODUCT_EVENT_COLUMNS if c.endswith(("_ct", "_num", "_amount"))}


def _product_rows(df: DataFrame, **values) -> DataFrame:
    """One product-stats row per input row: given metrics, 0 for other metrics, NULL ids."""
    cols = []
    for name, t in PRODUCT_EVENT_COLUMNS.items():
        v = values.get(name)
        if v is None:
            v = F.lit(0) if name in ZERO_DEFAULT else F.lit(None)
        elif not isinstance(v, Column):
            v = F.lit(v)
        cols.append(v.cast(t).alias(name))
    return df.select(*cols)


def product_clicks(pages: DataFrame) -> DataFrame:
    """A click is a ``good_detail`` page whose item is a sku."""
    return (pages.filter((F.col("page.page_id") == "good_detail")
                         & (F.col("page.item_type") == "sku_id"))
                 .select(F.col("page.item").try_cast("bigint").alias("sku_id"), "ts"))


def product_displays(pages: DataFrame) -> DataFrame:
    """Every displayed sku of a page (one page may yield a click and displays)."""
    d = pages.select("ts", F.explode("displays").alias("__d"))
    return (d.filter(F.col("__d.item_type") == "sku_id")
             .select(F.col("__d.item").try_cast("bigint").alias("sku_id"), "ts"))


def product_page_events(pages: DataFrame) -> DataFrame:
    """P11 + P12: the click and the displays of a page in one pass, as rows of the product statistics."""
    def sku(item: Column, click: int) -> Column:
        return F.struct(item.try_cast("bigint").alias("sku_id"), F.lit(click).alias("click_ct"), F.lit(1 - click).alias("display_ct"))
    clicked = (F.col("page.page_id") == "good_detail") & (F.col("page.item_type") == "sku_id")
    click = F.when(clicked, F.array(sku(F.col("page.item"), 1))).otherwise(F.array().cast("array<struct<sku_id:bigint,click_ct:int,display_ct:int>>"))
    shown = F.transform(F.filter(F.coalesce("displays", F.array().cast(DISPLAYS)), lambda d: d["item_type"] == "sku_id"), lambda d: sku(d["item"], 0))
    e = pages.select("ts", F.explode(F.concat(click, shown)).alias("__e"))
    return _product_rows(e, sku_id=F.col("__e.sku_id"), ts=F.col("ts"), click_ct=F.col("__e.click_ct"), display_ct=F.col("__e.display_ct"))


def product_events(pages: DataFrame, favor: DataFrame, cart: DataFrame, order_wide: DataFrame,
                   payment_wide: DataFrame, refund: DataFrame, comment: DataFrame) -> DataFrame:
    """P12 + U3: the seven product inputs mapped to one row shape and unioned.

    Order and payment amounts are the item's ``order_price`` (not times ``sku_num``), as in
    the original.  Each refund / comment change is one event.
    """
    ms = lambda c: F.col(c).cast("string").try_cast("bigint")
    parts = [
        product_page_events(pages),
        _product_rows(favor, sku_id=F.col("sku_id"), ts=ms("create_time"), favor_ct=1),
        _product_rows(cart, sku_id=F.col("sku_id"), ts=ms("create_time"), cart_ct=1),
        _product_rows(order_wide, sku_id=F.col("sku_id"), ts=ms("create_time"),
                      order_sku_num=F.col("sku_num"), order_amount=F.col("order_price"),
                      order_id=F.col("order_id")),
        _product_rows(payment_wide, sku_id=F.col("sku_id"), ts=ms("payment_create_time"),
                      payment_amount=F.col("order_price"), paid_order_id=F.col("order_id")),
        _product_rows(refund, sku_id=F.col("sku_id"), ts=ms("create_time"),
                      refund_amount=F.col("refund_amount"), refund_order_id=F.col("order_id")),
        _product_rows(comment, sku_id=F.col("sku_id"), ts=ms("create_time"), comment_ct=1,
                      good_comment_ct=F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)),
    ]
    return union_all(parts)


PRODUCT_SUMS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
                "comment_ct", "good_comment_ct"]
PRODUCT_AMOUNTS = {"order_amount": MONEY_SUM, "payment_amount": MONEY_SUM,
                   "refund_amount": REFUND_SUM}
PRODUCT_SETS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id",
                "refund_order_ct": "refund_order_id"}


def _product_orders(events: DataFrame, size: str, delay: str | None) -> DataFrame:
    """Phase 1 of the product statistics: sums per (window, sku, kind, order id of that kind)."""
    df, win = _windowed(events, event_time("ts"), size, delay)
    kind_id = F.coalesce(*[F.col(src) for src in PRODUCT_SETS.values()])
    kind = F.when(F.col("order_id").isNotNull(), 1).when(F.col("paid_order_id").isNotNull(), 2) \
            .when(F.col("refund_order_id").isNotNull(), 3).otherwise(0)
    df = df.withColumn("__kid", kind_id).withColumn("__kind", kind)
    return df.groupBy(win.alias("window"), "sku_id", "__kind", "__kid").agg(
        *[F.sum(c).alias(c) for c in PRODUCT_SUMS],
        *[F.sum(c).alias(c) for c in PRODUCT_AMOUNTS], F.min("ts").alias("ts"))


def compact_product_events(events: DataFrame, size: str = WINDOW_SIZE) -> DataFrame:
    """The events of one (window, sku, order) as one event, at the time of the first: the product statistics are the same,
    and an event with an order id stands for one order.  Amounts are of the statistics' own types."""
    p1 = _product_orders(events, size, None)
    ids = {src: F.when(F.col("__kind") == i + 1, F.col("__kid")) for i, src in enumerate(PRODUCT_SETS.values())}
    return p1.select(*[(F.col(c).cast(PRODUCT_AMOUNTS[c]) if c in PRODUCT_AMOUNTS else ids.get(c, F.col(c))).alias(c)
                       for c in PRODUCT_EVENT_COLUMNS])


def product_stats_raw(events: DataFrame, size: str = WINDOW_SIZE,
                      delay: str | None = WATERMARK_DELAY["product_stats"]) -> DataFrame:
    """A2 + A3 before the lookups: sums and exact distinct order counts per (window, sku).

    Two aggregation phases, no Expand and no sets: phase 1 groups by (window, sku, kind,
    order id of that kind) so each distinct order collapses to one row (map-side partial
    aggregation first, so a hot sku is pre-aggregated before any shuffle); phase 2 sums
    those rows and counts the ids per kind.  On a stream the two phases are chained
    stateful aggregations in append mode (Spark rejects COUNT DISTINCT on streams): state
    is one row per (window, sku, order), never a growing set per (window, sku).
    """
    p1 = _product_orders(events, size, delay)
    agg = p1.groupBy("window", "sku_id").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in PRODUCT_SUMS],
        *[F.sum(c).cast(t).alias(c) for c, t in PRODUCT_AMOUNTS.items()],
        *[F.count(F.when(F.col("__kind") == i + 1, F.col("__kid"))).cast("bigint").alias(out)
          for i, out in enumerate(PRODUCT_SETS)],
        F.min("ts").alias("ts"))
    return agg.select(*window_text_columns(), "sku_id", *PRODUCT_SUMS, *PRODUCT_AMOUNTS,
                      *PRODUCT_SETS, "ts")


def product_stats(events: DataFrame, dims: dict[str, DataFrame], size: str = WINDOW_SIZE,
                  delay: str | None = WATERMARK_DELAY["product_stats"], missing: str = "keep") -> DataFrame:
    """A2: product statistics with sku, spu, category3 and trademark attributes."""
    s = product_stats_raw(events, size, delay)
    kw = {"missing": missing}
    sku = skus_with_spu(dims, ("sku_name", "price", "spu_id", "tm_id", "category3_id"), missing)
    s = lookup(s, sku, "sku_id", {"sku_name": "sku_name", "price": "sku_price", "spu_id": "spu_id",
                                  "tm_id": "tm_id", "category3_id": "category3_id", "spu_name": "spu_name"}, **kw)
    s = s.withColumn("sku_price", F.col("sku_price").try_cast(MONEY))
    s = lookup(s, dims["dim_base_category3"], "category3_id", {"name": "category3_name"}, **kw)
    s = lookup(s, dims["dim_base_trademark"], "tm_id", {"tm_name": "tm_name"}, **kw)
    return s.select(*PRODUCT_STATS_COLUMNS)


# ----------------------------------------------------------------- province stats
PROVINCE_KEYS = ["province_id", "province_name", "province_area_code", "province_iso_code",
                 "province_3166_2_code"]


def province_stats(order_wide: DataFrame, size: str = WINDOW_SIZE,
                   delay: str | None = WATERMARK_DELAY["province_stats"],
                   amount_col: str = "total_amount", with_ts: bool = True) -> DataFrame:
    """A4: distinct orders and amount per province and window.

    Like the original SQL, ``SUM(total_amount)`` adds the order-level amount once per
    item row; pass ``amount_col="split_total_amount"`` for the per-item amount instead.
    Event time accepts ``create_time`` as ``yyyy-MM-dd HH:mm:ss`` or epoch-ms text.
    ``ts`` is the wall clock at evaluation (as ``UNIX_TIMESTAMP()*1000``).
    """
    df, win = _windowed(order_wide, flexible_event_time("create_time"), size, delay)
    amount = F.col(amount_col).cast(MONEY_SUM)
    # Distinct orders in two phases (also on streams, as chained stateful aggregations):
    # one row per (window, province, order), then count and sum per (window, province).
    p1 = (df.groupBy(win.alias("window"), *PROVINCE_KEYS, "order_id")
            .agg(F.sum(amount).alias("__amt")))
    agg = p1.groupBy("window", *PROVINCE_KEYS).agg(
        F.sum("__amt").cast(MONEY_SUM).alias("order_amount"),
        F.count("order_id").cast("bigint").alias("order_count"))
    out = agg.select(*window_text_columns(), *PROVINCE_KEYS, "order_amount", "order_count",
                     (F.unix_timestamp() * 1000).alias("ts"))
    cols = PROVINCE_STATS_COLUMNS if with_ts else PROVINCE_STATS_COLUMNS[:-1]
    return out.select(*cols)


# ------------------------------------------------------------------ keyword stats
def search_terms(pages: DataFrame, offset: str = "offset") -> DataFrame:
    """P10: pages reached from search with a search phrase; ``rt`` is second-precision time."""
    f = pages.filter((F.col("page.last_page_id") == "search") & F.col("page.item").isNotNull())
    keep = [offset] if offset in pages.columns else []
    return f.select(*keep, F.col("page.item").alias("full_word"), "ts",
                    second_event_time("ts").alias("rt"))


def keyword_split(terms: DataFrame) -> DataFrame:
    """Lateral table-function join; a phrase without words yields no row."""
    keep = [c for c in terms.columns if c != "full_word"]
    return terms.select(*keep, F.explode(keyword_tokens("full_word")).alias("word"))


def keyword_stats(words: DataFrame, size: str = WINDOW_SIZE,
                  delay: str | None = WATERMARK_DELAY["keyword_stats"],
                  with_ts: bool = True) -> DataFrame:
    """A5: word count per tumbling window with the constant source ``search``."""
    df, win = _windowed(words, F.col("rt"), size, delay)
    agg = df.groupBy(win.alias("window"), F.col("word")).agg(F.count(F.lit(1)).alias("ct"))
    out = agg.select(F.col("word").alias("keyword"), F.col("ct").cast("bigint").alias("ct"),
                     F.lit(KEYWORD_SOURCE).alias("source"), *window_text_columns(),
                     (F.unix_timestamp() * 1000).alias("ts"))
    return out if with_ts else out.drop("ts")
