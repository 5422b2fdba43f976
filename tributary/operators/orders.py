"""Order-side detail: order times, order x detail and payment x order-wide interval joins,
the merge projections and dimension enrichment (snowflake of six lookups).

The join functions take plain or streaming DataFrames alike: the time-range condition is
written on TIMESTAMP event-time columns, which is what Spark needs to bound the state of
a stream-stream join once both sides carry watermarks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.timefmt import age_in_years
from tributary.operators.lookup import lookup, skus_with_spu
from tributary.schemas import (MONEY, ORDER_JOIN_LOWER_S, ORDER_JOIN_UPPER_S, ORDER_WIDE_COLUMNS,
                               PAYMENT_JOIN_LOWER_S, PAYMENT_JOIN_UPPER_S, PAYMENT_WIDE_COLUMNS,
                               WATERMARK_DELAY)

# Types of the wide-table fields (all amounts are DECIMAL, never DOUBLE).
WIDE_TYPES = {
    "detail_id": "bigint", "order_id": "bigint", "sku_id": "bigint", "order_price": MONEY,
    "sku_num": "bigint", "sku_name": "string", "province_id": "bigint", "order_status": "string",
    "user_id": "bigint", "total_amount": MONEY, "activity_reduce_amount": MONEY,
    "coupon_reduce_amount": MONEY, "original_total_amount": MONEY, "feight_fee": MONEY,
    "split_feight_fee": MONEY, "split_activity_amount": MONEY, "split_coupon_amount": MONEY,
    "split_total_amount": "decimal(18,4)", "expire_time": "string", "create_time": "string",
    "operate_time": "string", "create_date": "string", "create_hour": "string",
    "province_name": "string", "province_area_code": "string", "province_iso_code": "string",
    "province_3166_2_code": "string", "user_age": "int", "user_gender": "string",
    "spu_id": "bigint", "tm_id": "bigint", "category3_id": "bigint", "spu_name": "string",
    "tm_name": "string", "category3_name": "string",
    "payment_id": "bigint", "subject": "string", "payment_type": "string",
    "payment_create_time": "string", "callback_time": "string", "order_create_time": "string",
}


def _get(df: DataFrame, name: str, alias: str | None = None, prefix: str = "") -> Column:
    """Column ``prefix+name`` of ``df`` cast to the wide type, or a typed NULL if absent."""
    out = alias or name
    t = WIDE_TYPES.get(out, "string")
    if prefix + name in df.columns:
        return F.col(prefix + name).cast(t).alias(out)
    return F.lit(None).cast(t).alias(out)


def _ms_col(text_ms: str) -> Column:
    return F.col(text_ms).cast("string").try_cast("bigint")


def epoch_ms(create_time: str) -> Column:
    """Event time of the payment join: epoch ms; NULL for other text."""
    return _ms_col(create_time)


def create_second_ms(create_time: str) -> Column:
    """Event time of the order join: epoch ms at second precision; NULL for other text."""
    return F.floor(_ms_col(create_time) / 1000) * 1000


def time_parse_errors(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Side output: records whose ``create_time`` is not epoch-ms text.

    Such records cannot take part in an interval join (their time is NULL).  The original
    silently reused the previous record's timestamp; here they are kept visible instead.
    """
    return df.filter(_ms_col(create_time).isNull())


def order_times(info: DataFrame, create_time: str = "create_time") -> DataFrame:
    """``create_time`` (epoch-ms text) -> ``create_date``, ``create_hour`` (2 digits) and
    ``create_ts`` (epoch ms truncated to the second), plus the event-time column ``rowtime``."""
    sec = F.floor(_ms_col(create_time) / 1000)
    ts = F.timestamp_seconds(sec)
    return info.select("*", F.date_format(ts, "yyyy-MM-dd").alias("create_date"),
                       F.date_format(ts, "HH").alias("create_hour"),
                       (sec * 1000).alias("create_ts"), ts.alias("rowtime"))


def detail_times(detail: DataFrame, create_time: str = "create_time") -> DataFrame:
    sec = F.floor(_ms_col(create_time) / 1000)
    return detail.select("*", (sec * 1000).alias("create_ts"),
                         F.timestamp_seconds(sec).alias("rowtime"))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower_s: int, upper_s: int) -> DataFrame:
    """Inner join on key with ``right_time`` in ``[left_time + lower, left_time + upper]``
    (both ends inclusive).  Columns of the sides are prefixed ``l_`` / ``r_``."""
    lp = left.select(*[F.col(c).alias("l_" + c) for c in left.columns])
    rp = right.select(*[F.col(c).alias("r_" + c) for c in right.columns])
    lt, rt = F.col("l_" + left_time), F.col("r_" + right_time)
    cond = ((F.col("l_" + left_key) == F.col("r_" + right_key))
            & (rt >= lt + F.expr(f"INTERVAL {int(lower_s)} SECONDS"))
            & (rt <= lt + F.expr(f"INTERVAL {int(upper_s)} SECONDS")))
    return lp.join(rp, cond, "inner")


def _watermarked(df: DataFrame, time_col: str, delay: str | None) -> DataFrame:
    """On a stream, bound the lateness of ``time_col`` (batch frames pass through)."""
    return df.withWatermark(time_col, delay) if df.isStreaming and delay is not None else df


def order_wide_base(info: DataFrame, detail: DataFrame, lower_s: int = ORDER_JOIN_LOWER_S,
                    upper_s: int = ORDER_JOIN_UPPER_S,
                    delay: str | None = WATERMARK_DELAY["order_wide"]) -> DataFrame:
    """J1 + J2: order x detail interval join and the merge projection.

    Times are compared at second precision (``create_ts``), as the original did.  Order
    fields come from the order, item fields from the detail; ``expire_time``,
    ``operate_time`` and ``split_feight_fee`` stay NULL.  The event-time column
    ``rowtime`` (the order's) is kept for downstream windows.
    """
    info = order_times(info) if "rowtime" not in info.columns else info
    detail = detail_times(detail) if "rowtime" not in detail.columns else detail
    info, detail = _watermarked(info, "rowtime", delay), _watermarked(detail, "rowtime", delay)
    j = interval_join(info, detail, "id", "order_id", "rowtime", "rowtime", lower_s, upper_s)
    from_info = {"order_id": "id", "order_status": "order_status", "create_time": "create_time",
                 "create_date": "create_date", "create_hour": "create_hour",
                 "activity_reduce_amount": "activity_reduce_amount",
                 "coupon_reduce_amount": "coupon_reduce_amount",
                 "original_total_amount": "original_total_amount", "feight_fee": "feight_fee",
                 "total_amount": "total_amount", "province_id": "province_id",
                 "user_id": "user_id"}
    from_detail = {"detail_id": "id", "sku_id": "sku_id", "sku_name": "sku_name",
                   "order_price": "order_price", "sku_num": "sku_num",
                   "split_activity_amount": "split_activity_amount",
                   "split_coupon_amount": "split_coupon_amount",
                   "split_total_amount": "split_total_amount"}
    cols = []
    for out in ORDER_WIDE_COLUMNS:
        if out in from_info:
            cols.append(_get(j, from_info[out], out, "l_"))
        elif out in from_detail:
            cols.append(_get(j, from_detail[out], out, "r_"))
        else:
            cols.append(F.lit(None).cast(WIDE_TYPES[out]).alias(out))
    return j.select(*cols, F.col("l_rowtime").alias("rowtime"))


def enrich_order_wide(wide: DataFrame, dims: dict[str, DataFrame], as_of: Column | None = None,
                      missing: str = "keep") -> DataFrame:
    """J5a-J5d: user, province, sku, then spu / trademark / category3 by the sku's ids.

    ``as_of`` is the instant ages are computed at (default: now, as the original did).
    """
    kw = {"missing": missing}
    keep = [c for c in wide.columns if c not in ("user_gender", "user_age", "province_name",
                                                 "province_area_code", "province_iso_code",
                                                 "province_3166_2_code", "category3_id", "spu_id",
                                                 "tm_id", "spu_name", "tm_name", "category3_name")]
    w = wide.select(*keep)
    w = lookup(w, dims["dim_user_info"], "user_id",
               {"gender": "user_gender", "birthday": "__birthday"}, **kw)
    w = w.withColumn("user_age", age_in_years("__birthday", as_of)).drop("__birthday")
    w = lookup(w, dims["dim_base_province"], "province_id",
               {"name": "province_name", "area_code": "province_area_code",
                "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"}, **kw)
    sku = skus_with_spu(dims, ("sku_name", "category3_id", "spu_id", "tm_id"), missing)
    w = lookup(w, sku, "sku_id", {c: c for c in ("sku_name", "category3_id", "spu_id", "tm_id", "spu_name")}, overwrite=("sku_name",), **kw)
    w = lookup(w, dims["dim_base_trademark"], "tm_id", {"tm_name": "tm_name"}, **kw)
    w = lookup(w, dims["dim_base_category3"], "category3_id", {"name": "category3_name"}, **kw)
    extra = [c for c in w.columns if c not in ORDER_WIDE_COLUMNS]
    return w.select(*ORDER_WIDE_COLUMNS, *extra)


def merge_order_wide(this: DataFrame, other: DataFrame, key: str = "order_id") -> DataFrame:
    """First-non-null merge of ``this`` with the row of ``other`` sharing ``key``.

    ``other`` must have at most one row per ``key`` (for example order-level fields).
    ``split_activity_amount``, ``split_coupon_amount`` and ``split_total_amount`` keep
    this side's value only (the original merged them with themselves).
    """
    self_only = {"split_activity_amount", "split_coupon_amount", "split_total_amount"}
    b = other.select(*[F.col(c).alias("__o_" + c) for c in other.columns])
    j = this.join(b, F.col(key) == F.col("__o_" + key), "left")
    cols = []
    for c in this.columns:
        if c == key or c in self_only or c not in other.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.coalesce(F.col(c), F.col("__o_" + c)).alias(c))
    return j.select(*cols)


def payment_wide(payment: DataFrame, wide: DataFrame, lower_s: int = PAYMENT_JOIN_LOWER_S,
                 upper_s: int = PAYMENT_JOIN_UPPER_S,
                 delay: str | None = WATERMARK_DELAY["payment_wide"]) -> DataFrame:
    """J3 + J4: payment x order-wide interval join and merge.

    The order-wide row's time (its ``create_time``, millisecond precision) must lie in
    ``[payment time + lower, payment time + upper]``.  Order-wide fields are copied
    first, then every same-named payment field overwrites them (``order_id``,
    ``user_id``, ``total_amount``), NULLs included; ``create_time`` becomes
    ``payment_create_time`` / ``order_create_time``.
    """
    pay = payment.withColumn("paytime", F.timestamp_millis(_ms_col("create_time")))
    ow = wide.withColumn("owtime", F.timestamp_millis(_ms_col("create_time")))
    if "rowtime" in ow.columns:
        ow = ow.drop("rowtime")
    pay, ow = _watermarked(pay, "paytime", delay), _watermarked(ow, "owtime", delay)
    j = interval_join(pay, ow, "order_id", "order_id", "paytime", "owtime", lower_s, upper_s)
    pay_fields = {"order_id", "user_id", "total_amount", "subject", "payment_type",
                  "callback_time"}
    cols = []
    for out in PAYMENT_WIDE_COLUMNS:
        if out == "payment_id":
            cols.append(_get(j, "id", out, "l_"))
        elif out == "payment_create_time":
            cols.append(_get(j, "create_time", out, "l_"))
        elif out == "order_create_time":
            cols.append(_get(j, "create_time", out, "r_"))
        elif out in pay_fields:
            cols.append(_get(j, out, out, "l_"))
        else:
            cols.append(_get(j, out, out, "r_"))
    return j.select(*cols, F.col("l_paytime").alias("rowtime"))
