"""The warehouse over one dataset: every layer as a lazily built DataFrame.

``Warehouse(spark, sf_dir)`` wires the operators together the way the original jobs
are chained (ODS -> DWD -> DWM -> DWS) but as one logical plan per requested output,
so Catalyst prunes every column and input an output does not need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import cdc, logs, orders, stats, visits
from tributary.operators.lookup import lookup
from tributary.plans.layers import materialize
from tributary.session import configure
from tributary.sources import changes as change_sources
from tributary.sources import testdata

# Parameters of the registered queries.  The provided events are sparse (hours between
# a visitor's events), so the checked queries use day windows and a 6-hour bounce
# window; the original 10-second defaults are exercised by literal-fixture tests.
QUERY_WINDOW = "1 day"
QUERY_WITHIN = "6 hours"
QUERY_AS_OF = "2024-06-01 00:00:00"

# Layers a plan may fan out from (the topics between the original jobs).
LAYERS = frozenset({"dwd_valid_log", "dwd_log", "dwm_order_wide", "ods_base_db"})

# What the product statistics read of the order wide table.
PRODUCT_ORDER_COLUMNS = ("order_id", "sku_id", "sku_num", "order_price", "create_time")


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, window: str = QUERY_WINDOW,
                 within: str = QUERY_WITHIN, as_of: str | None = QUERY_AS_OF,
                 layered: bool = True, layers: frozenset[str] | None = None):
        """``layered``: write fan-out layers once to the shared checkpoint folder instead of
        recomputing them per consumer.  ``layers`` limits that to the named layers
        (``LAYERS``); a plan that reads a layer only once gains nothing from writing it."""
        self.spark = configure(spark)
        self.layered = layered
        self.layers = LAYERS if layers is None else frozenset(layers)
        self.sf_dir = sf_dir
        self.window = window
        self.within = within
        self.as_of = as_of

    def _layer(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.layered and name in self.layers else df

    @property
    def as_of_col(self) -> Column | None:
        return F.to_timestamp(F.lit(self.as_of)) if self.as_of else None

    # ------------------------------------------------------------------ log path
    @cached_property
    def log_lines(self) -> DataFrame:
        return testdata.log_lines(self.spark, self.sf_dir).drop("ts_ms")

    @cached_property
    def parsed(self) -> DataFrame:
        return logs.parse_logs(self.log_lines)

    @cached_property
    def valid(self) -> DataFrame:
        return self._layer(logs.valid_logs(self.parsed), "dwd_valid_log")

    @cached_property
    def repaired(self) -> DataFrame:
        return self._layer(logs.repair_new_flag(self.valid), "dwd_log")

    @cached_property
    def pages(self) -> DataFrame:
        return logs.page_logs(self.repaired)

    @cached_property
    def page_views(self) -> DataFrame:
        """The page log for jobs that do not look at the new-visitor flag: read once, so not written and not repaired."""
        return logs.page_logs(logs.valid_logs(self.parsed))

    @cached_property
    def starts(self) -> DataFrame:
        return logs.start_logs(self.repaired)

    @cached_property
    def unique_visits(self) -> DataFrame:
        return visits.unique_visits(self.pages)

    @cached_property
    def bounces(self) -> DataFrame:
        return visits.bounces(self.pages, within=self.within)

    @cached_property
    def visitor_events(self) -> DataFrame:
        return stats.visitor_events(self.unique_visits, self.bounces, self.pages)

    @cached_property
    def visitor_stats(self) -> DataFrame:
        return stats.visitor_stats(self.visitor_events, size=self.window)

    # ---------------------------------------------------------------- order path
    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return testdata.dims(self.spark, self.sf_dir)

    @cached_property
    def order_info(self) -> DataFrame:
        return testdata.order_info(self.spark, self.sf_dir)

    @cached_property
    def order_detail(self) -> DataFrame:
        return testdata.order_detail(self.spark, self.sf_dir)

    @cached_property
    def order_wide_base(self) -> DataFrame:
        return self._layer(orders.order_wide_base(self.order_info, self.order_detail),
                           "dwm_order_wide")

    def order_wide(self, missing: str = "keep") -> DataFrame:
        return orders.enrich_order_wide(self.order_wide_base, self.dims, as_of=self.as_of_col,
                                        missing=missing)

    @cached_property
    def payment_wide(self) -> DataFrame:
        return orders.payment_wide(testdata.payment_info(self.spark, self.sf_dir),
                                   self.order_wide_base)

    @cached_property
    def product_orders(self) -> DataFrame:
        """The order wide table of the product jobs: both readers need these columns only, so the layer has no others."""
        return self._layer(orders.order_wide_base(self.order_info, self.order_detail).select(*PRODUCT_ORDER_COLUMNS), "dwm_order_wide")

    @cached_property
    def product_payments(self) -> DataFrame:
        return orders.payment_wide(testdata.payment_info(self.spark, self.sf_dir), self.product_orders)

    @cached_property
    def product_events(self) -> DataFrame:
        s, d = self.spark, self.sf_dir
        return stats.product_events(self.page_views, testdata.favor_info(s, d), testdata.cart_info(s, d), self.product_orders,
                                    self.product_payments, testdata.order_refund_info(s, d), testdata.comment_info(s, d))

    @cached_property
    def product_stats(self) -> DataFrame:
        return stats.product_stats(self.product_events, self.dims, size=self.window)

    @cached_property
    def province_stats(self) -> DataFrame:
        # Only the province attributes are needed: look up that one dimension.
        w = lookup(self.order_wide_base, self.dims["dim_base_province"], "province_id",
                   {"name": "province_name", "area_code": "province_area_code",
                    "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})
        return stats.province_stats(w, size=self.window, with_ts=False)

    # -------------------------------------------------------------- search path
    @cached_property
    def search_terms(self) -> DataFrame:
        return stats.search_terms(self.page_views)

    @cached_property
    def keyword_words(self) -> DataFrame:
        return stats.keyword_split(self.search_terms)

    @cached_property
    def keyword_stats(self) -> DataFrame:
        return stats.keyword_stats(self.keyword_words, size=self.window, with_ts=False)

    # ------------------------------------------------------------------ CDC path
    @cached_property
    def raw_changes(self) -> DataFrame:
        return testdata.raw_change_records(self.spark, self.sf_dir)

    @cached_property
    def envelopes(self) -> DataFrame:
        """Normalised change events, serialised to the change topic and parsed back."""
        env = cdc.normalize_changes(self.raw_changes)
        return self._layer(cdc.parse_changes(cdc.envelope_json(env)), "ods_base_db")

    @cached_property
    def routed(self) -> DataFrame:
        rules = cdc.latest_rules(change_sources.routing_rules(self.spark))
        return cdc.route(cdc.drop_deletes(self.envelopes), rules)

    @cached_property
    def routed_versions(self) -> DataFrame:
        versions = cdc.rule_versions(change_sources.rule_change_log(self.spark))
        return cdc.route(cdc.drop_deletes(self.envelopes), versions, seq="offset")
