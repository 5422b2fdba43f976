"""Declared stream tables (S4): what a SQL job reads and how its time runs.

A declaration names the columns of a topic's records, columns computed from them (the event time among them)
and the watermark on the event time.  ``create_view`` registers a topic, a stream or a batch table of ``value`` JSON
texts, as a view of that shape, so one SQL text serves both.  On a stream the watermark closes windows; in a batch it
has no meaning and is left out.

A distinct count can't run on a stream as ``count(DISTINCT x)``.  The statements here count in two chained
windowed aggregates: one row per (window, keys, x), then a count per (window, keys).  The state is one row per
distinct x instead of a growing set, and in a batch the first aggregate is combined before its shuffle.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.keywords import register_split_words
from tributary.schemas import WATERMARK_DELAY


@dataclass(frozen=True)
class StreamTable:
    """``columns``: DDL of the record; ``computed``: name -> SQL expression over the columns and the
    computed ones before it; ``watermark``: (computed time column, delay)."""

    name: str
    columns: str
    computed: dict[str, str] = field(default_factory=dict)
    watermark: tuple[str, str] | None = None

    def rows(self, topic: DataFrame, value: str = "value") -> DataFrame:
        """The declared columns of a topic of JSON texts; a record that is no object of this shape has NULLs."""
        table = topic.select(F.from_json(value, self.columns).alias("r")).select("r.*")
        for name, expression in self.computed.items():
            table = table.withColumn(name, F.expr(expression))
        if self.watermark and table.isStreaming:
            table = table.withWatermark(*self.watermark)
        return table

    def create_view(self, topic: DataFrame, value: str = "value") -> str:
        """Registers the table for ``spark.sql``; the view's name is new for every call (views are session-wide)."""
        name = f"{self.name}_{uuid.uuid4().hex[:12]}"
        self.rows(topic, value).createOrReplaceTempView(name)
        return name


PAGE_TABLE = StreamTable(
    "page_view", "common MAP<STRING,STRING>, page MAP<STRING,STRING>, ts BIGINT",
    computed={"rt": "timestamp_seconds(ts div 1000)"},
    watermark=("rt", WATERMARK_DELAY["keyword_stats"]))

ORDER_WIDE_TABLE = StreamTable(
    "order_wide", "province_id BIGINT, province_name STRING, province_area_code STRING, province_iso_code STRING, "
    "province_3166_2_code STRING, order_id BIGINT, total_amount DECIMAL(16,2), create_time STRING",
    computed={"rowtime": "coalesce(try_to_timestamp(create_time, 'yyyy-MM-dd HH:mm:ss'), "
                         "timestamp_millis(try_cast(create_time AS BIGINT)))"},
    watermark=("rowtime", WATERMARK_DELAY["province_stats"]))

KEYWORD_SQL = """
WITH full_words AS (
  SELECT page.item AS full_word, rt FROM {view}
  WHERE page.last_page_id = 'search' AND page.item IS NOT NULL),
words AS (
  SELECT word, rt FROM full_words, LATERAL split_words(full_word))
SELECT word AS keyword, count(*) AS ct, 'search' AS source,
       date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt
FROM words
GROUP BY word, window(rt, '{size}')
"""

PROVINCE_SQL = """
WITH orders_of_window AS (
  SELECT window(rowtime, '{size}') AS w, province_id, province_name, province_area_code, province_iso_code,
         province_3166_2_code, order_id, sum(CAST(total_amount AS DECIMAL(38,2))) AS amount
  FROM {view}
  GROUP BY window(rowtime, '{size}'), province_id, province_name, province_area_code, province_iso_code,
           province_3166_2_code, order_id)
SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(w.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       CAST(sum(amount) AS DECIMAL(38,2)) AS order_amount, count(order_id) AS order_count
FROM orders_of_window
GROUP BY w, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code
"""


def keyword_stats_sql(spark: SparkSession, page_topic: DataFrame, size: str) -> DataFrame:
    """The keyword job as SQL over the page topic (``value`` texts), a stream or a batch table."""
    register_split_words(spark)
    return spark.sql(KEYWORD_SQL.format(view=PAGE_TABLE.create_view(page_topic), size=size))


def province_stats_sql(spark: SparkSession, order_wide_topic: DataFrame, size: str) -> DataFrame:
    """The province job as SQL over the order wide topic (``value`` texts), a stream or a batch table."""
    return spark.sql(PROVINCE_SQL.format(view=ORDER_WIDE_TABLE.create_view(order_wide_topic), size=size))
