"""The SQL path: the province and keyword jobs written as SQL over temporary views.

The original wrote these two jobs in SQL (a table DDL with a computed time column and a
watermark, then a windowed GROUP BY, and a lateral table function for the keywords).
Here the same statements run through ``spark.sql``; Catalyst plans them like the
DataFrame versions in ``operators.stats``.  On a stream, register a streaming
DataFrame (with its watermark) as the view and the same SQL runs incrementally.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tributary.functions.keywords import register_split_words
from tributary.operators.lookup import lookup
from tributary.plans.warehouse import QUERY_WINDOW, Warehouse

KEYWORD_SQL = """
WITH full_words AS (
  SELECT page.item AS full_word, timestamp_seconds(ts div 1000) AS rt
  FROM {view}
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
WITH order_wide AS (
  SELECT *, coalesce(try_to_timestamp(create_time, 'yyyy-MM-dd HH:mm:ss'),
                     timestamp_millis(try_cast(create_time AS BIGINT))) AS rowtime
  FROM {view})
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       province_id, province_name, province_area_code, province_iso_code, province_3166_2_code,
       CAST(sum(total_amount) AS DECIMAL(38,2)) AS order_amount,
       CAST(count(DISTINCT order_id) AS BIGINT) AS order_count
FROM order_wide
GROUP BY window(rowtime, '{size}'), province_id, province_name, province_area_code,
         province_iso_code, province_3166_2_code
"""


def _view(df: DataFrame, prefix: str) -> str:
    """Register ``df`` under a name unique to this call (views are session-wide)."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def keyword_stats_sql(pages: DataFrame, size: str = QUERY_WINDOW) -> DataFrame:
    spark = pages.sparkSession
    register_split_words(spark)
    return spark.sql(KEYWORD_SQL.format(view=_view(pages, "page_view"), size=size))


def province_stats_sql(order_wide: DataFrame, size: str = QUERY_WINDOW) -> DataFrame:
    spark = order_wide.sparkSession
    return spark.sql(PROVINCE_SQL.format(view=_view(order_wide, "order_wide"), size=size))


def keyword_stats_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_stats_sql(Warehouse(spark, sf_dir, layers=frozenset()).page_views)


def province_stats_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Warehouse(spark, sf_dir, layers=frozenset())
    ow = lookup(w.order_wide_base.drop("rowtime"), w.dims["dim_base_province"], "province_id",
                {"name": "province_name", "area_code": "province_area_code",
                 "iso_code": "province_iso_code", "iso_3166_2": "province_3166_2_code"})
    return province_stats_sql(ow)
