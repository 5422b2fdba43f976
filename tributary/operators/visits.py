"""Visit-level detail: unique visits (T2/T3) and bounces (T4), batch forms.

Both are per-visitor sequence rules.  Neither form below partitions by visitor alone:
a visitor that holds a third of all rows would otherwise be sorted in one task.
Unique visits group by (visitor, day); bounces look only at the next event inside a
time bucket of the pattern window, plus the first event of the following bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.timefmt import day_text, duration_ms, event_time
from tributary.operators.logs import from_order_key, order_key
from tributary.schemas import BOUNCE_WITHIN


def is_entry_page(last_page_id: Column | None = None) -> Column:
    """An entry page has no previous page (NULL or empty ``last_page_id``)."""
    c = F.col("page.last_page_id") if last_page_id is None else last_page_id
    return c.isNull() | (F.length(c) == 0)


def untimed(pages: DataFrame) -> DataFrame:
    """The side output of the bounce job: valid records whose ``ts`` is missing or no number."""
    return pages.filter(F.col("ts").isNull())


def unique_visits(pages: DataFrame, offset: str = "offset") -> DataFrame:
    """T2 (batch): the first entry page of each visitor on each day (session time zone).

    The least (ts, offset) of a visitor and day, as one number that a hash aggregate combines before the
    shuffle, names the record; a semi-join on it brings the record.  Output: the page record plus
    ``visit_day``.  Records of one visitor that share time and offset are all returned.  The stream form, which emits at
    once, is ``streaming.stateful.unique_visit_stream``.
    """
    entries = _entries(pages).withColumn("__mid", F.col("common.mid")).withColumn("__key", order_key(offset=offset))
    first = _first_entries(entries).toDF("__m", "__d", "__first")
    same = F.col("__mid").eqNullSafe(F.col("__m")) & F.col("visit_day").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__first"))
    return entries.join(first, same, "left_semi").select(*pages.columns, "visit_day")


def _entries(pages: DataFrame) -> DataFrame:
    return pages.filter(is_entry_page()).withColumn("visit_day", day_text(event_time("ts")))


def _first_entries(entries: DataFrame) -> DataFrame:
    return entries.groupBy("__mid", "visit_day").agg(F.min("__key").alias("__first"))


def unique_visit_times(pages: DataFrame, offset: str = "offset") -> DataFrame:
    """T2 (batch) without the record: (mid, visit_day, ts, offset), from the aggregate alone.  A missing offset reads 0."""
    entries = _entries(pages).select(F.col("common.mid").alias("__mid"), "visit_day", order_key(offset=offset).alias("__key"))
    ts, at = from_order_key(F.col("__first"))
    return _first_entries(entries).select(F.col("__mid").alias("mid"), "visit_day", ts.alias("ts"), at.alias(offset))


def bounces(pages: DataFrame, within: str = BOUNCE_WITHIN, offset: str = "offset") -> DataFrame:
    """T4 (batch): entry pages not followed by another page of the visit within ``within``.

    Entry event e is a bounce iff the visitor's next event (by ts, offset) is absent, is
    at least ``within`` later, or is itself an entry page (the two-entry pattern
    matched).  A non-entry page within the window continues the visit.

    Events are bucketed by ``ts div within``.  What follows an event within ``within`` lies in its bucket or in the
    next one, so every event goes to its own bucket and, without its record, to the one before; there the next
    event of e is the next row, or e is followed by nothing for longer than ``within``.  One shuffle, and its groups are
    (visitor, two buckets): bounded by one visitor's activity in two windows.  Records without a time take no
    part (``untimed``).
    """
    w_ms = duration_ms(within)
    bucket = F.floor(F.col("ts") / w_ms)
    ev = (pages.filter(F.col("ts").isNotNull())
               .select("*", F.col("common.mid").alias("__mid"), is_entry_page().alias("__entry"), bucket.alias("__own"),
                       F.explode(F.array(bucket, bucket - 1)).alias("__bucket")))
    own = F.col("__own") == F.col("__bucket")
    carried = [c for c in pages.columns if c not in ("ts", offset)]
    ev = ev.select("__mid", "__bucket", "__entry", own.alias("__is_own"), "ts", offset, *(F.when(own, F.col(c)).alias(c) for c in carried))
    w = Window.partitionBy("__mid", "__bucket").orderBy("ts", offset)
    ev = ev.withColumns({"__next_ts": F.lead("ts").over(w), "__next_entry": F.lead("__entry").over(w)})
    bounce = F.col("__next_ts").isNull() | (F.col("__next_ts") - F.col("ts") >= w_ms) | F.col("__next_entry")
    return ev.filter(F.col("__is_own") & F.col("__entry") & bounce).select(*pages.columns)
