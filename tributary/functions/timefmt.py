"""Time conversions used by the jobs: epoch-ms <-> timestamps <-> text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.schemas import DAY_TEXT, TIME_TEXT

MS_PER_365_DAYS = 365 * 24 * 3600 * 1000


def duration_ms(text: str) -> int:
    """'10 seconds' / '6 hours' / '15 minutes' / '500 milliseconds' -> milliseconds."""
    amount, unit = text.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    scale = {"millisecond": 1, "ms": 1, "second": 1000, "sec": 1000, "minute": 60_000,
             "min": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}[unit]
    return int(float(amount) * scale)


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP (millisecond precision)."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def second_event_time(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP truncated to the second (``TO_TIMESTAMP(FROM_UNIXTIME(ts/1000))``)."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_seconds(F.floor(c / 1000))


def flexible_event_time(text: Column | str) -> Column:
    """Event time from a ``create_time`` that is either ``yyyy-MM-dd HH:mm:ss`` text or epoch-ms text."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.try_to_timestamp(c, F.lit(TIME_TEXT)),
                      F.timestamp_millis(c.try_cast("bigint")))


def time_text(ts: Column | str) -> Column:
    return F.date_format(ts, TIME_TEXT)


def day_text(ts: Column | str) -> Column:
    return F.date_format(ts, DAY_TEXT)


def epoch_days_to_text(days: Column | str) -> Column:
    """Change-capture DATE (days since epoch) -> ``yyyy-MM-dd``."""
    c = F.col(days) if isinstance(days, str) else days
    return F.date_format(F.date_from_unix_date(c.cast("int")), DAY_TEXT)


def age_in_years(birthday_text: Column | str, as_of: Column | None = None) -> Column:
    """Whole 365-day years between ``birthday`` (yyyy-MM-dd) and ``as_of`` (default: now)."""
    b = F.col(birthday_text) if isinstance(birthday_text, str) else birthday_text
    now_ms = F.unix_millis(as_of if as_of is not None else F.current_timestamp())
    born_ms = F.unix_millis(F.to_timestamp(b, DAY_TEXT))
    return F.floor((now_ms - born_ms) / MS_PER_365_DAYS).cast("int")


def window_text_columns(window_col: str = "window") -> list[Column]:
    """``stt`` / ``edt`` text of a ``window()`` struct."""
    return [time_text(F.col(f"{window_col}.start")).alias("stt"),
            time_text(F.col(f"{window_col}.end")).alias("edt")]
