"""Column-expression helpers (all native Spark SQL expressions, no Python per row)."""

from tributary.functions.timefmt import (  # noqa: F401
    age_in_years, day_text, duration_ms, epoch_days_to_text, event_time, flexible_event_time,
    second_event_time, time_text, window_text_columns,
)
from tributary.functions.keywords import keyword_tokens, register_split_words  # noqa: F401
