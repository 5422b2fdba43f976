"""Sinks: topics (fixed and per-record), dimension tables (partial-column upsert) and the
OLAP statistics tables.  Every streaming sink is idempotent per micro-batch id."""
