"""tributary: a layered real-time e-commerce warehouse on Spark SQL and Structured Streaming.

Every operator is a ``DataFrame -> DataFrame`` function.  The same function serves a
batch table and a streaming DataFrame wherever Spark allows it; the few operators
whose streaming form needs explicit state live in :mod:`tributary.streaming`.
"""

from tributary.session import configure, get_session  # noqa: F401

__all__ = ["configure", "get_session"]
