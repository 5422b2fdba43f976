"""Topic sinks (K1 fixed topic, K2 per-record topic, K6 console)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_topic_records(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Every row as one JSON value (NULL fields omitted, like the original serializer)."""
    cols = [c for c in df.columns if c not in exclude]
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def write_topic(df: DataFrame, path: str | None = None, kafka: dict | None = None,
                topic: str | None = None, mode: str = "append") -> None:
    """K1: write ``value`` rows to one topic (Kafka when ``kafka`` options are given)."""
    if kafka:
        df.write.format("kafka").options(**kafka).option("topic", topic).save()
    else:
        df.select("value").write.mode(mode).text(path)


def write_dynamic_topics(records: DataFrame, path: str | None = None, kafka: dict | None = None,
                         default_topic: str = "dwd_default_topic", mode: str = "append") -> None:
    """K2: ``topic, value`` rows, each to its own topic (files: one folder per topic).

    A NULL topic goes to ``default_topic``.  Kafka delivery is at-least-once; the
    original's producer ran without delivery guarantees.
    """
    r = records.withColumn("topic", F.coalesce(F.col("topic"), F.lit(default_topic)))
    if kafka:
        r.select("topic", "value").write.format("kafka").options(**kafka).save()
    else:
        r.select("topic", "value").write.mode(mode).partitionBy("topic").text(path)


def console(df: DataFrame, prefix: str = "", n: int = 20) -> None:
    """K6: debug print (bounded: at most ``n`` rows reach the driver)."""
    print(prefix)
    df.show(n, truncate=False)
