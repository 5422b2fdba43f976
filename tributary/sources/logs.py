"""Action-log topic source (S1): Kafka or a folder of JSON-line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TOPIC_RECORD = "offset BIGINT, value STRING"


def read_log_topic(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                   stream: bool = False, max_files_per_trigger: int | None = None,
                   records: bool = False) -> DataFrame:
    """The log topic as ``(offset BIGINT, value STRING)``.

    Kafka: the record offset is the arrival order.  Files: ``records=True`` reads JSON
    records that carry their own ``offset`` (what a topic dump looks like); plain text
    files get the file/line order on a batch read and no offset on a stream (Spark
    gives streams no row ids), so per-visitor ties then fall back to arrival in the batch.
    """
    reader = spark.readStream if stream else spark.read
    if kafka:
        df = reader.format("kafka").options(**kafka).load()
        return df.select(F.col("offset"), F.col("value").cast("string").alias("value"))
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if records:
        return reader.schema(TOPIC_RECORD).json(path)
    df = reader.format("text").load(path)
    if stream:
        return df.select(F.lit(None).cast("bigint").alias("offset"), "value")
    return df.select(F.monotonically_increasing_id().alias("offset"), "value")


def read_json_topic(spark: SparkSession, path: str, schema, stream: bool = False) -> DataFrame:
    """A topic of JSON records with a known schema (for example a DWD fact topic)."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).json(path)
