"""Change-event and routing-rule sources (S2, S3, S5 and the rule table of T11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.operators import cdc
from tributary.schemas import ROUTING_RULE

RULE_ROW = T.StructType([T.StructField("rule_seq", T.LongType())] + ROUTING_RULE.fields)

# Routing configuration used with the provided tables (fixed values; FIXTURES.md §2).
# The ' name' of the third rule keeps its blank on purpose: it never matches a column.
STATIC_RULES = [
    (0, "user_info", "insert", "hbase", "dim_user_info", "id,name,segment", None, None),
    (0, "user_info", "update", "hbase", "dim_user_info", "id,segment", None, None),
    (0, "order_info", "insert", "kafka", "dwd_order_info", "id, name", None, None),
]

# A rule table that changes while changes flow (versions take effect after their seq):
# the update rule arrives late, the insert rule is changed twice, one rule is deleted
# (an all-NULL row that is ignored) and one rule names an unsupported sink type.
RULE_CHANGE_LOG = [
    (0, "user_info", "insert", "hbase", "dim_user_info", "id,name,segment", None, None),
    (0, "order_info", "insert", "kafka", "dwd_order_info", "id, name", None, None),
    (0, "user_info", "read", "clickhouse", "ck_user_info", "id", None, None),
    (1500, "user_info", "update", "hbase", "dim_user_info", "id,segment", None, None),
    (3000, "user_info", "insert", "hbase", "dim_user_info", "id,name", None, None),
    (4000, None, None, None, None, None, None, None),
    (20000, "order_info", "insert", "kafka", "dwd_order_info", "id,name,segment", "id", None),
]


def routing_rules(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The routing table as rule rows (``rule_seq`` + the seven rule fields)."""
    return spark.createDataFrame(rows if rows is not None else STATIC_RULES, RULE_ROW)


def rule_change_log(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """Rule-table change history; NULL-key rows (deletes) are dropped as in ``rules_from_changes``."""
    df = spark.createDataFrame(rows if rows is not None else RULE_CHANGE_LOG, RULE_ROW)
    return df.filter(F.col("sourceTable").isNotNull() & F.col("operateType").isNotNull())


def rule_events(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rule rows as the change events of the rule table that a change topic carries."""
    r = spark.createDataFrame(rows, RULE_ROW)
    after = F.create_map(*[c for f in cdc.RULE_FIELDS for c in (F.lit(f), F.col(f))])
    none = F.create_map().cast("map<string,string>")
    return cdc.envelope_json(r.select(
        F.col("rule_seq").alias("offset"), F.lit("config").alias("database"),
        F.lit("table_process").alias("tableName"), none.alias("before"), after.alias("after"),
        F.lit("insert").alias("type")))


def read_rule_changes(spark: SparkSession, path: str) -> DataFrame:
    """Rule rows from the change topic of the rule table (records that carry their offset, which
    orders the rules).  Records that are no change events are dropped."""
    return cdc.rules_from_changes(cdc.parse_changes(read_change_topic(spark, path), on_bad="drop"))


def read_change_topic(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                      stream: bool = False, records: bool = True) -> DataFrame:
    """Change topic as ``(offset, value)``: a Kafka topic or a folder of files.

    The offset is the change order that the partial-column upsert relies on, so file
    topics default to JSON records that carry it (``records=True``).
    """
    from tributary.sources.logs import read_log_topic
    return read_log_topic(spark, path=path, kafka=kafka, stream=stream, records=records)
