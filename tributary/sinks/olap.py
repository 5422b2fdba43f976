"""OLAP statistics sink (K5): positional insert in the declared column order.

The original inserted each bean's non-transient fields in declaration order, five rows
per JDBC batch.  Here a micro-batch is written whole, in the fixed column order, either
to a parquet table whose ledger names the batches that count (exactly once, ``sinks.ledger``) or
through JDBC with a configurable batch size.  The JDBC table appends: a batch that runs again after a failure
appends its rows again, and a table engine that replaces rows of equal keys has to drop them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.schemas import (KEYWORD_STATS_COLUMNS, PRODUCT_STATS_COLUMNS,
                               PROVINCE_STATS_COLUMNS, VISITOR_STATS_COLUMNS)
from tributary.sinks.ledger import Fault, Ledger, ledgered

TABLE_COLUMNS = {
    "visitor_stats": VISITOR_STATS_COLUMNS,
    "product_stats": PRODUCT_STATS_COLUMNS,
    "province_stats": PROVINCE_STATS_COLUMNS,
    "keyword_stats": KEYWORD_STATS_COLUMNS,
}


def sink_columns(df: DataFrame, table: str) -> DataFrame:
    """The rows in the table's declared column order (missing columns are an error)."""
    cols = TABLE_COLUMNS[table]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return df.select(*cols)


def olap_rows_writer(table: str):
    """A writer of one attempt of a micro-batch of ``table``, for a ledgered job (``sinks.ledger``)."""
    return lambda batch, _id, folder: sink_columns(batch, table).write.mode("overwrite").parquet(folder("rows"))


def olap_batch_writer(spark: SparkSession, table: str, path: str | None = None, jdbc: dict | None = None,
                      batch_size: int = 1000, fault: Fault | None = None):
    """A ``foreachBatch`` handler writing one micro-batch of ``table``."""
    if jdbc:
        def append(batch: DataFrame, batch_id: int) -> None:
            (sink_columns(batch, table).write.format("jdbc").options(**jdbc).option("dbtable", table)
                .option("batchsize", batch_size).mode("append").save())
        return append
    return ledgered(spark, path, olap_rows_writer(table), fault)


def read_olap(spark: SparkSession, table: str, path: str, schema) -> DataFrame:
    """The committed rows of a parquet statistics table, in the declared column order."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return Ledger(spark, path).read("rows", ddl).select(*TABLE_COLUMNS[table])
