"""Dimension tables (S6): all-text columns, one row per primary key.

The original fetched ``select * from <table> where id = '<id>'`` per record through a
cache; here the dimension is a DataFrame joined to the facts (see operators.lookup).
Column names stay snake_case (the original's camel-case renaming is not needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dimension(spark: SparkSession, path: str, fmt: str = "parquet",
                   options: dict | None = None) -> DataFrame:
    """A dimension table from files (``parquet``/``json``/``csv``) or ``jdbc`` (options), every column as text."""
    reader = spark.read.format(fmt).options(**(options or {}))
    rows = reader.load(path) if fmt != "jdbc" else reader.load()
    return rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
