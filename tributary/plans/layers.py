"""Layer tables: write an intermediate layer once, read it back everywhere.

The original pipeline is a chain of jobs joined by topics (ODS -> DWD -> DWM -> DWS);
every topic is computed once and read by several jobs.  In one Spark plan the same
layer would instead be recomputed by each consumer (exchange reuse cannot merge
consumers that shuffle on different keys), so we cut the plan where a layer fans out:
the layer is written as parquet under the shared ``spark.checkpoint.dir`` and read
back.  This also cuts lineage, so losing an executor never re-runs the parse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tributary.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint root and return a reader."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    path = scratch_path(spark, "layers", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
