"""Dimension lookup joins (the async point-lookup of the original, as a join).

The original looked each fact row up in a key-value store through a cache and a thread pool.
Here the dimension is one side of an equi-join.  Which join it becomes is Spark's choice: its
byte-based broadcast threshold at planning, and adaptive execution by the sizes it measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, dim: DataFrame, key: Column | str, columns: dict[str, str],
           dim_key: str = "id", missing: str = "keep", overwrite: tuple[str, ...] = ()) -> DataFrame:
    """Enrich ``facts`` with ``columns`` (``{dim column: output column}``) of ``dim``.

    ``key`` is compared as text with ``dim_key`` (dimension tables are all-text).
    ``missing="keep"`` (default) keeps facts without a dimension row with NULL
    attributes; ``missing="drop"`` drops them, which is what the original observably did
    (its lookup threw and the record never completed).  Output columns listed in
    ``overwrite`` replace a same-named fact column, keeping the fact's value when the
    dimension has none.
    """
    k = F.col(key) if isinstance(key, str) else key
    tmp = {dst: f"__dim_{dst}" for dst in columns.values()}
    d = dim.select(F.col(dim_key).alias("__dim_key"),
                   *[F.col(src).alias(tmp[dst]) for src, dst in columns.items()])
    how = {"keep": "left", "drop": "inner"}[missing]
    j = facts.join(d, k.cast("string") == F.col("__dim_key"), how)
    added = []
    for dst, t in tmp.items():
        if dst in overwrite and dst in facts.columns:
            added.append(F.coalesce(F.col(t), F.col(dst)).alias(dst))
        else:
            added.append(F.col(t).alias(dst))
    keep = [F.col(c) for c in facts.columns if c not in tmp]
    return j.select(*keep, *added)


def skus_with_spu(dims: dict[str, DataFrame], columns: tuple[str, ...], missing: str = "keep") -> DataFrame:
    """``id``, ``columns`` of the sku dimension (its ids as numbers) and ``spu_name``: the spu is looked up for the
    skus and not for the facts, which saves one shuffle of the facts."""
    ids = ("category3_id", "spu_id", "tm_id")
    sku = dims["dim_sku_info"].select("id", *(F.col(c).try_cast("bigint").alias(c) if c in ids else c for c in columns))
    return lookup(sku, dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"}, missing=missing)
