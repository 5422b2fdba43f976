"""Sharding by a k-d tree over the documents' metadata, as DataFrame operations.

Documents of equal text are one unit (a unit of more bytes than a leaf may hold is divided).  The
root holds all units; a node of more than the target bytes is split at the weighted median along
its widest dimension until the tree has its leaves.  Medians come from histograms that all
executors add up: a first one over the dimension, a second one inside the bin of the median over a
hash of the text, which also parts units that tie.  Only the split points (one row a node) come to
the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import cut, digest

BINS = 65_536
SLOT_GROUPS = 4_096
LAW = "bytes"


def _with_ordinal(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Adds ``name``: the bytes of all rows whose (whole) string comes before the row's own.

    The distinct strings are dealt by ranges and summed up range by range, so no task sees more than one
    range; the ranges' own sums are a row a partition.
    """
    sums = rows.groupBy(column).agg(F.sum("size").alias("bytes"))
    sums = cut(sums.repartitionByRange(column).withColumn("range", F.spark_partition_id()), f"shard-{column}")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.groupBy("range").agg(F.sum("bytes").alias("all")).select("range", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("range").orderBy(column).rowsBetween(Window.unboundedPreceding, -1)
    own = sums.withColumn("own", F.coalesce(F.sum("bytes").over(within), F.lit(0))).join(ranges, "range")
    return rows.join(own.select(column, (F.col("first") + F.col("own")).cast("double").alias(name)), column)


DIMENSIONS = ("d_size", "d_chars", "d_source", "d_lang", "d_id")


def _units(rows: DataFrame, leaf_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their unit's keys, and the units with bytes and dimensions."""
    groups = rows.groupBy("d1", "d2").agg(F.sum("size").alias("all_bytes"))
    parts = F.ceil(F.col("all_bytes") / F.lit(leaf_bytes)).cast("int")
    large = groups.where(parts > 1).select("d1", "d2", parts.alias("parts"))
    rows = rows.join(large, ["d1", "d2"], "left").withColumn(
        "part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))).drop("parts")
    units = rows.groupBy("d1", "d2", "part").agg(
        F.sum("size").alias("bytes"), F.log2(F.max("size").cast("double")).alias("d_size"),
        F.log2(F.min(F.coalesce("chars", F.lit(0))).cast("double") + 1).alias("d_chars"),
        F.min("o_source").alias("d_source"), F.min("o_lang").alias("d_lang"),
        F.min(F.coalesce(F.col("doc_id"), F.lit(0)).cast("double")).alias("d_id"))
    place = F.pmod(F.xxhash64("d1", "d2", "part"), F.lit(BINS)).cast("int")
    return rows, units.withColumn("place", place)


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document; law ``bytes``.

    ``size`` is the text's UTF-8 bytes (a null text: none) plus 1.  Shard sizes are near equal: each
    split halves the bytes of its node up to one unit.  ``slot`` numbers a shard's rows from 0
    without gaps, in the order of a hash of doc_id (then doc_id, size, checksum).  Equal texts share
    a shard, unless their bytes exceed a shard's share.  ``docs`` needs doc_id and text; source, lang
    and n_chars are used as dimensions where present; other columns are left out.  An empty table
    gives no rows; null ids and values count as 0 or empty.
    """
    depth = (shards - 1).bit_length()
    if 1 << depth != shards:
        raise ValueError("shards must be a power of two")
    has = lambda c, kind: F.col(c).cast(kind) if c in docs.columns else F.lit(None).cast(kind)
    raw = F.encode(F.col("text"), "utf-8")
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                           F.crc32(F.coalesce(raw, F.encode(F.lit(""), "utf-8"))).alias("text_crc32"),
                           *digest(F.coalesce(F.col("text"), F.lit(""))),
                           F.coalesce(has("source", "string"), F.lit("")).alias("source"),
                           F.coalesce(has("lang", "string"), F.lit("")).alias("lang"),
                           has("n_chars", "long").alias("chars")), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0]
    if total is None:
        return _numbered(rows.withColumn("shard", F.lit(0)))
    rows = _with_ordinal(_with_ordinal(rows, "source", "o_source"), "lang", "o_lang")
    rows, units = _units(rows, max(1, total // shards))
    units = cut(units.withColumn("node", F.lit(1)), "shard-units")
    whole = units.agg(*(F.min(d).alias(f"{d}_low") for d in DIMENSIONS), *(F.max(d).alias(f"{d}_high") for d in DIMENSIONS)).first()
    splits: dict[int, tuple] = {}
    for _ in range(depth):
        placed = units.withColumn("node", _descend(splits))
        wide = {r.node: r for r in placed.groupBy("node").agg(
            *(F.min(d).alias(f"{d}_low") for d in DIMENSIONS), *(F.max(d).alias(f"{d}_high") for d in DIMENSIONS)).collect()}
        chosen = {}
        for node, r in wide.items():  # one row a node
            spread = lambda d: (r[f"{d}_high"] - r[f"{d}_low"]) / ((whole[f"{d}_high"] - whole[f"{d}_low"]) or 1)  # noqa: E731, B023
            d = max(DIMENSIONS, key=spread)
            chosen[node] = (d, r[f"{d}_low"], r[f"{d}_high"])
        bins = placed.withColumn("bin", _by_node(chosen, lambda d, low, high: _bin(d, low, high)))
        first = _medians(bins.groupBy("node", "bin").agg(F.sum("bytes").alias("bytes")), "bin", {})
        at = {n: f[0] for n, f in first.items()}
        inside = bins.where(F.col("bin") == _by_node({n: (b,) for n, b in at.items()}, lambda b: F.lit(b)))
        second = _medians(inside.groupBy("node", "place").agg(F.sum("bytes").alias("bytes")), "place",
                          {n: f[1] for n, f in first.items()})
        for node, (d, low, high) in chosen.items():
            splits[node] = (d, low, high, at[node], second[node][0])
    leaf = units.select("d1", "d2", "part", (_descend(splits) - F.lit(shards)).alias("shard"))
    return _numbered(rows.join(leaf, ["d1", "d2", "part"]))


def _bin(dimension: str, low: float, high: float) -> Column:
    """The bin of a value between a node's bounds."""
    if high <= low:
        return F.lit(0)
    return F.least(F.floor((F.col(dimension) - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1)).cast("int")


def _by_node(of: dict, expression) -> Column:
    out = F.lit(None)
    for node, arguments in of.items():
        out = F.when(F.col("node") == node, expression(*arguments)).otherwise(out)
    return out


def _descend(splits: dict[int, tuple]) -> Column:
    """The node that a unit reaches: children of n are 2n and 2n + 1.  A tree of a few nodes, as one expression."""

    def walk(node: int) -> Column:
        if node not in splits:
            return F.lit(node)
        d, low, high, at, place = splits[node]
        b = _bin(d, low, high)
        left = (b < at) | ((b == at) & (F.col("place") <= place))
        return F.when(left, walk(2 * node)).otherwise(walk(2 * node + 1))

    return walk(1)


def _medians(histogram: DataFrame, by: str, before: dict[int, tuple[float, float]]) -> dict[int, tuple]:
    """Per node the bin where the running sum of bytes passes half, and what the next histogram starts from.

    ``before``: per node (the bytes left of this histogram, half of the node's bytes).  A histogram has
    ``BINS`` rows a node at most.
    """
    node = Window.partitionBy("node")
    run = histogram.withColumn("upto", F.sum("bytes").over(node.orderBy(by))).withColumn("all", F.sum("bytes").over(node))
    left = _by_node(before, lambda a, h: F.lit(float(a))) if before else F.lit(0.0)
    half = _by_node(before, lambda a, h: F.lit(float(h))) if before else F.col("all") / 2
    # the side of the median that leaves the halves nearer to each other
    if before:
        gap = F.abs(left + F.col("upto") - half)
        best = run.groupBy("node").agg(F.min_by(by, F.struct(gap, F.col(by))).alias("at")).collect()
        return {r.node: (r.at, None) for r in best}
    run = run.withColumn("half", half).where(F.col("upto") >= F.col("half"))
    best = run.groupBy("node").agg(F.min(F.struct(by, (F.col("upto") - F.col("bytes")).alias("below"), "half")).alias("m")).collect()
    return {r.node: (r.m[by], (r.m["below"], r.m["half"])) for r in best}


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds slots: counted in ``SLOT_GROUPS`` hash groups a shard, so that no shard is sorted in one task."""
    rows = rows.withColumn("group", F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_GROUPS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "group").agg(F.count("*").alias("n")).select(
        "shard", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "group").orderBy("doc_id", "size", "text_crc32", "d1", "d2")
    return (rows.withColumn("own", F.row_number().over(within) - 1).join(counts, ["shard", "group"])
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("own") + F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
