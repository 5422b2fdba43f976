"""Document fingerprints: MinHash signatures by universal hash permutations, in vectorised numpy.

A fingerprint holds ``COORDINATES`` values of 16 bits; the share of equal coordinates estimates the
Jaccard similarity of two documents' word shingles.  ``near_links`` joins fingerprints on bands in
Spark and verifies the Jaccard similarity on the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WordHashes, cut, local_roots, map_runs, ngram_hashes
from tributary.llm.components import components

COORDINATES = 64
BANDS, ROWS = 16, 4
SHINGLE_WORDS = 5
THRESHOLD = (4, 5)
SLICE = 2_048
BLOCK = 128
SEED = 11


def _permutations(n: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """Universal hash functions x -> (a x + b) mod 2**64, high bits taken, a odd."""
    r = np.random.default_rng(SEED)
    return r.integers(0, 2**64, n, np.uint64) | np.uint64(1), r.integers(0, 2**64, n, np.uint64)


def minhash(shingles: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the least permuted shingle for every permutation; all ones without shingles."""
    low = np.full(len(by[0]), 2**64 - 1, np.uint64)
    for lo in range(0, len(shingles), SLICE):
        x = by[0][:, None] * shingles[None, lo: lo + SLICE]
        x += by[1][:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return ((low >> np.uint64(24)) & np.uint64(0xFFFF)).astype(">u2")


class Fingerprinter:
    """Fingerprints of whole texts (words between ASCII white space, as they are written)."""

    def __init__(self):
        self.hashes, self.by = WordHashes(), _permutations()

    def shingles(self, text: str) -> np.ndarray:
        return ngram_hashes(self.hashes.array(text.encode("utf-8").split()), SHINGLE_WORDS)

    def __call__(self, text: str) -> np.ndarray:
        return minhash(self.shingles(text), self.by)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): hex of the fingerprint of every whole text.  A null text is an empty one;
    texts without words share one fingerprint.  Repeated rows come back as they are; extra columns go."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fingerprinter()
        for batch in batches:
            marks = [own(t.as_py() or "").tobytes().hex() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(task, "doc_id long, fingerprint string")


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    return float((left == right).mean())


# ---- fingerprints of edited texts -------------------------------------------------------------

EDITED = ("part int, place int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, text string")


def edit(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(own, doc_id, text, mark, following, next_mark):
    import hashlib

    new = edit(text, following)
    new_mark = own(new)
    return (doc_id, len(text), hashlib.sha256(new.encode("utf-8")).hexdigest(), mark.tobytes().hex(),
            new_mark.tobytes().hex(), likeness(mark, new_mark), likeness(mark, next_mark))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and likenesses (the query's contract).

    The next document is the one of the next smaller doc_id (after the last: the first); rows of one
    doc_id follow in the order of their text's hash, a null id comes last, a null text is empty.  One range shuffle
    puts the documents in order; each task then walks its range.  The last row of a range needs the
    first text of the next range that has one: only those rows (one a range) are exchanged again.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ranged = rows.withColumn("tie", tie).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("tie")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        own, part, before, out = Fingerprinter(), TaskContext.get().partitionId(), None, []
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in EDITED.split(", ")])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    mark = own(text)
                    if before is None:
                        out.append((part, 0, doc_id, None, None, None, None, None, None, text))  # for the range before
                    else:
                        out.append((None, None, *_row(own, before[0], before[1], before[2], text, mark), None))
                    before = (doc_id, text, mark)
                if out:
                    yield batch_of(out)
                    out = []
        if before is not None:
            yield batch_of([(part, 1, before[0], None, None, None, None, None, None, before[1])])

    walked = cut(ranged.mapInArrow(walk, EDITED), "edited")
    done = walked.where("place is null").drop("part", "place", "text")
    # the ends of the ranges: at most two rows a range; each last row meets the first row of the next range in use
    starts = walked.where("place = 0").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    used = sorted(r[0] for r in starts.select("next_part").collect())  # one number a range
    after = spark.createDataFrame([(p, used[(i + 1) % len(used)]) for i, p in enumerate(used)], "part int, next_part int")
    ends = walked.where("place = 1").select("part", "doc_id", "text").join(after, "part").join(starts, "next_part")

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Fingerprinter()
        for batch in batches:
            rows = [_row(own, d, t, own(t), f, own(f)) for d, t, f in zip(batch["doc_id"], batch["text"], batch["following"])]
            out = pd.DataFrame(rows, columns=CLOSED)
            out["doc_id"] = [None if pd.isna(d) else int(d) for d in out["doc_id"]]
            yield out.astype({"doc_id": "Int64"})

    kinds = ", ".join(x for x in EDITED.split(", ") if x.split()[0] in CLOSED)
    return done.unionByName(ends.select("doc_id", "text", "following").mapInPandas(close, kinds))


CLOSED = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


# ---- near documents by bands ------------------------------------------------------------------

def near_links(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every document that has words: documents that hang together by links of a
    Jaccard similarity of ``threshold`` or more on their word shingles.  class_id is the smallest doc_id.

    Equal fingerprints are one member of the join.  Members of a band become stars, those that hang
    together are compared on their full shingles in blocks, and only spanning links leave a task.
    """
    marks = cut(fingerprints(docs, key, text).where("doc_id is not null").join(
        docs.where(F.size(F.split(F.trim(F.col(text)), r"\s+")) > 0).select(F.col(key).cast("long").alias("doc_id")).distinct(),
        "doc_id", "left_semi"), "fingerprints")
    same = marks.groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    width = 4 * ROWS
    bands = F.expr(f"transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(fingerprint, {width} * i + 1, {width})))")
    posted = same.select("node", F.explode(bands).alias("band"))
    hubs = posted.groupBy("band").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    stars = posted.join(hubs, "band").select(F.col("node").alias("a"), "b").where("a <> b").unionAll(
        marks.join(same, "fingerprint").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))).distinct()
    group = cut(components(stars).withColumnRenamed("component", "group"), "bands")
    sizes = group.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    from tributary.llm.near import block_pairs, intersections

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fingerprinter()
        for batch in batches:
            made = [np.unique(own.shingles(t.as_py() or "")).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())], names=["node", "group", "n", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(group.join(sizes, "group").hint("merge"), "node")
    made = rows.select("node", "group", "n", "text").mapInArrow(sets, "node long, group long, n long, shingles binary")
    over, under = threshold

    def verify(run: dict[str, np.ndarray]) -> pd.DataFrame | None:
        if len(run["node"]) < 2:
            return None
        own = [np.frombuffer(s, np.uint64) for s in run["shingles"]]
        size = np.array([len(s) for s in own], float)
        both = intersections(own)
        ok = (both > 0) & (under * both >= over * (size[:, None] + size[None, :] - both))
        root = local_roots(len(own), *np.nonzero(np.triu(ok, 1)))
        at = np.flatnonzero(root != np.arange(len(own)))
        return pd.DataFrame({"a": run["node"][at], "b": run["node"][root[at]]})

    blocked = block_pairs(made, F.col("n"), BLOCK, F.col("node"))
    found = components(map_runs(blocked.select("group", "left", "right", "node", "shingles"), ["group", "left", "right"],
                                verify, "a long, b long"))
    return marks.select("doc_id").distinct().join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("class_id"))
