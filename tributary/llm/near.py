"""MinHash near-duplicates by a signature-coordinate inverted join.

Every document gets a MinHash signature over its word shingles; documents of equal shingle sets are
one class.  A class is posted under the (coordinate, value) pairs of its signature; two classes
collide as often as their signatures agree, and those that agree at ``matches_needed`` coordinates or more
are candidates.  Prefix: a pair with that many collisions shares one of the first
``COORDINATES - matches + 1`` postings of both, in any common order; here the rarest come first, so
widespread values are hardly ever joined on.  Skip: within a posting list a pair already known to
hang together is passed over.  Candidates that hang together are then compared on their full
shingle sets, in blocks: all intersections of a block come from one sparse matrix product, and only
a spanning set of the links found leaves the task.  A group of n members in blocks of b costs n * n / b rows of
sets or signatures on the way in, since every pair of blocks meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import WordHashes, cut, local_roots, map_runs, mix, ngram_hashes
from tributary.llm.components import components

COORDINATES = 32
MISSED = 5e-5  # of pairs just at the threshold, at most
LIST_BLOCK = 512  # members of a posting list that are compared at once
SET_BLOCK = 128  # full shingle sets that are compared at once
SHINGLE_WORDS = 5
THRESHOLD = (4, 5)  # similarity as a fraction
SLICE = 2_048  # shingles hashed, or columns multiplied, at once


def matches_needed(threshold: tuple[int, int]) -> int:
    """The most coordinates that may be asked to agree so that a pair at the threshold is missed by ``MISSED`` at most."""
    t, missed, m = threshold[0] / threshold[1], 0.0, 0
    while True:
        missed += comb(COORDINATES, m) * t**m * (1 - t) ** (COORDINATES - m)
        if missed > MISSED:
            return m
        m += 1


def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add-shift hash functions (odd multipliers)."""
    r = np.random.default_rng(seed)
    return (r.integers(0, 2**64, n, np.uint64) | np.uint64(1)), r.integers(0, 2**64, n, np.uint64)


def signature(shingles: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each permutation over the shingles (the high halves, as unsigned 32 bit)."""
    low = np.full(len(by[0]), 2**64 - 1, np.uint64)
    for lo in range(0, len(shingles), SLICE):
        x = shingles[None, lo: lo + SLICE] * by[0][:, None]
        x += by[1][:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def shingle_set(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a whole text's word shingles, A-Z in lower case."""
    return np.unique(ngram_hashes(hashes.array(text.encode("utf-8").lower().split()), words))


def signatures(docs: DataFrame, key: str, text: str, shingle_words: int) -> DataFrame:
    """(doc_id, n_shingles, c1, c2, sig): c1 and c2 name the shingle set (null for an empty one)."""
    by = permutations(COORDINATES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            size, c1, c2, sig = [], [], [], []
            for t in batch.column(1):
                own = shingle_set(t.as_py() or "", shingle_words, hashes)
                size.append(len(own))
                name = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
                c1.append(int.from_bytes(name[:8], "little", signed=True) if name else None)
                c2.append(int.from_bytes(name[8:], "little", signed=True) if name else None)
                sig.append(signature(own, by).tobytes() if name else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                 pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "c1", "c2", "sig"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(
        task, "doc_id long, n_shingles long, c1 long, c2 long, sig binary")


def _postings(classes: DataFrame, needed: int) -> DataFrame:
    """(token, df, node, sig): every class under the shared postings of its prefix, rarest first."""
    word = F.expr(f"transform(sequence(0, {COORDINATES - 1}), i -> xxhash64(i, substring(sig, 4 * i + 1, 4)))")
    tokens = classes.select("node", F.explode(word).alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"))
    # the postings that nobody shares come first in a prefix; what is left of it is joined on
    room = F.lit(COORDINATES - needed + 1) - (F.lit(COORDINATES) - F.size("held"))
    prefix = held.where(room > 0).select("node", F.explode(F.slice("held", F.lit(1), room)).alias("x"))
    lists = prefix.select("node", F.col("x.token").alias("token"))
    sizes = lists.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    return lists.join(sizes, "token").join(classes.select("node", "sig"), "node")


def block_pairs(rows: DataFrame, size: Column, block: int, member: Column) -> DataFrame:
    """Adds (left, right, side): a group of many members is dealt into blocks, and every member goes to
    each pair of blocks that has its own.  A group of one block has the pair (0, 0)."""
    n = F.ceil(size / F.lit(block)).cast("int")
    rows = rows.withColumn("blocks", n).withColumn("own", F.pmod(F.xxhash64(F.lit(5), member), n).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (rows.select("*", other).withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other"))
            .drop("blocks", "other"))


def _spanning(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame | None:
    """Links among members as stars of the smallest index: at most one row a member."""
    if not len(left):
        return None
    root = local_roots(len(nodes), left, right)
    at = np.flatnonzero(root != np.arange(len(nodes)))
    return pd.DataFrame({"a": nodes[at], "b": nodes[root[at]]})


def _collide(needed: int):
    def each(run: dict[str, np.ndarray]) -> pd.DataFrame | None:
        nodes = run["node"]
        if len(nodes) < 2:
            return None
        sig = np.frombuffer(b"".join(run["sig"]), np.uint32).reshape(len(nodes), -1)
        matches = np.zeros((len(nodes), len(nodes)), np.uint8)
        for c in range(sig.shape[1]):
            matches += sig[:, c, None] == sig[None, :, c]
        return _spanning(nodes, *np.nonzero(np.triu(matches >= needed, 1)))

    return each


def _candidates(classes: DataFrame, needed: int) -> DataFrame:
    rows = block_pairs(_postings(classes, needed), F.col("df"), LIST_BLOCK, F.col("node"))
    # a posting list of one block is hashed by its token alone; longer ones by their pair of blocks too
    return map_runs(rows.select("token", "left", "right", "node", "sig"), ["token", "left", "right"], _collide(needed), "a long, b long")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: product of the incidence matrix with its transpose, in slices of columns."""
    n = len(sets)
    out = np.zeros((n, n), np.float64)
    values, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = times[which] > 1
    column = (np.cumsum(times > 1) - 1)[which[shared]]
    row = row[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for lo in range(0, int((times > 1).sum()), SLICE):
        i, j = np.searchsorted(column, [lo, lo + SLICE])
        part = np.zeros((n, SLICE), np.float32)
        part[row[i:j], column[i:j] - lo] = 1
        out += part @ part.T
    return out


def _verify(fraction: tuple[int, int]):
    over, under = fraction

    def each(run: dict[str, np.ndarray]) -> pd.DataFrame | None:
        nodes = run["node"]
        if len(nodes) < 2:
            return None
        sets = [np.frombuffer(s, np.uint64) for s in run["shingles"]]
        size = np.array([len(s) for s in sets], np.float64)
        both = intersections(sets)
        linked = under * both >= over * (size[:, None] + size[None, :] - both)
        return _spanning(nodes, *np.nonzero(np.triu(linked, 1)))

    return each


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle_words: int) -> DataFrame:
    """(node, group, n, shingles) of the candidates, from their whole texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [shingle_set(t.as_py() or "", shingle_words, hashes).tobytes() for t in part.column(3)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(sets, pa.binary())],
                                                 names=["node", "group", "n", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).join(wanted.hint("merge"), "node")
    return rows.select("node", "group", "n", "text").mapInArrow(task, "node long, group long, n long, shingles binary")


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
                    threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: documents whose shingle sets have a
    Jaccard similarity of ``threshold`` or more are linked; component_id is the smallest doc_id that
    can be reached, and the document of that id is kept.

    A text with fewer words than a shingle is one shingle.  A null or empty text, or one without
    words, has no shingles and is its own component.  Rows of one doc_id are one document to link
    with (each row is returned); a null doc_id gets the component of its set if others have
    the same, else null, and is kept only in the latter case.  Extra columns are left out.
    """
    sigs = cut(signatures(docs, key, text, shingle_words), "signatures")
    classes = sigs.where("c1 is not null and doc_id is not null").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig"))
    classes = cut(classes, "classes")
    links = _candidates(classes.select("node", "sig"), matches_needed(threshold))
    group = components(links).withColumnRenamed("component", "group")
    group = cut(group, "groups")
    sizes = group.groupBy("group").agg(F.count("*").alias("n"))
    sets = _sets(docs, group.join(sizes, "group"), key, text, shingle_words)
    blocked = block_pairs(sets, F.col("n"), SET_BLOCK, F.col("node"))
    verified = map_runs(blocked.select("group", "left", "right", "node", "shingles"), ["group", "left", "right"],
                        _verify(threshold), "a long, b long")
    found = components(verified)
    named = classes.select("c1", "c2", "node").join(found, "node", "left").select(
        "c1", "c2", F.coalesce("component", "node").alias("component_id"))
    out = sigs.select("doc_id", "n_shingles", "c1", "c2").join(named, ["c1", "c2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
