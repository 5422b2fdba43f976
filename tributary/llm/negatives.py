"""Hard-negative mining by anchor-clustered shared lists.

Anchors are clustered by direction.  For a cluster with centroid c whose members lie within an angle r of it, a
candidate at angle t to c has an inner product of at most ``|member| |candidate| cos(max(0, t - r))`` with any
member.  So the candidates are sorted by ``|candidate| cos(max(0, t - r))`` once a cluster, and every member walks that
list until its bound certifies that nothing further on can enter its result.  Scores are exact:
components are whole numbers, and where sums may pass 2**53 they are added up as 64-bit integers.

Candidates lie in blocks of bounded size (those of one direction together), cluster by cluster of at most some
hundred anchors passes over each block, and the results of the blocks are merged by a window per
anchor.  The search runs twice: for the positives (same label), then, with their scores known, for the
negatives (another label, score within a band of the positive's).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm.common import cut

SCALE = 256
FIT_ANCHORS = 4096  # anchors, drawn by a hash, that the centroids are fitted on
CENTROIDS = 64  # at most; one for every 64 of the anchors fitted on
ROUNDS = 6
BLOCK = 65_536  # candidates of a block
CHUNK = 256  # anchors of a shared list
STEP = 1024  # candidates of a list that are scored at once
EXACT, WIDEST = 2.0**53, 2.0**63  # sums of doubles below the first, of 64-bit integers below the second, are exact
NO_ID = 2**63 - 1  # stands for a null vec_id, behind all others

ROW = "place long, vec_id long, label long, anchor boolean, vector binary"
HIT = "place long, walker int, other_id long, other_place long, score long"


def _arrow(columns: list, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def prepared(rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(place, vec_id, label, anchor, vector) of the rows that take part; ``place`` tells rows apart.

    Rows with a null label, a null vector, or a null or non-finite component are left out.  A component x
    becomes floor(``SCALE`` * x); the vector is kept as the bytes of doubles.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for vec_id, lab, anchor, vec in zip(*(c.to_pylist() for c in batch.columns)):
                if any(x is None for x in vec):
                    continue
                with np.errstate(over="ignore"):
                    q = np.floor(SCALE * np.array(vec, np.float64))
                if np.isfinite(q).all():
                    out.append((place, vec_id, lab, anchor, q.tobytes()))
                    place += 1
            if out:
                yield _arrow(list(zip(*out)), ROW)

    own = rows.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("k"), F.col(label).cast("long").alias("l"),
                      F.coalesce(anchors, F.lit(False)).alias("a"), F.col(vector).cast("array<double>").alias("v"))
    return own.where("l is not null and v is not null").mapInArrow(task, ROW)


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows; one that is shorter than the longest counts as filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        x = np.frombuffer(v, np.float64)
        row[: len(x)] = x
    return out


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(axis=1))


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(_norms(m), 1e-300)[:, None]


def centroids(table: DataFrame, width: int) -> np.ndarray:
    """Directions of anchors by spherical k-means, fitted on at most ``FIT_ANCHORS`` anchors."""
    drawn = table.where("anchor").select("vector").orderBy(F.xxhash64("place"), "place").limit(FIT_ANCHORS).collect()
    sample = _unit(_matrix([bytes(r[0]) for r in drawn], width))
    own = sample[: max(1, min(CENTROIDS, len(sample) // 64))]
    for _ in range(ROUNDS):
        nearest = (sample @ own.T).argmax(axis=1)
        sums = np.zeros_like(own)
        np.add.at(sums, nearest, sample)
        own = np.where(_norms(sums)[:, None] > 0, _unit(sums), own)
    return own


def clustered(table: DataFrame, own: np.ndarray) -> DataFrame:
    """Adds ``cluster``, the centroid nearest in direction."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(4).to_pylist(), own.shape[1])
            nearest = (_unit(vectors) @ own.T).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=[*batch.schema.names, "cluster"])

    return table.mapInArrow(task, ROW + ", cluster int")


def _dealt(table: DataFrame, size: int, counts: dict[int, int], name: str) -> tuple[DataFrame, int]:
    """Adds a group number: the rows of every cluster in groups of about ``size``, by a hash."""
    first, groups, total = [], [], 0
    for c in range(max(counts, default=-1) + 1):
        first.append(total)
        groups.append(max(1, -(-counts.get(c, 0) // size)))
        total += groups[-1]
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return table.withColumn(name, (at(first) + F.pmod(F.xxhash64(F.lit(name), "place"), at(groups))).cast("int")), total


class SharedList:
    """A block's candidates in the order of their bound for one cluster of anchors."""

    def __init__(self, block: dict, members: np.ndarray):
        centre = _unit(members.sum(axis=0)[None])[0]
        cosine = lambda m: np.clip(_unit(m) @ centre, -1, 1)
        # what rounding may take from an angle is given back to the radius
        radius = np.arccos(cosine(members)).max() + 1e-7
        angle = np.arccos(np.clip(block["units"] @ centre, -1, 1))
        bound = block["norms"] * np.cos(np.maximum(0, angle - radius))
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]


def _wide_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) @ b.astype(np.int64)).astype(np.longdouble)


def walk(block: dict, members: list[dict], same: bool, take: int, width: int) -> list[tuple]:
    """(place, walker, id, place, score) of the best ``take`` candidates of a block for every walker.

    A member has a walker for each pair (low, high) of its ``bands``: scores outside are passed over.  ``same``
    asks for candidates of the member's own label, else of others; a member never meets itself.
    """
    vectors = _matrix([bytes(m["vector"]) for m in members], width)
    norms = _norms(vectors)
    widest = norms.max() * block["norms"].max(initial=0.0)
    if widest >= WIDEST:
        raise ArithmeticError("a score may pass 2**63")
    # an extended double holds any 64-bit integer
    number, product = (np.float64, np.matmul) if widest < EXACT else (np.longdouble, _wide_product)
    shared = SharedList(block, vectors)
    of = np.array([k for k, m in enumerate(members) for _ in m["bands"]])
    walker = np.array([j for m in members for j in range(len(m["bands"]))])
    low = np.array([b["low"] for m in members for b in m["bands"]], np.int64).astype(number)
    high = np.array([b["high"] for m in members for b in m["bands"]], np.int64).astype(number)
    labels = np.array([m["label"] for m in members], np.int64)
    places = np.array([m["place"] for m in members], np.int64)
    n = len(of)
    none = np.full((n, take), -np.inf, number)
    score, ident, where = none, np.full((n, take), NO_ID), np.full((n, take), -1)
    alive = np.arange(n)
    for lo in range(0, len(shared.order), STEP):
        # a walker goes on while the list may hold what beats, or ties with, its last result
        alive = alive[norms[of[alive]] * shared.bound[lo] * (1 + 1e-9) + 1e-6 >= np.maximum(low[alive], score[alive, -1])]
        if not len(alive):
            break
        here = shared.order[lo: lo + STEP]
        needed, back = np.unique(of[alive], return_inverse=True)
        new = product(vectors[needed], block["vectors"][here].T)
        fits = (labels[needed][:, None] == block["labels"][here]) == same
        fits &= places[needed][:, None] != block["places"][here]
        new = np.where(fits, new, -np.inf)[back]
        new[(new < np.maximum(low[alive], score[alive, -1])[:, None]) | (new > high[alive, None])] = -np.inf
        if new.shape[1] > take:  # what falls behind the best of this step itself
            least = np.partition(new, new.shape[1] - take, axis=1)[:, new.shape[1] - take]
            new[new < least[:, None]] = -np.inf
        w, c = np.nonzero(new > -np.inf)
        touched = np.unique(w)
        if not len(touched):
            continue
        t = alive[touched]
        rows = np.concatenate([np.repeat(t, take), alive[w]])
        s = np.concatenate([score[t].ravel(), new[w, c]])
        i = np.concatenate([ident[t].ravel(), block["ids"][here[c]]])
        p = np.concatenate([where[t].ravel(), block["places"][here[c]]])
        by = np.lexsort((p, i, -s, rows))
        rows, s, i, p = rows[by], s[by], i[by], p[by]
        begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        best = (begins[:, None] + np.arange(take)).ravel()  # every walker brings at least ``take`` entries
        score[t], ident[t], where[t] = (x[best].reshape(-1, take) for x in (s, i, p))
    found = score > -np.inf
    w, k = np.nonzero(found)
    return list(zip(places[of[w]].tolist(), walker[w].tolist(), ident[w, k].tolist(), where[w, k].tolist(), score[w, k].astype(np.int64).tolist()))


def _searched(blocks: DataFrame, n_blocks: int, chunks: DataFrame, same: bool, take: int, width: int) -> DataFrame:
    """The best hits of every walker of ``chunks`` in every block.  A task holds one block and one chunk at a time."""
    members = "array<struct<place:bigint,label:bigint,vector:binary,bands:array<struct<low:bigint,high:bigint>>>>"
    candidates = blocks.select("block", F.lit(0).alias("kind"), "place", "vec_id", "label", "vector", F.lit(None).cast(members).alias("members"))
    queries = chunks.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                            *(F.lit(None).cast(t).alias(c) for c, t in (("place", "long"), ("vec_id", "long"), ("label", "long"), ("vector", "binary"))),
                            F.col("members").cast(members).alias("members"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, block = None, [], None
        for batch in batches:
            numbers, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, (b, kind) in enumerate(zip(numbers, kinds)):
                if b != number:
                    number, held, block = b, [], None
                if kind == 0:
                    held.append(tuple(batch.column(c)[k].as_py() for c in (2, 3, 4, 5)))
                    continue
                if not held and block is None:
                    continue  # a block without candidates
                if block is None:
                    places, ids, labels, vectors = zip(*held)
                    m = _matrix(list(vectors), width)
                    block = {"places": np.array(places, np.int64), "ids": np.array(ids, np.int64), "labels": np.array(labels, np.int64),
                             "vectors": m, "units": _unit(m), "norms": _norms(m)}
                    held = []
                hits = walk(block, batch.column(6)[k].as_py(), same, take, width)
                if hits:
                    yield _arrow(list(zip(*hits)), HIT)

    both = candidates.unionAll(queries)
    hits = both.repartition(n_blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(task, HIT)
    order = Window.partitionBy("place", "walker").orderBy(F.col("score").desc(), "other_id", "other_place")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, band: tuple[int, int] = (50, 95),
         key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of the whole-number vectors, in an anchor's list the higher first, ties by the
    smaller id.  The positives of an anchor are its first other rows of the same label; for each of them come the
    first rows of another label whose score s satisfies ``band[0] * p <= 100 * s <= band[1] * p`` for the positive's score p.
    Anchors are the rows for which ``anchors`` is true, out of all rows that take part (``prepared``).
    Rows that repeat an id are rows of their own; a null id comes behind all others.  A shorter vector counts
    as filled up with zeros.  Extra columns are left out.  A table without anchors gives no rows.  Vectors whose
    score may pass 2**63, which no long holds, raise an error.
    """
    spark = rows.sparkSession
    table = cut(prepared(rows, anchors, key, vector, label), "vectors")
    width, n_anchors = table.agg(F.max(F.length("vector")), F.count_if("anchor")).first()
    if not n_anchors:
        return _nothing(spark)
    width = width // 8
    table = cut(clustered(table, centroids(table, width)), "clustered")
    counts = table.groupBy("cluster").agg(F.count("*").alias("n"), F.count_if("anchor").alias("a")).collect()  # a row a centroid
    blocks, n_blocks = _dealt(table, BLOCK, {r.cluster: r.n for r in counts}, "block")
    asked, _ = _dealt(table.where("anchor"), CHUNK, {r.cluster: r.a for r in counts}, "chunk")

    def chunks(members: DataFrame) -> DataFrame:
        return members.groupBy("chunk").agg(F.collect_list(F.struct("place", "label", "vector", "bands")).alias("members"))

    everything = F.array(F.struct(F.lit(-2**63).cast("long").alias("low"), F.lit(NO_ID).alias("high")))
    near = cut(_searched(blocks, n_blocks, chunks(asked.withColumn("bands", everything)), True, positives, width), "positives")
    # scores below 0 have no band; rank k of the positives is walker k - 1 of the second search
    exact = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(exact * band[0] / 100), F.floor(exact * band[1] / 100)
    bands = near.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("b")).select(
        "place", F.transform("b", lambda b: F.struct(b["low"].cast("long").alias("low"), b["high"].cast("long").alias("high"))).alias("bands"))
    far = _searched(blocks, n_blocks, chunks(asked.join(bands, "place")), False, negatives, width)
    ids = asked.select("place", F.col("vec_id").alias("anchor_id"))
    known = near.select("place", (F.col("rank") - 1).alias("walker"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return far.join(known, ["place", "walker"]).join(ids, "place").select(
        named("anchor_id"), named("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score")).withColumn("negative_id", named("negative_id"))


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
