"""Hard negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, place string, score int"


def brute(rows, anchor, positives=5, negatives_=3, band=(50, 95), kind=np.float32):
    own = []
    for vec_id, vec, label in rows:
        if label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        own.append((vec_id, [int(np.floor(256 * float(kind(x)))) for x in vec], label))
    out = []
    for a, (vec_id, vec, label) in enumerate(own):
        if not anchor(vec_id):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, v)), 2**63 if i is None else i, k, i, lab) for k, (i, v, lab) in enumerate(own) if k != a)
        for s, _, _, i, _ in [x for x in scored if x[4] == label][:positives]:
            fit = [x for x in scored if x[4] != label and band[0] * -s <= 100 * -x[0] <= band[1] * -s][:negatives_]
            out += [(vec_id, i, k + 1, x[3], -s, -x[0]) for k, x in enumerate(fit)]
    return sorted(out, key=str)


def table(seed=1):
    r = np.random.default_rng(seed)
    vec = lambda: [float(x) for x in r.normal(0, .2, 8)]
    common = vec()
    rows = [(k, vec(), int(r.integers(0, 3))) for k in range(300)]
    rows += [(300 + k, common, k % 2) for k in range(120)]  # a vector that many rows share
    rows += [(500, None, 1), (501, vec(), None), (502, [None, *vec()[1:]], 1), (503, [float("nan"), *vec()[1:]], 1), (504, [float("inf")] * 8, 0),
             (505, [0.0] * 8, 0), (550, [0.0] * 8, 1), (506, vec()[:3], 1), (560, [], 0), (570, [-x for x in common], 2), (None, common, 0), (None, vec(), 1)]
    rows += [(600, vec(), 7), (40, vec(), 1), rows[20], rows[20], (-10, vec(), 0)]  # a label of one row, repeated ids, repeated rows
    return rows


@pytest.fixture()
def small(monkeypatch):
    """Several centroids, blocks, chunks and steps on a small table."""
    for name, value in (("BLOCK", 60), ("CHUNK", 4), ("STEP", 16), ("FIT_ANCHORS", 256)):
        monkeypatch.setattr(negatives, name, value)


def mined(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    return negatives.mine(df, F.col("vec_id") % 10 == 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_all_inner_products(spark, seed):
    rows = table(seed)
    got = sorted((tuple(r) for r in mined(spark, rows).collect()), key=str)
    assert got == brute(rows, lambda i: i is not None and i % 10 == 0)


def test_equal_in_many_small_blocks(spark, small):
    rows = table(3)
    got = sorted((tuple(r) for r in mined(spark, rows).collect()), key=str)
    assert got == brute(rows, lambda i: i is not None and i % 10 == 0)


def test_walk_stops_where_the_bound_certifies_it():
    """Tight clusters: a member scores only the steps that may hold a result."""
    r = np.random.default_rng(6)
    near, far = np.r_[np.ones(4), np.zeros(4)] * 100, np.r_[np.zeros(4), np.ones(4)] * 100
    vectors = np.floor(np.concatenate([near + r.normal(0, 1, (2000, 8)), far + r.normal(0, 1, (20000, 8))]))

    class Counted(np.ndarray):
        rows = 0

        def __getitem__(self, item):
            if isinstance(item, np.ndarray) and item.dtype != bool:
                Counted.rows += len(item)
            return np.asarray(super().__getitem__(item))

    block = {"places": np.arange(len(vectors)), "ids": np.arange(len(vectors)), "labels": np.zeros(len(vectors), np.int64),
             "vectors": vectors.view(Counted), "units": negatives._unit(vectors), "norms": negatives._norms(vectors)}
    members = [{"place": -1 - k, "label": 0, "vector": (near + k).tobytes(), "bands": [{"low": -2**63, "high": 2**63 - 1}]} for k in range(3)]
    hits = negatives.walk(block, members, True, 5, 8)
    want = [(m["place"], int(s)) for m in members for s in sorted((np.asarray(vectors) @ np.frombuffer(m["vector"])).tolist())[::-1][:5]]
    assert [(h[0], h[4]) for h in hits] == want
    assert Counted.rows < 4000


def test_no_anchor_no_rows_and_no_exact_score(spark):
    assert mined(spark, []).collect() == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]).collect() == []
    with pytest.raises(Exception, match="2\\*\\*63"):
        mined(spark, [(10, [3e12], 1), (2, [3e12], 2)]).collect()


def test_scores_beyond_the_doubles_are_exact(spark):
    r = np.random.default_rng(4)
    rows = [(k, r.uniform(2e6, 4e6, 3).tolist(), k % 3) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(x) for x in negatives.mine(df, F.col("vec_id") % 10 == 0).collect()), key=str)
    assert got == brute(rows, lambda i: i % 10 == 0, kind=float) and any(x[4] % 2 for x in got) and max(x[4] for x in got) > 2**56


def test_query_equals_brute_force_on_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op12_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, lambda i: i % 50 == 0)
