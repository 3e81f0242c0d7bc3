"""Exact top-k against brute force: ties, odd vectors, blocks of queries, pruning."""

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import topk as T

SCHEMA = "vec_id bigint, embedding array<float>, label string, v string, far string, q string, rank int"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "l", "v", "f", "q", 0) for i, e in rows], SCHEMA)


def brute(rows, k=10, every=100):
    vs = []
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        vs.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))
    out = []
    for i, a in vs:
        if i % every:
            continue
        hits = [(-max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -2**63), j)
                for j, b in vs if j != i]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def found(df, **kw):
    return sorted(map(tuple, T.top_k(df, F.col("vec_id") % 100 == 0, **kw).collect()))


def random_rows(n, dims, seed=5, norm=True):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dims))
    v = v / np.linalg.norm(v, axis=1)[:, None] if norm else v * rng.exponential(size=(n, 1))
    return [(int(i), [float(np.float32(x)) for x in r]) for i, r in zip(rng.permutation(n), v)]


def test_random_vectors_and_blocks_of_queries(spark):
    for norm in (True, False):
        rows = random_rows(1500, 12, norm=norm)
        want = brute(rows)
        assert found(frame(spark, rows)) == want
        assert found(frame(spark, rows).repartition(7), query_bytes=4 * 8 * 13) == want


def test_odd_vectors_ties_and_copies(spark):
    rows = [(0, [1.0, -0.5]), (100, [0.0, 0.0]), (-100, [0.3, 0.3]), (200, None), (300, [1.0, None]),
            (400, [NAN, 1.0]), (500, [INF, 1.0]), (None, [9.0, 9.0]), (7, [1.0]), (8, []),
            (9, [1.0, 2.0, 3.0]), (600, [2.0]), (700, []), (1, [-1e-9, -1e-9]),
            (3, [0.5, 0.5]), (2, [0.5, 0.5]), (5, [0.5, 0.5]), (5, [0.5, 0.5])]
    rows += [(i, [0.25, 0.25]) for i in range(20, 60)]
    assert found(frame(spark, rows)) == brute(rows)
    twice = rows + [(0, [1.0, -0.5])]
    assert found(frame(spark, twice)) == brute(twice)
    assert found(frame(spark, rows), k=3) == brute(rows, 3)


def test_components_beyond_exact_doubles(spark):
    rows = [(0, [3e30, 1.0]), (1, [1e12, -1e12]), (2, [-3e30, 1.0]), (100, [1e12, 1e12]),
            (4, [1e12, 3e8]), (200, [0.5, 0.25])]
    assert found(frame(spark, rows)) == brute(rows)


def test_pivots_spare_most_of_a_clustered_table():
    """Few scores are computed where the bounds can tell clusters apart, and none that matters is missed."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 800
    v = np.floor(centres[np.arange(4000) % 20] + rng.normal(size=(4000, 16)) * 10)
    ids = np.arange(4000)
    most2 = float((v * v).sum(1).max())
    c = T.lifted(v, most2)
    pivots = T.farthest(c[:1000], 64)
    q = v[:40]
    s = T.Search(ids[:40], q, pivots, most2, 10, True)
    far = T.distances(c, pivots).astype(np.float32)
    done = sum(s.see(ids[a:a + 500], v[a:a + 500], far[a:a + 500]) for a in range(0, 4000, 500))
    for j in range(40):
        score = v @ q[j]
        own = np.flatnonzero(ids != j)
        best = own[np.lexsort((own, -score[own]))[:10]]
        assert s.of[j].tolist() == best.tolist()
    assert done < 0.6 * 40 * 4000


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0])]
    assert found(frame(spark, rows)) == []
    assert found(frame(spark, rows + [(1, [1.0, 1.0])])) == [(0, 1, 1, 3 * 2**20)]
    assert found(frame(spark, [(1, [1.0, 1.0])])) == []
    empty = T.top_k(frame(spark, rows).limit(0), F.col("vec_id") % 100 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
