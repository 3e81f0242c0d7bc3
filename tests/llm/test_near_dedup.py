"""Near-duplicates against brute force, the block stage and the odd inputs."""

import random
import re

import numpy as np
import pytest

from ledgerline.llm import near_dedup as N

SCHEMA = "doc_id bigint, text string, lang string, sig string, band string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", "y", "z") for i, t in rows], SCHEMA)


def brute(rows, k, percent):
    """doc_id -> (set size, smallest id reachable)."""
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(
            {c: c + 32 for c in range(65, 91)})) if x]
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= percent * (len(sets[a] | sets[b])):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, **kw):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           N.near_duplicates(frame(spark, rows), **kw).collect()}
    assert got == brute(rows, kw.get("k", 5), 80)
    return got


def test_chain_of_edits_equals_brute_force(spark):
    """A group whose members drift apart: many pairs share buckets but are not linked."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocab, k=60))) for i in range(20)]
    base = rng.choices(vocab, k=80)
    for i in range(100, 170):
        if i % 3 == 0:
            base = list(base)
            base[rng.randrange(80)] = "edit%d" % i
        words = list(base)
        words[rng.randrange(80)] = "own%d" % i
        rows.append((i, " ".join(words)))
    got = check(spark, rows, k=4)
    assert len({c for _, c in got.values()}) < len(rows)
    # tiny blocks: every mixed bucket is cut into many cells
    assert {r.doc_id: r.component_id for r in
            N.near_duplicates(frame(spark, rows), k=4, block=100).collect()} == \
        {i: c for i, (_, c) in got.items()}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"),
            (7, "é " * 5000), (8, "É " * 5000), (9, "x" * 200_000), (10, "x" * 200_000), (11, "é " * 9)]
    check(spark, rows, k=4)


def test_null_ids_repeats_and_empty_table(spark):
    out = N.near_duplicates(frame(spark, [(None, "a b c d e f"), (2, "a b c d e f"),
                                          (2, "a b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in out) == \
        [(0, 0, False), (2, 2, True), (2, 2, True)]
    empty = N.near_duplicates(frame(spark, []))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert empty.count() == 0


def test_fewest_matches_keeps_pairs_at_the_bound():
    """At similarity 0.8 a pair is dropped with a probability far below 1e-3."""
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 32, (20000, N.PERMS), dtype=np.uint32)
    right = np.where(rng.random(left.shape) < 0.8, left, left + 1)
    assert len(N.survivors(left, right, 0.8, N.MISS)) == len(left)
    far = np.where(rng.random(left.shape) < 0.4, left, left + 1)
    assert len(N.survivors(left, far, 0.8, N.MISS)) == 0


@pytest.mark.parametrize("words", [0, 1, 3, 4, 5, 50])
def test_set_sizes(words):
    data = np.frombuffer(" ".join(f"w{i}" for i in range(words)).encode(), np.uint8)
    sets = N.shingle_sets(data, np.array([0, len(data)]), 4)
    assert len(sets[0]) == (0 if not words else max(1, words - 3))
