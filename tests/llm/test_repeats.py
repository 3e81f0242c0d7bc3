"""Repeated substrings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import repeats as R

SCHEMA = "doc_id bigint, text string, spans string, ord string, kept string"


def brute(rows, n):
    """(doc_id, text) in order -> size, removed, spans, digest of each."""
    seen, out = set(), []
    for _, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - n + 1):
            w = raw[p:p + n]
            if w in seen:
                gone[p:p + n] = True
            seen.add(w)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if raw else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in R.remove_repeats(df, **kw).collect()}
    want = dict(zip([i for i, _ in rows], brute(rows, kw.get("length", R.LENGTH))))
    assert got == want


def texts(seed):
    """Copies, edited copies, shared passages, periodic and very repetitive texts."""
    rng = random.Random(seed)
    vocab = ["über", "the", "and", "on", "ing", "é", "of", "water", "x"]

    def prose(n):
        return " ".join(rng.choices(vocab, k=n))
    shared, base = prose(60), prose(150)
    out = [None, "", "short", "a" * 700, "ab" * 300, "a" * 99, "a" * 100, base, base]
    for _ in range(25):
        words = base.split()
        words[rng.randrange(150)] = "edit%d" % rng.randrange(10**6)
        out.append(" ".join(words))
        out.append(prose(rng.randrange(40)) + " " + shared + " " + prose(rng.randrange(40)))
    return list(enumerate(out))


def test_equals_brute_force(spark):
    check(spark, texts(1))


def test_hot_grams_and_tiny_shards(spark):
    """Every gram sends single windows; shards are cut inside grams."""
    check(spark, texts(2), hot=1, shard_bytes=500)
    check(spark, texts(3), shard_bytes=300)


def test_repeated_and_missing_ids(spark):
    t = "the same long text over and over " * 6
    rows = [(5, t), (5, t), (None, t), (1, "b" + t)]
    df = spark.createDataFrame([(i, x, "", "", "") for i, x in rows], SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed)
                 for r in R.remove_repeats(df).collect())
    n = len(t)
    first = brute([(1, "b" + t)], 100)[0][1]
    assert got == [(False, 1, first), (False, 5, n), (False, 5, n), (True, 0, n)]


def test_repeated_ids_at_both_ends_of_bigint(spark):
    t = "the same long text over and over " * 6
    rows = [(-2**63, "a" + t), (2**63 - 1, t), (2**63 - 1, t), (0, "c" + t), (None, t)]
    df = spark.createDataFrame([(i, x, "", "", "") for i, x in rows], SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in R.remove_repeats(df).collect())
    n = len(t)
    first = brute([(1, "a" + t)], 100)[0][1]
    assert got == [(False, -2**63, first), (False, 0, n), (False, 2**63 - 1, n),
                   (False, 2**63 - 1, n), (True, 0, n)]


def test_empty_table(spark):
    out = R.remove_repeats(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and "kept_sha256" in out.columns


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    sa, _ = R.suffix_array(data, 100)
    raw = data.tobytes()
    strings = [raw[i:i + 100] for i in sa]
    assert strings == sorted(strings) or all(
        a[:len(b)] <= b for a, b in zip(strings, strings[1:]))
    inside = sa[sa <= 300]
    lcp = R.common_prefixes(R.eight_bytes(data), inside, 100)
    for i in range(1, len(inside)):
        a, b = raw[inside[i - 1]:][:100], raw[inside[i]:][:100]
        n = next((k for k in range(100) if a[k] != b[k]), 100)
        assert lcp[i] == n
