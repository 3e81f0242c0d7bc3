"""Manifest trees against a plain recursive reading: several blocks, odd rows, tampering."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerline.llm import merkle as M

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, " \
         "leaf string, grp string, level0 string, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "p") for r in rows], SCHEMA)


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return t if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def climb(level):
    """Root and, for each leaf, its siblings level by level."""
    paths = [[] for _ in level]
    at = list(range(len(level)))
    while len(level) > 1:
        for leaf, p in enumerate(at):
            run = p // 8 * 8
            paths[leaf].append(("".join(level[run:p]), "".join(level[p + 1:run + 8])))
        level = [H("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        at = [p // 8 for p in at]
    return level[0], paths


def brute(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n, text in rows:
        head = field(doc_id) + field(source) + field(lang) + field(n)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaf = H(head + field(text))
        groups[lang].append((doc_id, leaf, H(head + field(lower(text))) if hit else leaf))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = [], {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        top, paths = climb([r[1] for r in groups[g]])
        tops.append(top)
        inner[g] = paths
    if not tops:
        return []
    root, over = climb(tops)
    out = []
    for k, g in enumerate(langs):
        for (doc_id, leaf, other), path in zip(groups[g], inner[g], strict=True):
            path = path + over[k]
            for left, right in path:
                other = H(left + other + right)
            out.append((doc_id, leaf, tops[k], root, H("".join(a + b for a, b in path)),
                        other, other == root))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, M.manifest(M.document_leaves(df)).collect()), key=str)


ODD = [(1, "s", "en", 1, "Abc"), (2, None, "en", None, None), (None, "s", None, 3, "Null id"),
       (None, None, None, None, None), (5, "s", "", 0, ""), (5, "s", "", 0, ""), (5, "t", "", 0, "É"),
       (-7, "s", "zh", 2, "界" * 50_000), (9, "s", "ünder", 2, "UPPER"), (9, "s", "z", 2, "UPPER"),
       (2**62, "a:b", "z", -4, "1:x-")]


def test_odd_rows_equal_brute_force(spark):
    assert found(frame(spark, ODD)) == brute(ODD)


def test_small_trees(spark):
    """Groups of each size beside one another, and a single leaf that is its own root."""
    rows = [(i, "s", f"l{n}", i, f"Text {i}") for n in (1, 2, 7, 8, 9, 63, 64, 65, 512, 513) for i in range(n)]
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, rows[:1])) == brute(rows[:1])


def test_several_blocks_and_many_groups(spark):
    """1,600 rows of one group (four blocks, the last one short) beside 520 groups of one."""
    rows = [(i * 3 % 1601, "s", "hot", i, f"Row {i}") for i in range(1600)]
    rows += [(i, "s", f"l{i}", i, "T") for i in range(520)]
    assert found(frame(spark, rows)) == brute(rows)


def test_one_changed_letter_breaks_only_its_own_proof(spark):
    rows = [(i, "s", "en", 1, "same") for i in range(40)]  # no capitals: tampering changes nothing
    assert all(r[-1] for r in found(frame(spark, rows)))
    rows[3] = (3, "s", "en", 1, "Same")
    rows[4] = (4, "s", "en", 1, "Same")
    bad = {r[0] for r in found(frame(spark, rows)) if not r[-1]}
    assert bad == {i for i in (3, 4) if zlib.crc32(str(i).encode()) % 3 == 0}


def test_equal_rows_and_layout(spark):
    """Copies are leaves of their own; the partitioning changes nothing."""
    df = frame(spark, [(7, "s", "en", 1, "Copy")] * 700 + ODD)
    one = found(df.coalesce(1))
    assert one == found(df.repartition(5, F.rand(1))) == brute([(7, "s", "en", 1, "Copy")] * 700 + ODD)


def test_empty_table(spark):
    got = M.manifest(M.document_leaves(frame(spark, ODD).limit(0)))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.collect() == []
