"""MinHash near-deduplication with sequential Bayesian verification.

Documents with equal shingle sets form a class; only class representatives go
on. Banded signatures give buckets. In a bucket every member is compared with
its smallest one; buckets that still hold several components are then compared
block by block, members of different components only, so a large group of
copies never becomes all its pairs. A comparison reads the signatures in
batches and stops as soon as the posterior says that the similarity bound is
out of reach; what survives is confirmed on the full shingle sets.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (_rng_table, cut, mix, slices, small, table, text_bytes, text_only,
                     token_bounds, unused, word_hashes)
from .components import connected_components

PERMS = 128
ROWS = 4  # 32 bands of 4: a pair at similarity 0.8 shares no band with probability 5e-8
BATCH = 16
MISS = 1e-6
BLOCK = 1 << 20  # shingles a side that one comparison task holds

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT = _rng_table(23, PERMS)
_XOR = _rng_table(29, PERMS)
_A = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Each row's distinct k-word shingles as sorted 64-bit hashes.

    Words are runs of other than white space (space, 9-13), A-Z lower-cased. A
    row with 1 to k-1 words has one shingle, the whole sequence; without words
    the set is empty.
    """
    data = _LOWER[data]
    starts, ends, tok = token_bounds(data, off, _IS_WORD)
    h = word_hashes(data, starts, ends)
    acc = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        acc = acc * _A + h[j:len(h) - k + 1 + j]
    acc = mix(acc)
    out = []
    for i in range(len(off) - 1):
        a, b = int(tok[i]), int(tok[i + 1])
        if b - a >= k:
            s = acc[a:b - k + 1].copy()
            s.sort()
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    one = one * _A + x
            s = mix(np.array([one], np.uint64))
        else:
            s = np.empty(0, np.uint64)
        out.append(s)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(rows, PERMS) uint32: the smallest of each permuted hash; zeros for an empty set."""
    sig = np.zeros((len(sets), PERMS), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        to, n = at, 0
        while to < len(full) and (to == at or n + len(sets[full[to]]) <= 1 << 15):
            n += len(sets[full[to]])
            to += 1
        x = np.concatenate([sets[i] for i in full[at:to]])
        first = np.cumsum([0] + [len(sets[i]) for i in full[at:to - 1]])
        y = np.empty_like(x)
        for p in range(PERMS):
            np.bitwise_xor(x, _XOR[p], out=y)
            np.multiply(y, _MULT[p], out=y)
            sig[full[at:to], p] = np.minimum.reduceat(y, first) >> np.uint64(32)
        at = to
    return sig


@lru_cache(maxsize=8)
def fewest_matches(threshold: float, miss: float, batch: int = BATCH, perms: int = PERMS):
    """For n = batch, 2 batch, ...: the fewest matches for which to go on.

    The prior of the similarity is uniform, so after m matches in n the chance
    that it is at least t is the tail of Beta(m+1, n-m+1), which equals
    P(Binomial(n+1, t) <= m). Below ``miss`` the pair is dropped.
    """
    out = []
    for n in range(batch, perms + 1, batch):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append(m)
    return out


def survivors(left: np.ndarray, right: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Indices of the row pairs of two (n, PERMS) arrays that no batch rules out."""
    idx, same = np.arange(len(left)), np.zeros(len(left), np.int32)
    for i, least in enumerate(fewest_matches(threshold, miss)):
        part = slice(i * BATCH, (i + 1) * BATCH)
        same = same + (left[idx, part] == right[idx, part]).sum(1)
        keep = same >= least
        idx, same = idx[keep], same[keep]
    return idx


def _sketch(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, two set digests, signature."""
    def run(batches):
        for b in slices(batches):
            sets = shingle_sets(*text_bytes(b.column("text")), k)
            sig = signatures(sets)
            d1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
            d2 = np.array([mix(s ^ _A).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                pa.array([r.tobytes() for r in sig], pa.binary())],
                ["doc_id", "n_shingles", "d1", "d2", "sig"])
    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, sig binary")


def _rows(col: pa.Array) -> np.ndarray:
    """A column of equally long signatures as a matrix."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(len(col), PERMS)


def _bayes(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The (a, b) pairs whose signatures keep the similarity bound possible."""
    both = pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa")), "a") \
        .join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb")), "b") \
        .select("a", "b", "sa", "sb")

    def run(batches):
        for b in batches:
            if b.num_rows:
                keep = survivors(_rows(b.column("sa")), _rows(b.column("sb")), threshold, miss)
                yield b.select(["a", "b"]).take(pa.array(keep))
    return both.mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, s: the sorted shingle hashes as bytes."""
    def run(batches):
        for b in slices(batches):
            sets = shingle_sets(*text_bytes(b.column("text")), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["doc_id", "s"])
    return docs.mapInArrow(run, "doc_id bigint, s binary")


def _confirm(pairs: DataFrame, docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """The (a, b) pairs whose full shingle sets are similar enough."""
    percent = round(threshold * 100)

    def run(batches):
        for b in batches:
            a_ids, b_ids = b.column("a").to_pylist(), b.column("b").to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(b.column("x"), b.column("y"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a_ids[i] for i in keep], pa.int64()),
                 pa.array([b_ids[i] for i in keep], pa.int64())], ["a", "b"])
    ids = small(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = _sets(docs.join(ids, "doc_id", "left_semi"), k).dropDuplicates(["doc_id"])
    return pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("x")), "a") \
        .join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("y")), "b") \
        .select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _join_components(ids, comp, query, sig, sets, threshold, miss):
    """Links that join components: each query row against the rows of others.

    Pairs of one component (links found here included) are not compared, so
    at most one link for each join of two components comes out.
    """
    percent = round(threshold * 100)
    root = comp.copy()
    links = []
    for q in np.flatnonzero(query):
        at = np.flatnonzero(~query & (root != root[q]))
        hits = at[survivors(np.broadcast_to(sig[q], (len(at), PERMS)), sig[at], threshold, miss)]
        order = np.argsort(-(sig[hits] == sig[q]).sum(1), kind="stable")
        for m in hits[order]:
            if root[m] != root[q]:
                both = len(np.intersect1d(sets[q], sets[m], assume_unique=True))
                if 100 * both >= percent * (len(sets[q]) + len(sets[m]) - both):
                    links.append((ids[q], ids[m]))
                    root[root == root[m]] = root[q]
    return links


def _block_links(bands: DataFrame, comps: DataFrame, reps: DataFrame, docs: DataFrame, k: int,
                 threshold: float, miss: float, block: int) -> DataFrame | None:
    """Links between components that still share a bucket; None if none share one.

    Such a bucket's members outside its largest component (the stragglers) are
    compared with all its members, in cells of about ``block`` shingles a side.
    """
    known = bands.join(comps, F.col("doc_id") == F.col("node"), "left").select(
        "band", "key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = known.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"),
        F.max("component").alias("hi")).where("n > 2 AND lo <> hi").select("band", "key")
    rows = cut(known.join(mixed, ["band", "key"])
               .join(reps.select("doc_id", "n_shingles"), "doc_id"), "mixed-buckets")
    if not rows.limit(1).count():
        return None
    parts = rows.groupBy("band", "key", "component").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("w"))
    main = parts.groupBy("band", "key").agg(
        F.max(F.struct("c", (-F.col("component")).alias("neg"), "w")).alias("top"),
        F.sum("w").alias("w")).select(
        "band", "key", (-F.col("top.neg")).alias("main"),
        F.ceil(F.col("w") / block).cast("int").alias("cells_m"),
        F.ceil((F.col("w") - F.col("top.w")) / block).cast("int").alias("cells_s"))
    rows = rows.join(main, ["band", "key"])
    spread = F.xxhash64("doc_id")
    members = rows.select("band", "key", "doc_id", "component", F.lit(False).alias("query"),
                          F.pmod(spread, "cells_m").cast("int").alias("cm"),
                          F.explode(F.sequence(F.lit(0), F.col("cells_s") - 1)).alias("cs"))
    strays = rows.where("component <> main").select(
        "band", "key", "doc_id", "component", F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), F.col("cells_m") - 1)).alias("cm"),
        F.pmod(spread, "cells_s").cast("int").alias("cs"))
    ids = small(rows.select("doc_id").distinct())
    full = cut(_sets(docs.join(ids, "doc_id", "left_semi"), k)
               .join(reps.select("doc_id", "sig"), "doc_id").dropDuplicates(["doc_id"]),
               "mixed-sets")
    cells = members.unionByName(strays).join(full, "doc_id")

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column("s")]
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, PERMS)
        links = _join_components(
            t.column("doc_id").to_numpy(), t.column("component").to_numpy(),
            np.asarray(t.column("query").to_pylist(), bool), sig, sets, threshold, miss)
        return pa.table({"a": pa.array([min(x) for x in links], pa.int64()),
                         "b": pa.array([max(x) for x in links], pa.int64())})
    return cells.groupBy("band", "key", "cm", "cs").applyInArrow(compare, "a bigint, b bigint") \
        .distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 5, threshold: float = 0.8, miss: float = MISS,
                    block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of distinct k-word shingles have a
    Jaccard similarity of ``threshold`` or more; component_id is the smallest
    doc_id reachable, kept means it is the own one. Null, empty and blank texts
    have no shingles and are linked with nothing. doc_id must not be null to
    take part: rows without one get a null component_id and are not kept. Rows
    that repeat a doc_id and its text are all returned, alike. No rows give no
    rows. Other columns are ignored, whatever their names. ``miss`` is the
    chance of dropping a pair at the bound in a signature comparison.
    """
    text = text_only(docs, id_col, text_col)
    sketch = cut(_sketch(text, k), "sketches")
    sets = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["d1", "d2", "n_shingles"]
    classes = cut(sets.groupBy(*key).agg(F.min("doc_id").alias("rep")), "classes")
    member = sets.join(classes, key).select("doc_id", "rep").distinct()
    reps = sets.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi") \
        .select("doc_id", "n_shingles", "sig").dropDuplicates(["doc_id"])
    reps = cut(reps, "representatives")
    n_bands = PERMS // ROWS
    bands = reps.select("doc_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda i: F.xxhash64(F.substring("sig", i * (4 * ROWS) + 1, F.lit(4 * ROWS)))))
        .alias("band", "key"))
    heads = bands.groupBy("band", "key").agg(
        F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(bands.join(heads, ["band", "key"]), "buckets")
    pairs = shared.where("doc_id <> head").select(
        F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    maybe = cut(_bayes(pairs, reps, threshold, miss), "survivors")
    links = cut(_confirm(maybe, text, k, threshold), "confirmed")
    comps = cut(connected_components(links), "components")
    rest = _block_links(shared.drop("head", "n"), comps, reps, text, k, threshold, miss, block)
    if rest is not None:
        comps = cut(connected_components(links.unionByName(cut(rest, "block-links"))), "components")
    named = member.join(comps, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component"))
    return sketch.select("doc_id", "n_shingles").join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(False))
        .alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         k: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: of each linked group the smallest doc_id, all columns.

    Rows without shingles or without doc_id are in no group and stay. The ids
    that go are anti-joined (broadcast when a count shows that they are few).
    """
    found = near_duplicates(docs, id_col, text_col, k, threshold)
    name = unused("_gone", docs)
    gone = cut(found.where("NOT kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias(name)).distinct(), "near-copies")
    return docs.join(small(gone), F.col(f"`{id_col}`") == F.col(name), "left_anti")


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, threshold=0.8)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2),
           lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * (
    (SELECT n_shingles FROM n WHERE n.doc_id = a.doc_id)
    + (SELECT n_shingles FROM n WHERE n.doc_id = b.doc_id) - count(*))),
reach AS (
  SELECT doc_id AS u, doc_id AS v FROM n
  UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u)
SELECT n.doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, c.component_id,
       c.component_id = n.doc_id AS kept
FROM n JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY u) c ON c.u = n.doc_id
"""

QUERIES = {"op6_near_dedup": op6_near_dedup}
ORACLES = {"op6_near_dedup": ORACLE}
