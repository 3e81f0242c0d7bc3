"""Merkle manifest of a dataset: every row's leaf, its proof, and one root.

Each group's leaves are numbered in order and cut into aligned blocks of
``FAN ** LEVELS`` leaves. A block keeps each of its levels as *one* hex string:
parents are hashes of fixed-width substrings of it, and the siblings of a node
are the substrings to the left and right of it in its run. The tops of the
blocks are the leaves of the next round, so a row ever holds 512 nodes at most
and the rounds grow with the logarithm of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, numbered, table

#: Nodes hashed into one parent, and levels kept in one block.
FAN, LEVELS = 8, 3
BLOCK = FAN ** LEVELS
WIDTH = 64              # hex characters of a digest
RUN = FAN * WIDTH

EMPTY = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, " \
        "folded_root string, verified boolean"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and itself; a null as ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def parents(level: Column) -> Column:
    """The next level's string: the hash of each run of ``FAN`` digests."""
    runs = F.floor((F.length(level) - 1) / RUN).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), runs),
        lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "").cast("binary")


def blocks(nodes: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """One row per block: ``block``, ``above`` (blocks of the group), ``nodes``, ``levels``, ``top``.

    ``levels`` has the level strings that were hashed, the lowest first. A
    group of several blocks is hashed ``LEVELS`` times in all of them, a
    group of one until one node remains: not at all if it is alone.
    """
    kept = F.struct("rank", "digest", *payload)
    out = nodes.groupBy(group, F.floor(F.col("rank") / BLOCK).alias("block")).agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(kept)).alias("nodes"))
    out = out.withColumn("level0", F.array_join("nodes.digest", "").cast("binary"))
    goes_on = lambda level: (F.col("total") > BLOCK) | (F.length(level) > WIDTH)
    for k in range(LEVELS):
        level = F.col(f"level{k}")
        out = out.withColumn(f"level{k + 1}", F.when(goes_on(level), parents(level)))
    levels = [F.when(F.col(f"level{k + 1}").isNotNull(), F.col(f"level{k}")) for k in range(LEVELS)]
    top = F.coalesce(*[F.col(f"level{k}") for k in range(LEVELS, -1, -1)])
    return out.select(group, "block", F.ceil(F.col("total") / BLOCK).alias("above"), "nodes",
                      F.array_compact(F.array(*levels)).alias("levels"),
                      top.cast("string").alias("top"))


def segments(levels: Column, rank: Column) -> Column:
    """The siblings of a block's node at each level: what stands left and right of it in its run."""
    def flank(level, k):
        at = rank % BLOCK
        at = F.floor(at / F.pow(F.lit(float(FAN)), k)).cast("int")
        run = at - at % FAN
        return F.struct(
            F.substring(level, run * WIDTH + 1, (at - run) * WIDTH).cast("string").alias("left"),
            F.substring(level, (at + 1) * WIDTH + 1, (run + FAN - 1 - at) * WIDTH)
            .cast("string").alias("right"))
    return F.transform(levels, flank)


def fold(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to with the given siblings."""
    return F.aggregate(path, node,
                       lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def _climb(nodes: DataFrame, group: str, payload: list[str], name: str) -> list[DataFrame]:
    """The blocks of each round, up to one node per group."""
    rounds = []
    while True:
        rounds.append(cut(blocks(nodes, group, payload), f"merkle-{name}"))
        if not rounds[-1].where("above > 1").limit(1).count():
            return rounds
        nodes = rounds[-1].select(group, F.col("block").alias("rank"), F.col("above").alias("total"),
                                  F.col("top").alias("digest"))
        payload = []


def _paths(rounds: list[DataFrame], group: str, over: DataFrame, extra: list[str]) -> DataFrame:
    """(group, block, path from the block's top to the root, extra) for the blocks of the first round.

    ``over`` has what every group's last node gets: path and extra.
    """
    last = rounds[-1].select(group, "block").join(over, group)
    for upper in reversed(rounds[1:]):
        found = upper.join(last, [group, "block"])
        path = lambda n: F.concat(segments(F.col("levels"), n["rank"]), F.col("path"))
        last = found.select(group, *extra, F.inline(F.transform(
            "nodes", lambda n: F.struct(n["rank"].alias("block"), path(n).alias("path")))))
    return last


def manifest(rows: DataFrame) -> DataFrame:
    """One row for each of ``rows`` (doc_id, lang, leaf, tampered): its place in the tree.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Leaves ascend by doc_id in their lang (null first; of equal ids by leaf, so
    repeated rows are leaves of their own in a defined order). Groups ascend
    by lang, null first, bytewise. ``tampered`` is the leaf that is folded up;
    null means the leaf itself. No rows give no rows.
    """
    spark = rows.sparkSession
    # a key without null that sorts as lang does, null first
    nodes = rows.select(F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), "lang"))
                        .alias("grp"), "doc_id", F.col("leaf").alias("digest"), "tampered")
    ranked = numbered(nodes, "grp", ["doc_id", "digest"])
    rounds = _climb(ranked, "grp", ["doc_id", "tampered"], "rows")
    tops = rounds[-1].select(F.lit("").alias("all"), "grp", F.col("top").alias("digest"))
    langs = _climb(numbered(tops, "all", ["grp"]), "all", ["grp"], "groups")
    root = langs[-1].select("top").first()
    if root is None:
        return spark.createDataFrame([], EMPTY)

    none = F.array().cast("array<struct<left:string,right:string>>")
    last = langs[-1].select("all", none.alias("path")).distinct()
    over = langs[0].join(_paths(langs, "all", last, []), ["all", "block"])
    over = over.select(F.inline(F.transform("nodes", lambda n: F.struct(
        n["grp"].alias("grp"), n["digest"].alias("subroot"),
        F.concat(segments(F.col("levels"), n["rank"]), F.col("path")).alias("path")))))
    found = rounds[0].join(_paths(rounds, "grp", over, ["subroot"]), ["grp", "block"])

    def row(n):
        path = F.concat(segments(F.col("levels"), n["rank"]), F.col("path"))
        beside = F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
        return F.struct(n["doc_id"].alias("doc_id"), n["digest"].alias("leaf"),
                        digest(beside).alias("proof_sha256"),
                        fold(F.coalesce(n["tampered"], n["digest"]), path).alias("folded_root"))
    out = found.select("subroot", F.inline(F.transform("nodes", row)))
    return out.select("doc_id", "leaf", "subroot", F.lit(root[0]).alias("root"), "proof_sha256",
                      "folded_root", (F.col("folded_root") == root[0]).alias("verified"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered) of documents.

    A leaf covers doc_id, source, lang, n_chars and text, so any null or empty
    one has its own digest. Where 3 divides the CRC-32 of the decimal doc_id
    the tampered leaf has A-Z of the text lower-cased; a null doc_id is never
    tampered with. Other columns of ``docs`` are ignored, whatever their names.
    """
    col = lambda c: F.col(f"`{c}`")
    head = [col("doc_id"), col("source"), col("lang"), col("n_chars")]
    hit = F.crc32(col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(
        col("doc_id").cast("bigint").alias("doc_id"), col("lang").alias("lang"),
        leaf(*head, col("text")).alias("leaf"),
        F.when(hit, leaf(*head, ascii_lower(col("text")))).alias("tampered"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Leaf, proof and root of every ``documents`` row; odd input as in :func:`manifest`."""
    return manifest(cut(document_leaves(table(spark, sf_dir, "documents")), "merkle-leaves"))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)) AS t),
enc AS (
  SELECT doc_id, lang, text,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a // 256, crc.t[(xor(a, b) % 256) + 1]))) % 3 = 0 AS hit
  FROM documents, crc),
leaves AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS grp,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN hit THEN translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS other
  FROM enc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves),
nodes AS (
  SELECT grp, 0 AS lev, idx, leaf AS h FROM placed
  UNION ALL
  SELECT grp, lev + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS c FROM nodes) WHERE c > 1
  GROUP BY grp, lev, idx // 8),
heads AS (
  SELECT grp, max(lev) AS levs, arg_max(h, lev) AS subroot FROM nodes GROUP BY grp),
langs AS (
  SELECT *, row_number() OVER (ORDER BY grp) - 1 AS idx FROM heads),
uppers AS (
  SELECT 0 AS lev, idx, subroot AS h FROM langs
  UNION ALL
  SELECT lev + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS c FROM uppers) WHERE c > 1 GROUP BY lev, idx // 8),
top AS (SELECT max(lev) AS levs, arg_max(h, lev) AS root FROM uppers),
steps AS (
  SELECT p.grp, p.idx, n.lev,
    coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx < p.idx // (8 ** n.lev)::BIGINT), '') AS l,
    coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx > p.idx // (8 ** n.lev)::BIGINT), '') AS r
  FROM placed p JOIN heads USING (grp)
    JOIN nodes n ON n.grp = p.grp AND n.lev < levs AND n.idx // 8 = p.idx // (8 ** (n.lev + 1))::BIGINT
  GROUP BY p.grp, p.idx, n.lev
  UNION ALL
  SELECT p.grp, p.idx, 1000 + n.lev,
    coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx < g.idx // (8 ** n.lev)::BIGINT), ''),
    coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx > g.idx // (8 ** n.lev)::BIGINT), '')
  FROM placed p JOIN langs g USING (grp), top
    JOIN uppers n ON n.lev < top.levs AND n.idx // 8 = g.idx // (8 ** (n.lev + 1))::BIGINT
  GROUP BY p.grp, p.idx, n.lev),
paths AS (
  SELECT grp, idx, list({'l': l, 'r': r} ORDER BY lev) AS path, string_agg(l || r, '' ORDER BY lev) AS beside
  FROM steps GROUP BY grp, idx),
folds AS (
  SELECT grp, idx, path, beside, other AS h, 1 AS pos
  FROM placed LEFT JOIN paths USING (grp, idx)
  UNION ALL
  SELECT grp, idx, path, beside, sha256(path[pos].l || h || path[pos].r), pos + 1
  FROM folds WHERE pos <= coalesce(len(path), 0))
SELECT p.doc_id, p.leaf, g.subroot, top.root, sha256(coalesce(f.beside, '')) AS proof_sha256,
  f.h AS folded_root, f.h = top.root AS verified
FROM folds f JOIN placed p USING (grp, idx) JOIN heads g USING (grp), top
WHERE f.pos = coalesce(len(f.path), 0) + 1
"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLES = {"op12_merkle_manifest": ORACLE}
