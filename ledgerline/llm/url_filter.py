"""URL filters: rules, and a path-template tree for the urls that no rule decides.

Built from DataFrame operations only. Per host the path segments form a tree.
Segments of a variable shape (numbers, hashes, dates, slugs with a number)
become typed wildcards. Level by level, as deep as the paths are, branches of one
parent whose children are distributed like those of all branches, and whose
labelled purity does not differ, are merged into a wildcard too. A template is rejected when its
smoothed share of blocked labels reaches a bound; smoothing leans on the same
template over all hosts, and that on the share over all urls.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, table

#: Branches of a parent from which on they may be merged, and how alike they must be.
MIN_BRANCHES = 3
COSINE = 0.9
ALPHA = 0.05
#: Weight of the smoothing, and the share of blocked labels that rejects a template.
PRIOR = 4.0
REJECT = 0.5

# fixed values: the rules of the registered query (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_SHAPES = [  # typed wildcards by shape, the first that fits
    (r"^[0-9]+$", "<num>"),
    (r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", "<uuid>"),
    (r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$", "<date>"),
    (r"^[0-9a-f]{16,}$", "<hash>"),
    (r"^[0-9]+[.][a-z0-9]{1,5}$", "<num.ext>"),
    (r"^(?=.*[0-9])[^.]+$", "<mixed>"),
    (r"^(?=.*[0-9]).+$", "<file>"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)),
            F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2))


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one string) and its verdict, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    out = segment
    for pattern, name in reversed(_SHAPES):
        out = F.when(segment.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def shaped_path(path: Column) -> Column:
    """The path's segments, shaped, with ``/`` between them."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.array_join(F.transform(parts, _shape), "/")


def _append(prefix: Column, segments: Column) -> Column:
    """A template with more segments behind it."""
    return F.when(F.size(segments) > 0, F.concat(prefix, F.lit("/"), F.array_join(segments, "/"))) \
        .otherwise(prefix)


def _open_groups(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose template is settled, and those of parents that may yet have branches to merge.

    A parent of fewer than MIN_BRANCHES rows, or of equal ones, has none at any
    level. Of the others the segments that all rows share are passed at once.
    """
    parent = ["host", "prefix"]
    group = tree.groupBy(*parent).agg(F.count(F.lit(1)).alias("rows"), F.min("rest").alias("lo"),
                                      F.max("rest").alias("hi"))
    differ = F.array_position(F.zip_with("lo", "hi", lambda a, b: F.coalesce(a == b, F.lit(False))),
                              F.lit(False))
    group = group.select(*parent, ((F.col("rows") >= MIN_BRANCHES) & (differ > 0)).alias("open"),
                         (differ - 1).cast("int").alias("shared"))
    rows = tree.join(group, parent)
    settled = rows.where(~F.col("open")).select(
        "host", "shaped", "labelled", "blocked", _append(F.col("prefix"), F.col("rest")).alias("template"))
    size = F.size("rest")
    going = rows.where("open").select(
        "host", "shaped", "n", "labelled", "blocked",
        _append(F.col("prefix"), F.slice("rest", F.lit(1), F.col("shared"))).alias("prefix"),
        F.slice("rest", F.col("shared") + 1, size - F.col("shared")).alias("rest"))
    return settled, going


def _merge_level(tree: DataFrame) -> DataFrame:
    """Pass the first segment of ``rest``, as ``*`` where its branch is like its siblings."""
    seg, child, parent = "seg", "child", ["host", "prefix"]
    tree = tree.withColumn(seg, F.coalesce(F.get("rest", F.lit(0)), F.lit(""))) \
        .withColumn(child, F.coalesce(F.get("rest", F.lit(1)), F.lit("")))
    c = tree.groupBy(*parent, seg, child).agg(F.sum("n").cast("double").alias("c"))
    p = c.groupBy(*parent, child).agg(F.sum("c").alias("p"))
    pp = p.groupBy(*parent).agg(F.sum(F.col("p") * F.col("p")).alias("pp"))
    like = c.join(p, [*parent, child]).groupBy(*parent, seg).agg(
        F.sum(F.col("c") * F.col("p")).alias("cp"),
        F.sum(F.col("c") * F.col("c")).alias("cc")).join(pp, parent).select(
        *parent, seg, (F.col("cp") / F.sqrt(F.col("cc") * F.col("pp"))).alias("cosine"))
    branch = tree.groupBy(*parent, seg).agg(
        F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    pooled = branch.groupBy(*parent).agg(
        F.count(F.lit(1)).alias("branches"), F.sum("l").alias("pl"), F.sum("b").alias("pb"))
    width = math.sqrt(math.log(2 / ALPHA) / 2)  # Hoeffding bound of a share's deviation
    apart = F.abs(F.col("b") / F.col("l") - F.col("pb") / F.col("pl")) > \
        width * (1 / F.sqrt("l") + 1 / F.sqrt("pl"))
    merged = branch.join(pooled, parent).join(like, [*parent, seg]).where(
        (F.col("branches") >= MIN_BRANCHES) & (F.col("cosine") >= COSINE) & (F.col(seg) != "")
        & ~F.when((F.col("l") > 0) & (F.col("pl") > 0), apart).otherwise(F.lit(False))
        & ~F.col(seg).startswith("<")).select(*parent, seg, F.lit("*").alias("wild"))
    return tree.join(merged, [*parent, seg], "left").select(
        "host", "shaped", "n", "labelled", "blocked",
        F.concat("prefix", F.when(F.col(seg) == "", F.lit("")).otherwise(
            F.concat(F.lit("/"), F.coalesce("wild", F.col(seg))))).alias("prefix"),
        F.slice("rest", F.lit(2), F.greatest(F.size("rest") - 1, F.lit(0))).alias("rest"))


def template_tree(urls: DataFrame) -> DataFrame:
    """host, shaped, template, reject_share from ``urls`` (host, shaped, label: 1 block, 0 allow, null).

    Everything runs on the distinct (host, shaped path) rows, which the first
    aggregation combines before its shuffle. There are as many rounds as there
    are levels on which some parent still has several different rows.
    """
    tree = cut(urls.groupBy("host", "shaped").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))
        .withColumn("prefix", F.lit("")).withColumn(
            "rest", F.filter(F.split("shaped", "/", -1), lambda s: s != "")), "url-leaves")
    parts = []
    while not tree.isEmpty():
        settled, going = _open_groups(tree)
        parts.append(settled)
        tree = cut(_merge_level(going), f"url-level-{len(parts)}")
    leaves = parts[0] if parts else tree.withColumnRenamed("prefix", "template").drop("n", "rest")
    for part in parts[1:]:
        leaves = leaves.unionByName(part)
    leaves = cut(leaves, "url-templates")
    own = leaves.groupBy("host", "template").agg(
        F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    everywhere = own.groupBy("template").agg(F.sum("l").alias("tl"), F.sum("b").alias("tb"))
    total = everywhere.agg(F.sum("tl").alias("l"), F.sum("tb").alias("b")).first()  # two numbers
    base = (total["b"] or 0) / total["l"] if total["l"] else 0.0
    share = ((F.col("b") + PRIOR * (F.col("tb") + PRIOR * base) / (F.col("tl") + PRIOR))
             / (F.col("l") + PRIOR))
    scored = own.join(everywhere, "template").select(
        "host", "template", share.alias("reject_share"))
    return leaves.select("host", "shaped", "template").join(scored, ["host", "template"])


def url_filter(pages: DataFrame, rules=RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, reject_share.

    ``rules`` are (verdict, host, path): a rule fits its host and all
    subdomains when the url's path starts with the rule's; of several the
    longest counts. The rules label the urls they fit, the template tree
    decides the others. A null url, or one without ``://``, has an empty host
    and path and is judged like any other. Without labels nothing is rejected.
    Repeated rows give equal rows and count each; no rows give no rows. Other
    columns are ignored, whatever their names.
    """
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                       shaped_path(F.col("path")).alias("shaped"))
    label = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    tree = template_tree(rows.select("host", "shaped", label.alias("label")))
    judged = rows.join(tree, ["host", "shaped"])
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("reject_share") >= REJECT, "block").otherwise("allow"))
        .alias("verdict"), "template", F.round("reject_share", 9).alias("reject_share"))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"))


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {}
