"""Secret scans: fixed patterns, and Markov models of random strings and identifiers.

Built from SQL functions only. The base patterns give spans of their own. A
long token besides them is reported when its characters are likelier under a
first-order Markov model of random strings than under one of the ordinary
tokens of the corpus. Both models are counted from labelled samples.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, text_only

#: Documents that the models are trained from at most (those with the smallest hashed id).
FIT_DOCS = 20_000
#: Shortest token that the models judge, least log-likelihood ratio a character, and in all.
MIN_TOKEN = 20
RATIO = 0.4
TOTAL = 12.0
#: Weight of the prior of each symbol's transitions: uniform for random strings,
#: the symbols' own frequency for ordinary tokens.
PRIOR = 16.0

# fixed values: the kinds in their order, their patterns
KINDS = ["assign", "access", "hex", "markov"]
_Q = "[\"']?"
ASSIGN = (rf"(?i)(password|passwd|secret|token|api_?key){_Q}\x20*[:=]\x20*{_Q}"
          r"([A-Za-z0-9+/_.=-]+)")
# a run that is too short is dropped, and no part of it could match: the length goes into the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"

_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
SIZE = len(_LETTERS) + 1  # 0 stands for every other character
_STEP = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


_SPAN = "array<struct<start:int,kind:int,end:int,body:string>>"


def pattern_spans(text: Column, pattern: str, kind: int, group: int | None = None,
                  least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches, in code points.

    Matches whose ``group`` is shorter than ``least`` are dropped. Positions
    are running sums over the pieces between matches, taken in steps of
    _STEP matches so that a text with very many stays cheap.
    """
    def walk(rows):
        def within(chunk):
            return F.aggregate(
                chunk, F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS {_SPAN})").alias("out")),
                lambda acc, r: F.struct(
                    (acc["at"] + r["gap"] + r["size"]).alias("at"),
                    F.concat(acc["out"], F.array(F.struct(
                        (acc["at"] + r["gap"]).alias("start"), F.lit(kind).alias("kind"),
                        (acc["at"] + r["gap"] + r["size"]).alias("end"),
                        r["body"].alias("body")))).alias("out")))
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / _STEP).cast("int")),
            lambda i: within(F.slice(rows, i * _STEP + 1, F.lit(_STEP))))
        # each chunk's spans, moved on by the length of the chunks before
        return F.aggregate(
            chunks, F.struct(F.lit(0).alias("at"),
                             F.expr(f"CAST(array() AS array<{_SPAN}>)").alias("out")),
            lambda acc, c: F.struct(
                (acc["at"] + c["at"]).alias("at"),
                F.concat(acc["out"], F.array(F.transform(c["out"], lambda s: F.struct(
                    (s["start"] + acc["at"]).alias("start"), s["kind"].alias("kind"),
                    (s["end"] + acc["at"]).alias("end"), s["body"].alias("body"))))).alias("out")),
            lambda acc: F.flatten(acc["out"]))

    def rows_of(found):
        return F.transform(found["hits"], lambda h, i: F.struct(
            F.length(F.get(found["gaps"], i)).alias("gap"), F.length(h).alias("size"),
            F.get(found["bodies"], i).alias("body")))
    found = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group or 0)).alias("bodies"))
    spans = _let(found, lambda f: _let(rows_of(f), walk))
    if least:
        spans = F.filter(spans, lambda s: F.length(s["body"]) >= least)
    return F.when(text.rlike(pattern), spans).otherwise(F.expr(f"CAST(array() AS {_SPAN})"))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``base``: the patterns' spans, by start and kind."""
    text = F.col("text")
    return docs.withColumn("base", F.array_sort(F.concat(
        pattern_spans(text, ASSIGN, 0, group=2, least=6),
        pattern_spans(text, ACCESS, 1), pattern_spans(text, HEX, 2))))


def _symbols(token: Column) -> Column:
    """A token's characters as numbers, 0 for those that are no letter or digit."""
    return F.transform(F.filter(F.split(token, "", -1), lambda c: c != ""),
                       lambda c: F.call_function("instr", F.lit(_LETTERS), c))


def _pairs(token: Column) -> Column:
    """Transitions of a token as numbers: previous symbol * SIZE + symbol."""
    return _let(_symbols(token), lambda s: F.transform(
        F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))),
        lambda x, i: F.get(s, i) * SIZE + x))


def train_markov(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, random over ordinary.

    ``samples`` has token and label (1 a random string, 0 an ordinary token).
    Null tokens and those of one character teach nothing. Spark counts the
    transitions; at most 2 * SIZE**2 counts come back, whatever the size of
    the samples. Without samples only the priors speak and all ratios are 0.
    """
    counts = samples.where("token IS NOT NULL AND length(token) > 1 AND label IN (0, 1)") \
        .select("label", F.explode(_pairs(F.col("token"))).alias("pair")) \
        .groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).collect()
    n = [[0.0] * (SIZE * SIZE) for _ in range(2)]
    for r in counts:
        n[r["label"]][r["pair"]] += r["n"]
    out = [0.0] * (SIZE * SIZE)
    # how a symbol is distributed by itself; the prior of its transitions
    seen = [sum(n[0][a * SIZE + b] for a in range(SIZE)) for b in range(SIZE)]
    flat = [(x + 0.5) / (sum(seen) + 0.5 * SIZE) for x in seen]
    for a in range(SIZE):
        word, rand = (x[a * SIZE:(a + 1) * SIZE] for x in n)
        for b in range(SIZE):
            out[a * SIZE + b] = (
                math.log((rand[b] + PRIOR / SIZE) / (sum(rand) + PRIOR))
                - math.log((word[b] + PRIOR * flat[b]) / (sum(word) + PRIOR)))
    return out


def labelled_samples(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """token, label: what the base patterns catch is random, the tokens around it are ordinary."""
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    base = with_base_spans(docs.join(F.broadcast(chosen), "doc_id", "left_semi"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.col("text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    random = base.select(F.explode("base.body").alias("token"), F.lit(1).alias("label"))
    ordinary = base.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0)))
                           .alias("token"), F.lit(0).alias("label"))
    return random.unionByName(ordinary)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, model: list[float], id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_sha256, spans, markov.

    ``spans`` lists all spans as kind:start:end (code points, end exclusive) by
    start, then kind; ``base_sha256`` is the digest of the base ones listed
    likewise. ``markov`` holds the spans that the models add, with their
    ratio; a token that touches a base span adds none. Null and empty texts
    have no spans. A null doc_id is kept; repeated rows give equal rows. Other
    columns are ignored, whatever their names.
    """
    ratios = F.array(*[F.lit(float(x)) for x in model])

    def ratio(token: Column) -> Column:
        return F.aggregate(_pairs(token), F.lit(0.0), lambda acc, p: acc + F.get(ratios, p))
    tokens = pattern_spans(F.col("text"), TOKEN, 3)
    rows = with_base_spans(text_only(docs, id_col, text_col)).withColumn("tokens", tokens)
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (
        b["start"] < t["end"]) & (t["start"] < b["end"])))
    judged = F.transform(free, lambda t: F.struct(
        t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"),
        t["body"].alias("body"), ratio(t["body"]).alias("ratio")))
    rows = rows.select("doc_id", "base", judged.alias("judged"))
    rows = rows.select("doc_id", "base", F.filter("judged", lambda t: (
        t["ratio"] >= TOTAL) & (t["ratio"] >= RATIO * (t["end"] - t["start"] - 1))).alias("markov"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    every = F.array_sort(F.concat("base", F.transform("markov", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        s["body"].alias("body")))))
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(every).alias("spans"), "markov")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_markov(labelled_samples(text_only(docs)))
    return secret_scan(docs, model).withColumn(
        "n_markov", F.size("markov").cast("bigint")).drop("markov")


QUERIES = {"op3_secret_scan": op3_secret_scan}
ORACLES = {}
