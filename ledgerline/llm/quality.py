"""Quality classifier: Bradley-Terry pairwise ranking over text statistics.

A document's score is linear in standardised statistics of its text. The
weights come from preference pairs (a document labelled 1 is preferred to one
labelled 0): logistic loss on the difference of their features. The decision
threshold is a quantile of the training scores, the share of label 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, table, text_bytes, text_only, token_bounds, word_hashes

#: Labelled rows that the fit uses at most (those with the smallest hashed id), and pairs.
FIT_ROWS = 20_000
FIT_PAIRS = 200_000
#: Score that the threshold quantile is mapped to: predicted = score >= ACCEPT.
ACCEPT = 0.3

FEATURES = ["log_bytes", "word_bytes", "upper", "digits", "symbols", "pipes", "exclaims",
            "distinct_words", "distinct_pairs", "newlines", "stops", "high_bytes",
            "longest_word", "line_words", "stutter"]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = ~_SPACE


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = {
    "upper": _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _flags(b"abcdefghijklmnopqrstuvwxyz"),
    "digits": _flags(b"0123456789"),
    "symbols": _flags(b"#$%&*+<=>@[\\]^_`{}~"),
    "pipes": _flags(b"|"),
    "exclaims": _flags(b"!"),
    "newlines": _flags(b"\n"),
    "stops": _flags(b".?"),
}


def text_features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Statistics of each text, (rows, len(FEATURES)); zeros for an empty text."""
    rows = len(off) - 1
    size = np.maximum(np.diff(off), 1).astype(float)
    counts = {}
    for name, table_ in _CLASSES.items():
        at = np.flatnonzero(table_[data])
        counts[name] = np.diff(np.searchsorted(at, off)).astype(float)
    high = np.diff(np.searchsorted(np.flatnonzero(data >= 0xC0), off)).astype(float)
    starts, ends, tok = token_bounds(data, off, _WORD)
    words = np.diff(tok).astype(float)
    some = np.maximum(words, 1)
    h = word_hashes(data, starts, ends)
    pairs = mix(h[:-1] * np.uint64(3) + h[1:]) if len(h) > 1 else np.empty(0, np.uint64)
    distinct, twice, longest = np.ones(rows), np.ones(rows), np.zeros(rows)
    stutter = np.zeros(rows)
    lens = ends - starts
    for i in np.flatnonzero(words):
        a, b = tok[i], tok[i + 1]
        distinct[i] = len(np.unique(h[a:b])) / (b - a)
        if b - a > 1:
            twice[i] = len(np.unique(pairs[a:b - 1])) / (b - a - 1)
            stutter[i] = np.sqrt((h[a:b - 1] == h[a + 1:b]).mean())
        longest[i] = lens[a:b].max()
    letters = np.maximum(counts["upper"] + counts["lower"], 1)
    out = np.stack([
        np.log1p(np.diff(off)), (size - words) / some, counts["upper"] / letters,
        counts["digits"] / size, np.sqrt(counts["symbols"] / some),
        np.sqrt(counts["pipes"] / some), np.sqrt(counts["exclaims"] / some), distinct, twice,
        counts["newlines"] / some, counts["stops"] / some, high / size,
        np.log1p(longest), np.log1p(words / (counts["newlines"] + 1)), stutter], axis=1)
    out[np.diff(off) == 0] = 0
    return out


def features_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, features array<double>."""
    def run(batches):
        for b in slices(batches):
            x = text_features(*text_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))],
                ["doc_id", "features"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, features array<double>")


def fit_bradley_terry(x: np.ndarray, y: np.ndarray, pairs: int = FIT_PAIRS,
                      l2: float = 1e-3, steps: int = 30) -> dict:
    """Weights, standardisation and threshold from features and 0/1 labels.

    Without rows of both labels the weights are 0 and every score is 0.5 (all accepted).
    """
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"mean": np.zeros(k), "scale": np.ones(k), "w": np.zeros(k),
                "threshold": 0.0, "base": 0.0}
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.Generator(np.random.PCG64(7))
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(k)
    for _ in range(steps):  # Newton's method on the pairwise logistic loss
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        grad = -(diff * (1 - p)[:, None]).mean(0) + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + l2 * np.eye(k)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    s = np.sort(z @ w)
    at = min(max(len(bad), 1), len(s) - 1)
    return {"mean": mean, "scale": scale, "w": w, "threshold": float((s[at - 1] + s[at]) / 2),
            "base": float(np.log(ACCEPT / (1 - ACCEPT)))}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """0 to 1; the threshold quantile is mapped to ACCEPT."""
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    # summed row by row: a matrix product's last bits depend on the rows beside it
    s = (z * model["w"]).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(s - model["threshold"] + model["base"], -30, 30)))


def fold(col):
    return F.crc32(col.cast("string").cast("binary")) % 5


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Fit on at most ``fit_rows`` labelled rows outside the held-out fold.

    ``labels`` has doc_id and quality (0/1); rows with a null in either, or
    with another quality, are left out; of repeated doc_ids the smallest
    quality counts, of a doc_id's several texts the one with the smallest features.
    """
    chosen = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
              .where("doc_id IS NOT NULL AND quality IN (0, 1)")
              .where(fold(F.col("doc_id")) != 0)
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    # at most fit_rows rows of two numbers: a proven bound for the broadcast; a doc_id that
    # stands in docs several times is one row (its smallest features) before any reaches the driver
    rows = (features_of(text_only(docs).join(F.broadcast(chosen), "doc_id", "left_semi"))
            .groupBy("doc_id").agg(F.min("features").alias("features"))
            .join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toPandas())
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit_bradley_terry(x, rows["quality"].to_numpy())


def quality_scores(docs: DataFrame, model: dict) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A null text counts as empty; an empty text has all statistics 0 and gets
    the model's score for that. A null doc_id is kept and counts as held out
    in no fold (held_out false). Repeated rows get equal scores. Other columns
    are ignored, whatever their names.
    """
    def run(batches):
        for b in slices(batches):
            s = score(model, text_features(*text_bytes(b.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])
    out = text_only(docs).mapInArrow(run, "doc_id bigint, score double")
    return out.select("doc_id",
                      F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, with all their columns."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches):
        for b in slices(batches):
            s = score(model, text_features(*text_bytes(b.column(at))))
            yield b.filter(pa.array(s >= ACCEPT))
    return docs.mapInArrow(run, schema)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op10_quality": op10_quality}
ORACLES = {}
