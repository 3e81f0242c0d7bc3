"""Language identification: script ranges, n-gram scores of words, Viterbi over the words.

Each word gets a score for each learned language from its letter trigrams. The
script of its letters narrows the languages down to those seen with that
script. A Viterbi pass with a penalty for each change of language then labels
the words, so a mixed text becomes spans of one language each.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, table, text_only
from .quality import fold

#: Documents that the model is learned from at most (those with the smallest hashed id).
FIT_ROWS = 20_000
BUCKETS = 1 << 15
SMOOTH = 0.5
#: Cost of a change of language between two words, in nats.
SWITCH = 8.0
#: Share of a language's letters from which on a script is one of its own.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

# fixed values: first code points of the script ranges, and their names
SCRIPTS = [(0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"),
           (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"),
           (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
           (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
           (0x0D00, "malayalam"), (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "lao"),
           (0x0F00, "tibetan"), (0x1000, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
           (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
           (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
           (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
           (0x323B0, "other")]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, its lower-case form (if one code point), its script."""
    n = 0x110000
    letter, lower = np.zeros(n, bool), np.arange(n, dtype=np.uint32)
    for c in range(n):
        if unicodedata.category(chr(c))[0] == "L":
            letter[c] = True
            low = chr(c).lower()
            if len(low) == 1:
                lower[c] = ord(low)
    bounds = np.array([a for a, _ in SCRIPTS])
    names = np.array([SCRIPT_NAMES.index(x) for _, x in SCRIPTS], np.int8)
    return letter, lower, names[np.searchsorted(bounds, np.arange(n), side="right") - 1]


class Words:
    """The words (runs of letters) of some texts, as code points with their trigrams."""

    def __init__(self, texts: list[str]):
        letter, lower, script = _tables()
        off = np.cumsum([0] + [len(t) + 1 for t in texts])
        cp = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
        is_letter = letter[cp]
        edge = np.diff(np.concatenate([[0], is_letter.view(np.int8), [0]]))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.range = np.searchsorted(self.start, off)
        self.off = off
        at = np.flatnonzero(is_letter)
        low = np.where(is_letter, lower[cp], 0).astype(np.uint64)
        padded = np.concatenate([[np.uint64(0)], low, [np.uint64(0)]])
        gram = (padded[at] * np.uint64(0x9E3779B1) + padded[at + 1]) * np.uint64(0x85EBCA77) \
            + padded[at + 2]
        self.gram = (mix(gram) & np.uint64(BUCKETS - 1)).astype(np.int32)
        self.first = np.searchsorted(at, self.start)  # of a word's trigrams
        self.letter_script = script[cp[at]]
        self.script = self.letter_script[self.first]

    def rows_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.range))


def fit_language(docs: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Learn from documents outside the held-out fold that have a lang, ``fit_rows`` at most.

    Trigrams and scripts are counted in the tasks and summed by Spark; what
    comes back is bounded by languages x buckets. Without such documents
    nothing is learned and every prediction is ``und``.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.col("lang").cast("string").alias("lang")) \
        .where("doc_id IS NOT NULL AND lang IS NOT NULL").where(fold(F.col("doc_id")) != 0)
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id") \
        .limit(fit_rows)

    def count(batches):
        for b in slices(batches):
            w = Words(b.column("text").to_pylist())
            langs = b.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            of_letter = np.repeat(number[w.rows_of_words()], w.end - w.start)
            grams, n = np.unique(of_letter * np.int64(BUCKETS) + w.gram, return_counts=True)
            script, m = np.unique(of_letter * np.int64(64) + w.letter_script, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([names[i] for i in [*(grams // BUCKETS), *(script // 64)]], pa.string()),
                pa.array(np.concatenate([grams % BUCKETS, BUCKETS + script % 64])),
                pa.array(np.concatenate([n, m]).astype(np.int64))], ["lang", "what", "n"])
    found = rows.join(F.broadcast(chosen), "doc_id", "left_semi") \
        .mapInArrow(count, "lang string, what bigint, n bigint") \
        .groupBy("lang", "what").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    grams = np.zeros((BUCKETS, len(langs)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(langs)))
    for i, lang in enumerate(langs):
        part = found[found["lang"] == lang]
        is_gram = (part["what"] < BUCKETS).to_numpy()
        what, n = part["what"].to_numpy(), part["n"].to_numpy()
        grams[what[is_gram], i] = n[is_gram]
        scripts[what[~is_gram] - BUCKETS, i] = n[~is_gram]
    p = np.log((grams + SMOOTH) / (grams + SMOOTH).sum(0)) if langs else grams
    own = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    own[~own.any(1)] = True  # a script that no language has narrows nothing
    return {"langs": langs, "logp": p.astype(np.float32),
            "bar": np.where(own, 0, -50).astype(np.float32)}


def label_words(model: dict, w: Words, switch: float = SWITCH) -> np.ndarray:
    """The language number of each word: the best path of each text, ties to the first language."""
    n, langs = len(w.start), len(model["langs"])
    label = np.zeros(n, np.int32)
    if not n:
        return label
    score = np.add.reduceat(model["logp"][w.gram], w.first, axis=0) + model["bar"][w.script]
    count = np.diff(w.range)
    order = np.argsort(-count, kind="stable")
    first, count = w.range[:-1][order], count[order]
    stay = np.ones((n, langs), bool)
    jump = np.zeros(n, np.int32)
    active = int((count > 0).sum())
    best = score[first[:active]].copy()
    for t in range(1, int(count[0])):  # all texts that have a word t, side by side
        active = int(np.searchsorted(-count, -t))
        best, at = best[:active], first[:active] + t
        top = best.argmax(1)
        best = best - best[np.arange(active), top][:, None]
        jump[at] = top
        stay[at] = best >= -switch
        np.maximum(best, -switch, out=best)
        best = best + score[at]
        label[at] = best.argmax(1)  # of the path that would end here
    one = first[:int((count > 0).sum())]
    label[one[count[:len(one)] == 1]] = score[one[count[:len(one)] == 1]].argmax(1)
    for t in range(int(count[0]) - 1, 0, -1):
        active = int(np.searchsorted(-count, -t))
        at = first[:active] + t
        label[at - 1] = np.where(stay[at, label[at]], label[at], jump[at])
    return label


def _lang_rows(model: dict, texts: list[str]):
    """(prediction, score, spans) of each text."""
    langs = model["langs"]
    w = Words(texts)
    if not langs:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    label = label_words(model, w)
    letters = w.end - w.start
    row = w.rows_of_words()
    weight = np.zeros((len(texts), len(langs)))
    np.add.at(weight, (row, label), letters)
    new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (row[1:] != row[:-1])])
                         ) if len(row) else np.empty(0, np.int64)
    last = np.append(new[1:], len(row))[:len(new)] - 1
    bound = np.searchsorted(row[new], np.arange(len(texts) + 1)) if len(row) else \
        np.zeros(len(texts) + 1, np.int64)
    out = []
    for i in range(len(texts)):
        total = weight[i].sum()
        if not total:
            out.append((UNKNOWN, 0.0, []))
            continue
        k = int(weight[i].argmax())
        spans = [{"start": int(w.start[a] - w.off[i]), "end": int(w.end[z] - w.off[i]),
                  "lang": langs[label[a]]}
                 for a, z in zip(new[bound[i]:bound[i + 1]], last[bound[i]:bound[i + 1]])]
        out.append((langs[k], float(weight[i, k] / total), spans))
    return out


def language_spans(docs: DataFrame, model: dict, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, spans.

    ``spans`` are the stretches of one language (start and end in code points,
    end exclusive, from the first word's start to the last one's end);
    ``lang_pred`` is the language with the most letters, ``score`` its share of
    them. Null, empty and letterless texts give ``und``, 0 and no spans. Ties go
    to the language that sorts first. A null doc_id is kept, held_out false;
    repeated rows give equal rows. Other columns, lang and source among them,
    are never looked at.
    """
    def run(batches):
        for b in slices(batches):
            rows = _lang_rows(model, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))],
                ["doc_id", "lang_pred", "score", "spans"])
    out = text_only(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, "
             "spans array<struct<start: int, end: int, lang: string>>")
    return out.select("doc_id",
                      F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "spans")


def op8_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_spans(docs, fit_language(docs)).withColumn(
        "n_spans", F.size("spans")).drop("spans")


QUERIES = {"op8_language": op8_language}
ORACLES = {}
