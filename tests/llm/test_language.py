"""Language ID: held-out accuracy, mixed texts, the Viterbi pass, odd rows."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from ledgerline.llm import language as L
from ledgerline.llm.common import table

SF01 = "/root/testdata/sf0.01"

SCHEMA = "doc_id bigint, text string, lang string, lang_pred string, spans string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "s") for r in rows], SCHEMA)


def test_held_out_accuracy(spark):
    docs = table(spark, SF01, "documents")
    got = L.op8_language(spark, SF01)
    assert got.count() == docs.count()
    judged = got.where("held_out AND lang_pred <> 'und'").join(
        docs.where("lang IS NOT NULL").select("doc_id", "lang"), "doc_id")
    assert judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


def test_mixed_text_has_a_span_for_each_language(spark):
    docs = table(spark, SF01, "documents")
    model = L.fit_language(docs)
    one = docs.where("length(text) BETWEEN 200 AND 600 AND lang IS NOT NULL") \
        .groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).orderBy("lang").limit(2).collect()
    text = one[0].text + " " + one[1].text
    cut = len(one[0].text)
    (_, score, spans), = L._lang_rows(model, [text])
    assert 0 < score < 1
    share = sum(max(0, min(s["end"], cut) - s["start"]) for s in spans if s["lang"] == one[0].lang)
    assert share > 0.8 * cut
    assert sum(s["end"] - max(s["start"], cut) for s in spans
               if s["lang"] == one[1].lang and s["end"] > cut) > 0.8 * len(one[1].text)


def test_labels_are_the_best_path():
    """Brute force over all label sequences of short texts."""
    rng = np.random.default_rng(3)
    model = {"langs": ["a", "b", "c"],
             "logp": rng.normal(size=(L.BUCKETS, 3)).astype(np.float32) * 2,
             "bar": np.zeros((len(L.SCRIPT_NAMES), 3), np.float32)}
    texts = ["one", "", "un deux trois", "x y z w v", "ab cd", "aa bb cc dd ee ff"]
    w = L.Words(texts)
    got = L.label_words(model, w, switch=1.5)
    score = np.add.reduceat(model["logp"][w.gram], w.first, axis=0).astype(float)
    for i in range(len(texts)):
        a, b = w.range[i], w.range[i + 1]

        def total(path):
            return sum(score[a + j, x] for j, x in enumerate(path)) \
                - 1.5 * sum(x != y for x, y in zip(path, path[1:]))
        if b > a:
            best = max(map(total, itertools.product(range(3), repeat=b - a)))
            assert np.isclose(total(got[a:b].tolist()), best, atol=1e-4)


def test_odd_rows(spark):
    rows = [(1, None, "aa"), (2, "", "aa"), (4, "12 !?", "aa"), (6, "hello there friend", "aa"),
            (7, "привет дорогой друг", "bb"), (8, "привет друг", None), (None, "hello", "aa"),
            (9, "hello there", None), (9, "hello there", None), (10, "дорогой " * 40_000, None)]
    df = frame(spark, rows)
    model = L.fit_language(df)
    got = L.language_spans(df, model).collect()
    assert len(got) == len(rows)
    pred = {}
    for r in got:
        pred.setdefault(r.doc_id, set()).add(r.lang_pred)
        assert 0 <= r.score <= 1
    assert all(pred[i] == {"und"} for i in (1, 2, 4))
    learned = set(model["langs"])
    assert learned <= {"aa", "bb"} and learned
    assert all(len(p) == 1 for p in pred.values())
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert L.language_spans(df.limit(0), model).count() == 0


def test_nothing_learned_predicts_und(spark):
    df = frame(spark, [(1, "hello", None), (2, "there", None)])
    for docs in (df, df.limit(0)):
        model = L.fit_language(docs)
        assert model["langs"] == []
        assert {r.lang_pred for r in L.language_spans(df, model).collect()} == {"und"}


def test_three_hundred_languages(spark):
    """No number of languages wraps around: each is told by its own words."""
    def words(k):
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        return [alphabet[k % 26] + alphabet[k // 26 % 26] + alphabet[(k * 7 + j) % 26] * 2
                + alphabet[(k // 3 + j) % 26] for j in range(6)]
    rows = [(k + 300 * c, " ".join(words(k) * 3), f"l{k:03d}") for k in range(300) for c in range(8)]
    df = frame(spark, rows)
    model = L.fit_language(df)
    assert len(model["langs"]) == 300
    got = L.language_spans(df, model).join(
        df.select("doc_id", F.col("lang").alias("true")), "doc_id")
    wrong = got.where(F.col("lang_pred") != F.col("true")).select("true").distinct().count()
    assert wrong == 0
