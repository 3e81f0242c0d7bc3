"""Quality classifier: held-out accuracy, the fold, the pairwise loss, odd rows."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import quality as Q
from ledgerline.llm.common import table, text_bytes

SF01 = "/root/testdata/sf0.01"

SCHEMA = "doc_id bigint, text string, score string, predicted string, features string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "p", "f") for i, t in rows], SCHEMA)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    got = Q.op10_quality(spark, SF01)
    assert got.count() == docs.count()
    judged = got.where("held_out").join(labels, "doc_id").where("quality IS NOT NULL")
    right = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.97
    for r in got.select("doc_id", "held_out", "score", "predicted").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    turned = labels.withColumn("quality", F.when(Q.fold(F.col("doc_id")) == 0, 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = Q.fit_quality(docs, labels), Q.fit_quality(docs, turned)
    assert np.array_equal(a["w"], b["w"]) and a["threshold"] == b["threshold"]


def test_pairwise_weights_order_the_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 2] > 0.2).astype(int)
    model = Q.fit_bradley_terry(x, y, pairs=5_000)
    s = Q.score(model, x)
    assert ((s >= Q.ACCEPT) == y).mean() > 0.97
    assert s[y == 1].min() > np.quantile(s[y == 0], 0.9)


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["", "One two. Two!", "é è | 12", " ", "word " * 20_000, "One two. Two!"]
    whole = Q.text_features(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], Q.text_features(*text_bytes(pa.array([t])))[0])


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (5, "b c " * 50_000)]
    df = frame(spark, rows)
    model = Q.fit_bradley_terry(np.eye(len(Q.FEATURES)), np.arange(len(Q.FEATURES)) % 2, pairs=100)
    got = Q.quality_scores(df, model).collect()
    assert len(got) == len(rows)
    score = {}
    for r in got:
        score.setdefault(r.doc_id, set()).add(r.score)
    assert score[1] == score[2] and len(score[3]) == 1 and score[3] == score[None]
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert Q.quality_scores(df.limit(0), model).count() == 0
    assert Q.keep_quality(df, model).schema == df.schema


def test_no_labels_reject_nothing(spark):
    df = frame(spark, [(1, None), (2, "a b")])
    empty = spark.createDataFrame([], "doc_id bigint, quality int")
    nulls = spark.createDataFrame([(1, None), (None, 1), (2, 7)], "doc_id bigint, quality int")
    for labels in (empty, nulls):
        model = Q.fit_quality(df, labels)
        assert Q.keep_quality(df, model).count() == 2
        assert all(r.predicted == 1 for r in Q.quality_scores(df, model).collect())


def test_copies_of_a_labelled_id_are_one_row_for_the_fit(spark, monkeypatch):
    """However often a labelled id stands in the documents, ``fit_rows`` bounds what is collected."""
    seen = []
    real = Q.fit_bradley_terry
    monkeypatch.setattr(Q, "fit_bradley_terry", lambda x, y: seen.append(len(x)) or real(x, y))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5][:12]
    copies = spark.range(100_000).select(F.lit(ids[0]).alias("doc_id"), F.lit("the same text again.").alias("text"))
    docs = copies.unionByName(spark.createDataFrame([(i, f"text {i} of some words.") for i in ids], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id bigint, quality int")
    Q.fit_quality(docs, labels, fit_rows=10)
    assert seen == [10]
