"""Exact deduplication against brute force: odd rows, hot groups, colliding digests."""

import hashlib

from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup as E

SCHEMA = "doc_id bigint, text string, digest string, keep_id string, salt string, _row string"
ROWS = [(1, "a b"), (2, "a b"), (3, "A b"), (4, "a b "), (5, None), (6, ""), (7, None),
        (8, "é́"), (9, "é́"), (10, "x" * 100_000), (11, "x" * 100_000),
        (12, "x" * 99_999), (12, "dup"), (12, "dup"), (None, "dup"), (None, "lone")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", "k", "s", "r") for i, t in rows], SCHEMA)


def brute(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        keep = max((j for j in same if j is not None), default=None)
        out.append((i, keep, len(same), i is not None and i == keep,
                    hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    return sorted(map(tuple, E.exact_duplicates(df, **kw).collect()), key=str)


def test_equals_brute_force(spark):
    assert found(frame(spark, ROWS)) == brute(ROWS)


def test_colliding_digests_compare_whole_texts(spark):
    same = lambda c: F.lit("one")
    assert found(frame(spark, ROWS), digest=same) == brute(ROWS)
    short = lambda c: F.substring(c, 1, 1)
    assert found(frame(spark, ROWS), digest=short, salts=1) == brute(ROWS)


def test_one_text_in_a_third_of_all_rows(spark):
    df = spark.range(30_000, numPartitions=16).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = E.exact_duplicates(df)
    hot = got.where("group_size > 1").agg(
        F.count("*"), F.min("keep_id"), F.max("keep_id"), F.min("group_size")).first()
    assert tuple(hot) == (10_000, 29_997, 29_997, 10_000)
    assert got.where("kept").count() == 20_001


def test_kept_rows_keep_their_columns(spark):
    df = frame(spark, ROWS)
    kept = E.drop_exact_duplicates(df)
    assert kept.schema == df.schema
    rows = kept.collect()
    assert len(rows) == len({t or "" for _, t in ROWS})
    by_text = {r.text or "": r for r in rows}
    assert by_text["a b"].doc_id == 2 and by_text["dup"].doc_id == 12 and by_text[""].doc_id == 7
    assert by_text[""].text is None and by_text["lone"].doc_id is None
    assert {r._row for r in rows} == {"r"}


def test_empty_table(spark):
    empty = frame(spark, ROWS).limit(0)
    assert found(empty) == []
    assert E.drop_exact_duplicates(empty).count() == 0
