"""The corpus pipeline: every stage against a plain reading of its rule, and odd tables."""

import pytest

import corpus_pipeline as C
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.decontaminate import contaminated
from ledgerline.llm.near_dedup import near_duplicates
from ledgerline.llm.quality import fit_quality, quality_scores

SF01 = "/root/testdata/sf0.01"


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it kept, over the whole table."""
    docs, out = table(spark, SF01, "documents"), []
    for name, stage in C.STAGES:
        kept = C.cut(stage(spark, docs, SF01), f"test-{name}")
        out.append((name, docs, kept))
        docs = kept
    return {name: (before, after) for name, before, after in out}


def test_stages_return_the_columns_of_documents(spark, stages):
    columns = table(spark, SF01, "documents").columns
    assert [n for n, _ in C.STAGES] == list(stages)
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    model = fit_quality(before, table(spark, SF01, "labels"))
    assert ids(after) == ids(quality_scores(before, model).where("predicted = 1"))
    judged = table(spark, SF01, "labels").where("quality IS NOT NULL").select("doc_id", "quality")
    good = judged.where("quality = 1")
    lost = good.join(after, "doc_id", "left_anti").join(before, "doc_id", "left_semi").count()
    assert lost <= 0.02 * good.count()


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    last = {}
    for r in before.select("doc_id", "text").collect():
        last[r.text or ""] = max(last.get(r.text or "", r.doc_id), r.doc_id)
    assert ids(after) == sorted(last.values())


def test_near_stage(stages):
    before, after = stages["near_dedup"]
    assert ids(after) == ids(near_duplicates(before).where("kept"))
    assert 0 < after.count() < before.count()


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    leaks = {r.doc_id for r in contaminated(before, table(spark, SF01, "benchmark")).collect()}
    assert ids(after) == [i for i in ids(before) if i not in leaks]
    whole = [r.text for r in table(spark, SF01, "benchmark").collect()]
    assert not [r.doc_id for r in after.collect() if any(t in (r.text or "") for t in whole)]


def test_pieces_stage(stages):
    before, after = stages["pieces"]
    text = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == len(text)
    for r in rows:
        assert r.decoded == text[r.doc_id] and r.n_tokens == len(r.ids or [])


def test_empty_and_null_tables(spark):
    docs = table(spark, SF01, "documents")
    empty = docs.limit(0)
    nulls = spark.createDataFrame([(None,) * len(docs.columns)] * 2 + [(3, *[None] * (len(docs.columns) - 1))],
                                  docs.schema)
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF01).count() == 0
        got = stage(spark, nulls, SF01)
        # null texts are scored like empty ones by quality, are one group of copies for
        # exact_dedup, and stay in every other stage
        want = {"exact_dedup": 1, "quality": 3 if quality_of_empty(spark, stage) else 0}.get(name, 3)
        assert got.count() == want, name


def quality_of_empty(spark, stage):
    docs = table(spark, SF01, "documents")
    one = docs.limit(1).withColumn("text", F.lit(""))
    return stage(spark, one, SF01).count()


def test_clashing_column_names(spark):
    """Columns named like the stages' own ones, and one without an order, change nothing."""
    docs = table(spark, SF01, "documents").where("doc_id < 300")
    names = ["_gone", "ids", "decoded", "component", "digest", "spans", "_row", "_text", "score", "features",
             "_order", "gram", "item_id", "quality"]
    more = docs.withColumns({n: F.lit("x") for n in names}).withColumn(
        "m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name, stage in C.STAGES:
        plain, odd = stage(spark, docs, SF01), stage(spark, more, SF01)
        assert ids(odd) == ids(plain), name
        if name != "pieces":
            assert odd.columns == more.columns and odd.where("_gone = 'x' AND m['k'] = doc_id").count() == plain.count()


def test_phrases_of_a_few_words_remove_nothing(spark, tmp_path):
    """An item of fewer words than the stated least removes no document, a longer one does."""
    items = [(1, "yes"), (2, "Name it now"), (3, "Which river runs past the old mill of Ersatz?")]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(
        [(1, "yes, name it now."), (2, "so: " + items[2][1] + " yes"), (3, None)], "doc_id bigint, text string")
    assert ids(C.decontamination_stage(spark, docs, str(tmp_path))) == [1, 3]
