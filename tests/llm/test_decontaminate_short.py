"""Items with few literal words, and items shorter than a window."""

import pyarrow as pa
import pytest

from ledgerline.llm import decontaminate as D
from ledgerline.llm.common import text_bytes


def hits(texts, items):
    got = D.Items(list(range(len(items))), items, 5).hits(*text_bytes(pa.array(texts)), 0.8, 13, 8)
    return {(h[0], h[1]) for h in got}


SHORT = ["What is 15 percent of 80?", "Who wrote Hamlet in 1601?", "Compute 12 * 30.", "Name it",
         "Is 7 prime? Is 9 prime? Is 11 prime? Is 13 prime?", "What is 6 times 7 plus 8 times 9 minus 5?",
         "3 kg and 4 kg and 5 kg and 6 kg and 7 kg and 8 kg are how much?", "Höhe?"]


@pytest.mark.parametrize("item", SHORT)
def test_copies_are_found(item):
    texts = [item, f"Some text before. 1. {item} 42 and after", item.lower(), item.upper(),
             f"9 {item}\n{item}", "word " * 3000 + item]
    assert hits(texts, [item]) == {(n, 0) for n in range(len(texts))}


def test_all_together_and_only_their_own():
    assert hits(SHORT, SHORT) == {(n, n) for n in range(len(SHORT))}


def test_other_values_are_no_copy():
    texts = ["What is 16 percent of 80?", "What is 15 percent of 81?", "What is 15 dollars of 80?",
             "who wrote Faust in 1601?", "who wrote Hamlet in 1602?", "Compute 12 * 31.", "Compute 112 * 30",
             "name of it", "rename it", "what is 15 percent of", "", "percent of 80 what is 15",
             "What is 6 times 7 plus 8 times 9 minus 4?"]
    assert hits(texts, SHORT) == set()


def test_words_do_not_cross_rows():
    assert hits(["What is 15", "percent of 80?", "Name", "it"], SHORT) == set()


def test_tables(spark):
    docs = spark.createDataFrame([(1, "x. " + SHORT[0]), (2, "nothing"), (3, None), (4, "so Name it!")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame(
        [*enumerate(SHORT[:4]), (90, ""), (91, None), (92, " ?! ")], "item_id bigint, text string")
    got = sorted(tuple(r) for r in D.contaminated(docs, items).collect())
    assert [r[:2] for r in got] == [(1, 0), (4, 3)] and got[1][2:] == (0, 0, 2)
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, items).collect()) == [2, 3]
