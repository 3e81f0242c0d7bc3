"""License scans over tables: base places against a plain reading, and odd rows."""

import re

from ledgerline.llm import licenses as L
from ledgerline.llm.common import table

SF01 = "/root/testdata/sf0.01"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
           "cc by nc": "cc-by-nc"}


def plain(text):
    """(words, base places, first, last, base labels) of a text."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
          if words[i:i + len(phrase.split())] == phrase.split()]
    where = [i for i, _ in at]
    return (len(words), len(at), min(where, default=None), max(where, default=None),
            ",".join(sorted({label for _, label in at})))


def test_base_places_of_whole_table(spark):
    text = {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}
    got = L.op7_license_scan(spark, SF01).collect()
    assert len(got) == len(text)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text[r.doc_id])
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(labels)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "Under the MIT-License"), (3, "Under the MIT-License"),
            (None, "cc by nc cc by nc"), (5, "word " * 60_000 + "apache license version 2")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows],
                               "doc_id bigint, text string, labels string, spans string")
    got = L.license_scan(df).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                    for r in got), key=str)
    assert found == sorted(((i, *plain(t)) for i, t in rows), key=str)
    assert {r.score for r in got if r.doc_id in (1, 2)} == {0.0}
    assert L.license_scan(df.limit(0)).count() == 0
