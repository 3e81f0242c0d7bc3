"""License scans: base places, labels, suppression, odd texts."""

from ledgerline.llm import licenses as L


def test_given_lines():
    assert L.scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by-nc"
    got = L.scan("Released under the MIT License.")
    assert (got["n_words"], got["n_base"], got["first_word"], got["labels"]) == (5, 1, 1, "mit")
    assert L.scan("This work is licensed under the GNU General Public License, version 3."
                  )["labels"] == "gpl-3"
    got = L.scan("Apache License, Version 2.0 x apache license version 2")
    assert (got["n_base"], got["first_word"], got["last_word"]) == (2, 0, 6)


def test_contained_detection_is_dropped():
    assert [s["label"] for s in L.scan("Licensed under the MIT license")["spans"]] == ["mit"]


def test_odd_texts():
    for text in ("", " ", "!!", "mit der Bahn", "é"):
        got = L.scan(text)
        assert (got["n_base"], got["labels"], got["score"], got["first_word"]) == (0, "", 0.0, None)
    assert L.scan("word " * 50_000)["n_words"] == 50_000
    assert len(L.rules()) > 200
