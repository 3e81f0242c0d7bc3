"""Decontamination over tables: against a plain reading of the rule, and odd rows."""

import re
from collections import Counter

from ledgerline.llm import decontaminate as D
from ledgerline.llm.common import table

SF01 = "/root/testdata/sf0.01"
ITEM = ("Tom Baker has 12 apples and 3.5 pears in a wooden basket. He gives Mary 12 apples, "
        "how many apples does Tom Baker keep after 2 hours of walking home?")
UPPER = {chr(c): chr(c + 32) for c in [*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]}
WORD = re.compile(r"(?:[0-9A-Za-z\x80-\U0010ffff]|(?<=[0-9])[.,](?=[0-9]))+")


def tokens(text, names):
    """(token, class or '', lower-cased words) with neighbouring placeholders of a class merged."""
    out, before = [], None
    for m in WORD.finditer(text):
        w = m.group()
        low = "".join(UPPER.get(c, c) for c in w)
        kind = ""
        if w[0].isascii() and w[0].isdigit() or low in D.NUMBERS:
            kind = "num"
        elif low in D.UNITS:
            kind = "unit"
        elif (names and before is not None and w[0] in UPPER and len(w) > 1
              and not (w[1].isascii() and w[1].isupper())
              and not re.search(r"[.!?\n]", text[before:m.start()])):
            kind = "name"
        if kind and out and out[-1][1] == kind:
            out[-1] = (out[-1][0], kind, (*out[-1][2], low))
        else:
            out.append((f"<{kind}>" if kind else low, kind, (low,)))
        before = m.end()
    return out


def leaks(doc, item, k=D.WINDOW):
    """Does a text leak an item, by either view of names?"""
    for names in (True, False):
        d, it = tokens(doc, names), tokens(item, names)
        n = len(it) - k + 1
        at = {}
        for i in range(len(d) - k + 1):
            at.setdefault(tuple(t[0] for t in d[i:i + k]), []).append(i)
        pairs = [(x, i) for i in range(n) for x in at.get(tuple(t[0] for t in it[i:i + k]), [])]
        seen = Counter()
        for x, i in pairs:
            for j in range(k):
                if it[i + j][1] in ("num", "name"):
                    seen[tuple(sorted(it[i + j][2])), tuple(sorted(d[x + j][2]))] += 1
        best = {}
        for (a, b), c in seen.items():
            best[a] = max(best.get(a, (0, None)), (c, b))
        good = [(x, i) for x, i in pairs if all(
            it[i + j][1] not in ("num", "name")
            or best[tuple(sorted(it[i + j][2]))][1] == tuple(sorted(d[x + j][2])) for j in range(k))]

        def literals(starts):
            return sum(it[p][1] == "" for p in {i + j for i in starts for j in range(k)})
        matched = {i for _, i in good}
        if n > 0 and matched and len(matched) >= D.COVERAGE * n and literals(matched) >= D.LITERALS:
            return True
        have = set(good)
        for x, i in good:
            if (x - 1, i - 1) not in have:
                run = [i]
                while (x + len(run), i + len(run)) in have:
                    run.append(i + len(run))
                if len(run) + k - 1 >= D.RUN and literals(run) >= D.LITERALS:
                    return True
    return False


def test_whole_tables_against_a_plain_reading(spark):
    docs, items = table(spark, SF01, "documents"), table(spark, SF01, "benchmark")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()}
    held = [(r.item_id, r.text) for r in items.collect() if r.text]
    grams = {}  # an item is only looked at beside texts with one of its windows
    for i, t in held:
        for names in (True, False):
            tok = [x[0] for x in tokens(t, names)]
            for j in range(len(tok) - D.WINDOW + 1):
                grams.setdefault(tuple(tok[j:j + D.WINDOW]), set()).add(i)
    text = dict(held)
    want = set()
    for r in docs.collect():
        near = Counter()
        for names in (True, False):
            tok = [x[0] for x in tokens(r.text or "", names)]
            for g in {tuple(tok[j:j + D.WINDOW]) for j in range(len(tok) - D.WINDOW + 1)}:
                near.update(grams.get(g, ()))
        want |= {(r.doc_id, i) for i in near if leaks(r.text, text[i])}
    assert got == want and want


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, item_id string, n_windows string"
    rows = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (None, ITEM), (4, "word " * 100_000 + ITEM),
            (5, "nothing of the kind")]
    docs = spark.createDataFrame([(*r, "i", "n") for r in rows], schema)
    items = spark.createDataFrame(
        [(7, ITEM, "x"), (7, ITEM, "x"), (8, None, "x"), (None, ITEM, "x"), (9, "too short", "x")],
        "item_id bigint, text string, doc_id string")
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated(docs, items).collect()), key=str)
    assert got == sorted([(1, 7), (4, 7), (None, 7)] * 2 + [(1, 7)] * 2, key=str)
    kept = D.drop_contaminated(docs, items)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert D.contaminated(docs.limit(0), items).count() == 0
    assert D.contaminated(docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ITEM), (2, "x")], "doc_id bigint, text string")
    items = spark.createDataFrame([(i, ITEM.replace("basket", f"basket{i}")) for i in range(9)],
                                  "item_id bigint, text string")
    whole = sorted(map(tuple, D.contaminated(docs, items).collect()))
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert sorted(map(tuple, D.contaminated(docs, items).collect())) == whole and len(whole) == 9


def test_one_item_id_in_many_rows_stays_within_a_block(spark, monkeypatch):
    """Blocks are dealt by rows: thousands of rows of one id are spread over them, and all are found."""
    monkeypatch.setattr(D, "BLOCK_BYTES", 20_000)
    rows = [(7, f"number {i} of the questions about the long river {i * 7} asks how deep it is") for i in range(1000)]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    sizes = [len(b.ids) for b in D._blocks(items, "item_id", "text", D.WINDOW)]
    assert sum(sizes) == 1000 and len(sizes) > 2 and max(sizes) <= 1000 // len(sizes) + 20
    docs = spark.createDataFrame([(1, rows[3][1]), (2, "nothing of the kind")], "doc_id bigint, text string")
    assert D.contaminated(docs, items).select("doc_id").distinct().collect()[0][0] == 1
