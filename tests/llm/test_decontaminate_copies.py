"""Several re-parameterised copies of one item in one document."""

import pyarrow as pa
import pytest

from ledgerline.llm.common import text_bytes
from ledgerline.llm.decontaminate import Items

ITEM = ("A shop has 12 red, 15 blue, 18 green and 21 black pens; 24 children take 27 of them, "
        "then 30 more come and 33 pens are left, how many were sold?")
VALUES = (12, 15, 18, 21, 24, 27, 30, 33)


def variant(n, text=ITEM):
    for at, v in enumerate(VALUES):
        text = text.replace(str(v), f"{n}0{at}", 1)
    return text


def hits(texts, item=ITEM):
    return Items([7], [item], 5).hits(*text_bytes(pa.array(texts)), 0.8, 13, 8)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 200])
def test_copies_with_other_values(n):
    got = hits(["\n".join(variant(j) for j in range(1, n + 1))])
    assert [(h[0], h[2] == h[3]) for h in got] == [(0, True)]


def test_copy_among_its_own_windows():
    """A verbatim item in a long text that has its windows with other numbers more often."""
    parts = [" ".join(variant(j).split()[at:at + 9]) + " and so on elsewhere."
             for j in range(1, 60) for at in (0, 4, 8, 12, 16, 20)]
    got = hits([" ".join([*parts, ITEM, *parts])])
    assert [(h[0], h[2] == h[3]) for h in got] == [(0, True)]


def test_copies_with_a_word_put_in():
    """Each copy lies on two diagonals, neither of them a long run."""
    item = ("a shop has 12 red and 15 blue pens when 18 "
            "children take 12 of all and 15 more come to buy 18 pens")
    for n in (1, 2, 5):
        copies = []
        for j in range(1, n + 1):
            text = item.replace("children take", "children now take")
            for v in (12, 15, 18):
                text = text.replace(str(v), f"{j}{v}00")
            copies.append(text)
        got = hits(["\n".join(copies)], item)
        assert [h[0] for h in got] == [0] and got[0][4] < 13, n


def test_inconsistent_copy_is_none():
    """One value of the item with another value at each of its places."""
    item = " ".join(f"word{j} goes 5 to" for j in range(12))
    text = " ".join(f"word{j} goes {j + 100} to" for j in range(12))
    assert hits([text, item.replace("5", "77")], item)[0][0] == 1
    assert len(hits([text], item)) == 0
