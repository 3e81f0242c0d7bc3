"""Template windows: copies, re-parameterised items, inconsistent slots, clean texts."""

import pyarrow as pa

from ledgerline.llm.common import text_bytes
from ledgerline.llm.decontaminate import Items

ITEM = ("Tom Baker has 12 apples and 3.5 pears in a wooden basket. He gives Mary 12 apples, "
        "how many apples does Tom Baker keep after 2 hours of walking home?")


def found(texts):
    hits = Items([7], [ITEM], 5).hits(*text_bytes(pa.array(texts)), 0.8, 13, 8)
    return {h[0] for h in hits}


def test_leaks_and_clean_texts():
    new = ITEM.replace("Tom Baker", "Alice").replace("12", "40").replace("3.5", "7")
    texts = [ITEM, "foo bar. " + new, ITEM.upper(), ITEM.lower(), "",
             "the same words in a wooden basket and nothing else to see here at all", "a " * 1000]
    assert found(texts) == {0, 1, 2, 3}
    assert found([""]) == set()
