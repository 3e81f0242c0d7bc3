"""The keyword prefilter of the license rules drops no detection."""

import random
from re import _parser

import pytest

from ledgerline.llm import licenses as L


def sample(parsed, pick):
    """One string of an expression, by random choices."""
    out = ""
    for op, arg in parsed:
        if op is _parser.LITERAL:
            out += chr(arg)
        elif op is _parser.IN:
            kind, value = pick.choice(arg)
            out += chr(value if kind is _parser.LITERAL else pick.randint(*value))
        elif op is _parser.BRANCH:
            out += sample(pick.choice(arg[1]), pick)
        elif op is _parser.SUBPATTERN:
            out += sample(arg[3], pick)
        elif op is _parser.MAX_REPEAT:
            out += "".join(sample(arg[2], pick) for _ in range(pick.randint(arg[0], arg[1])))
        else:
            assert op in (_parser.ASSERT, _parser.ASSERT_NOT), op
    return out


def test_every_rule_with_and_without():
    pick = random.Random(5)
    for rule in L.rules():
        parsed = _parser.parse(rule.pattern.pattern)
        for text in {sample(parsed, pick) for _ in range(40)}:
            for line in (f" {text} ", f" x {text} y "):
                assert rule.pattern.search(line), (rule.label, text)
                for keywords in rule.keywords:
                    assert any(k in line for k in keywords), (rule.label, text)
                assert L.detections(line) == L.detections(line, prefilter=False) != [], text


@pytest.mark.parametrize("text,label", [
    ("SPDX-License-Identifier: BSL-1.0", "boost-1"), ("SPDX-License-Identifier: PSF-2.0", "psf-2"),
    ("Released under Creative Commons Zero", "cc0"), ("Creative Commons Zero license", "cc0"),
    ("see FreeBSD", "bsd-2"), ("the 0BSD text", "0bsd"), ("uses zlib here", "zlib"), ("MPL2", "mpl-2"),
    ("EPL2", "epl-2"), ("EUPL1 2", "eupl-1.2"), ("is in the Artistic License 2.0", "artistic-2")])
def test_labels_need_no_other_words(text, label):
    assert label in L.scan(text)["labels"].split(",")


def test_keywords_of_expressions():
    assert L._keywords(" (?:ab|c) d") == {" ab d", " c d"}
    assert L._keywords("(?:ab|cd)?x ?yz") == {"yz"}
    assert L._keywords("[ab]?") == {""}
    with pytest.raises(ValueError):
        L._keywords("ab*")
