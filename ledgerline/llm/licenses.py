"""License scans by ordered signature rules.

A text becomes a sequence of lower-case words. Hundreds of rules, built from
license names and phrasings, are regular expressions over that sequence. A rule
is tried only on texts that contain one of its keywords; those are read off its
expression, so that each of its matches contains one. Rules have a priority; a
detection that lies inside the interval of one that ranks higher is dropped.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, table, text_only

# fixed values: the base phrases and their labels
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
           "cc by nc": "cc-by-nc"}

# fixed values: label, what the license is called, its SPDX id as words
LICENSES = [
    ("mit", r"mit", r"mit"),
    ("mit-0", r"mit no attribution|mit 0", r"mit 0"),
    ("apache-1.1", r"apache(?: software)?(?: license)?(?: version| v)? 1 1", r"apache 1 1"),
    ("apache-2", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?", r"apache 2 0"),
    ("bsd-2", r"(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)", r"bsd 2 clause"),
    ("bsd-3", r"(?:bsd 3 clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)", r"bsd 3 clause"),
    ("bsd-4", r"(?:bsd 4 clause|(?:4|four) clause bsd|original bsd)", r"bsd 4 clause"),
    ("0bsd", r"(?:0bsd|(?:0|zero) clause bsd|bsd zero clause)", r"0bsd"),
    ("bsd", r"bsd", r"bsd"),
    ("isc", r"isc", r"isc"),
    ("zlib", r"zlib(?: libpng)?", r"zlib"),
    ("boost-1", r"boost software(?: license)?(?: version| v)?(?: 1 0)?", r"bsl 1 0"),
    ("gpl-1", r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?1(?: 0)?", r"gpl 1 0(?: only| or later)?"),
    ("gpl-2", r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?2(?: 0)?", r"gpl 2 0(?: only| or later)?"),
    ("gpl-3", r"(?:gnu )?(?:general public license|gpl)(?: version| v)? ?3(?: 0)?", r"gpl 3 0(?: only| or later)?"),
    ("gpl", r"(?:gnu )?(?:general public license|gpl)", r"gpl"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-2", r"(?:gnu )?(?:library general public license|lgpl)(?: version| v)? ?2(?: 0)?", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-3", r"(?:gnu )?(?:lesser general public license|lgpl)(?: version| v)? ?3(?: 0)?", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", r"(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", r"lgpl"),
    ("agpl-3", r"(?:gnu )?(?:affero general public license|agpl)(?: version| v)? ?3(?: 0)?", r"agpl 3 0(?: only| or later)?"),
    ("agpl", r"(?:gnu )?(?:affero general public license|agpl)", r"agpl"),
    ("mpl-1.1", r"(?:mozilla public license|mpl)(?: version| v)? ?1 1", r"mpl 1 1"),
    ("mpl-2", r"(?:mozilla public license|mpl)(?: version| v)? ?2(?: 0)?", r"mpl 2 0"),
    ("epl-1", r"(?:eclipse public license|epl)(?: version| v)? ?1(?: 0)?", r"epl 1 0"),
    ("epl-2", r"(?:eclipse public license|epl)(?: version| v)? ?2(?: 0)?", r"epl 2 0"),
    ("cddl-1", r"(?:common development and distribution license|cddl)(?: version| v)?(?: 1(?: 0| 1)?)?", r"cddl 1 [01]"),
    ("eupl-1.2", r"(?:european union public licence|eupl)(?: version| v)? ?1 2", r"eupl 1 2"),
    ("artistic-2", r"artistic license(?: version| v)? ?2(?: 0)?", r"artistic 2 0"),
    ("artistic-1", r"(?:perl )?artistic license", r"artistic 1 0"),
    ("ms-pl", r"microsoft public license", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal license", r"ms rl"),
    ("unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", r"(?:do what the fuck you want to public license|wtfpl)", r"wtfpl"),
    ("cc0", r"(?:cc0|creative commons zero|cc zero)(?: 1 0)?", r"cc0 1 0"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1-4] [0-9])?", r"cc by [1-4] [0-9]"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [0-9])?", r"cc by sa [1-4] [0-9]"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1-4] [0-9])?", r"cc by nd [1-4] [0-9]"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [0-9])?", r"cc by nc [1-4] [0-9]"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [0-9])?", r"cc by nc sa [1-4] [0-9]"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1-4] [0-9])?", r"cc by nc nd [1-4] [0-9]"),
    ("odbl-1", r"(?:open database license|odbl)(?: 1 0)?", r"odbl 1 0"),
    ("odc-by-1", r"open data commons attribution(?: license)?(?: 1 0)?", r"odc by 1 0"),
    ("ofl-1.1", r"(?:sil )?open font license(?: version| v)?(?: 1 1)?", r"ofl 1 1"),
    ("psf-2", r"python software foundation license(?: version| v)?(?: 2(?: 0)?)?", r"psf 2 0"),
    ("openssl", r"openssl", r"openssl"),
]

# fixed values: phrasings with {name} or {id}, priority, confidence
PHRASINGS = [
    (r"spdx license identifier {id}", 1, 1.0),
    (r"(?:licensed|released|distributed|published|provided|available|dual licensed|covered) "
     r"under (?:the )?(?:terms (?:of|and conditions of) )?(?:the )?{name}(?: licen[sc]e)?",
     2, 0.95),
    (r"(?:under|of|by) the (?:terms of the )?{name} licen[sc]e", 3, 0.9),
    (r"{name} licen[sc]e", 4, 0.8),
    (r"licen[sc]e (?:is )?{name}", 5, 0.7),
]

# fixed values: label, characteristic sentence, priority, confidence
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", 1, 0.95),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", 1, 0.95),
    ("apache-2", r"you may not use this file except in compliance with the license", 1, 0.9),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 1, 0.9),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 1, 0.95),
    ("lgpl", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license", 1, 0.95),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 1, 0.95),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", 1, 0.8),
    ("public-domain", r"(?:placed|released|dedicated|put) (?:in|into|to) the public domain", 2, 0.8),
    ("proprietary", r"all rights reserved", 6, 0.5),
    ("proprietary", r"(?:proprietary and confidential|unauthorized copying of this file)", 5, 0.7),
]


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern
    keywords: tuple[frozenset[str], ...]  # a match contains one of each set
    priority: int
    score: float


def _keywords(body: str) -> frozenset[str]:
    """Strings of which every match of an expression contains one at least.

    Expressions are made of characters, classes, groups of alternatives and
    ``?``. Characters and groups in a row are joined to strings; of those that
    are not optional the ones whose shortest string is the longest count.
    """
    tokens = re.findall(r"\(\?:|\[[^]]*\]|.", body)

    def best(a, b):
        return max(a, b, key=lambda x: (min(map(len, x)), -len(x)))

    def walk(at: int):
        """Keywords, all strings if they are known, and the end of the group from ``at`` on."""
        keys, strings = set(), set()
        top, run, known = {""}, {""}, True
        while True:
            token = tokens[at] if at < len(tokens) else ")"
            if token in "|)":
                keys |= best(top, run)
                strings = strings | run if known and strings is not None else None
                if token == ")":
                    return keys, strings, at
                top, run, known, at = {""}, {""}, True, at + 1
                continue
            if token in "(*+{}.^$?" + chr(92):
                raise ValueError(f"{token} in {body}")
            inner, whole = {token}, {token}
            if token == "(?:":
                inner, whole, at = walk(at + 1)
            elif token[0] == "[":
                inner, whole = {""}, None
            at += 1
            if at < len(tokens) and tokens[at] == "?":
                inner, whole, at = {""}, None, at + 1
            if whole is not None and len(run) * len(whole) <= 8:
                run = {x + y for x in run for y in whole}
            else:
                top, run, known = best(best(top, run), inner), {""}, False
    return frozenset(walk(0)[0])


def _rule(label: str, phrase: str, name: str, priority: int, score: float) -> Rule:
    """The rule for a phrase with a name in place of {}; both have words around them."""
    body = phrase.replace("{}", f"(?:{name})")
    keys = [_keywords(f" {phrase.replace('{}', '[]')} "), _keywords(f" (?:{name}) ")]
    return Rule(label, re.compile(f"(?<= ){body}(?= )"),
                tuple(k for k in keys if min(map(len, k)) > 1), priority, score)


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """All rules, by priority: every license in every phrasing, then the sentences."""
    out = []
    for phrase, priority, score in PHRASINGS:
        for label, name, spdx in LICENSES:
            out.append(_rule(label, phrase.replace("{name}", "{}").replace("{id}", "{}"),
                             spdx if "{id}" in phrase else name, priority, score))
    for label, body, priority, score in SENTENCES:
        out.append(_rule(label, "{}", body, priority, score))
    for label, name, _ in LICENSES:  # names that need no phrasing around them
        if " " in name and label not in ("mit-0", "bsd"):
            out.append(_rule(label, "{}", name, 6, 0.6))
    return sorted(out, key=lambda r: r.priority)


_TO_WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else
                  c + 32 if 65 <= c < 91 else 32 for c in range(256))


def detections(line: str, prefilter: bool = True) -> list[tuple[int, int, str, float]]:
    """(start, end, label, score) in a line of single-spaced words with a space at both ends.

    Without ``prefilter`` every rule is tried; the result is the same.
    """
    seen: dict[frozenset[str], bool] = {}

    def has(keywords: frozenset[str]) -> bool:
        if keywords not in seen:
            seen[keywords] = any(word in line for word in keywords)
        return seen[keywords]
    found = []
    for order, rule in enumerate(rules()):
        if not prefilter or all(map(has, rule.keywords)):
            found += [(rule.priority, m.start() - m.end(), m.start(), order, m.end(), rule)
                      for m in rule.pattern.finditer(line)]
    kept: list[tuple[int, int, str, float]] = []
    edge: dict[int, list[tuple[int, int]]] = {}  # kept intervals by the blocks that they touch
    for _, _, start, _, end, rule in sorted(found, key=lambda f: f[:4]):
        if any(a <= start and end <= b for a, b in edge.get(start >> 8, ())):
            continue  # inside one that ranks higher
        kept.append((start, end, rule.label, rule.score))
        for block in range(start >> 8, (end >> 8) + 1):
            edge.setdefault(block, []).append((start, end))
    return sorted(kept)


def scan(text: str) -> dict:
    """Words, base places and license spans of one text; spans count words, end exclusive."""
    words = text.encode("utf-8", "replace").translate(_TO_WORDS).split()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    places = []
    for phrase, label in PHRASES.items():
        at = line.find(f" {phrase} ")
        while at >= 0:
            places.append((at, label))
            at = line.find(f" {phrase} ", at + 1)
    spans = detections(line)
    # character positions to word numbers, in one sweep
    marks = sorted({at for at, _ in places} | {s - 1 for s, *_ in spans} | {e for _, e, *_ in spans})
    number, word, before = {}, 0, 0
    for m in marks:
        word += line.count(" ", before, m)
        number[m], before = word, m
    base = sorted(number[at] for at, _ in places)
    base_labels = sorted({label for _, label in places})
    return {"n_words": len(words), "n_base": len(base),
            "first_word": base[0] if base else None, "last_word": base[-1] if base else None,
            "base_labels": ",".join(base_labels),
            "labels": ",".join(sorted({*base_labels, *(s[2] for s in spans)})),
            "score": max([0.9 * bool(base), *(s[3] for s in spans)]),
            "spans": [{"start": number[s - 1], "end": number[e], "label": label, "score": score}
                      for s, e, label, score in spans]}


_COLUMNS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
            ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
            ("score", pa.float64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                          ("label", pa.string()), ("score", pa.float64())])))]


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, word and base counts, labels, score, spans.

    Base places (the fixed phrases) always count; the rules' spans that
    survive suppression add labels. ``score`` is the highest confidence, 0 if
    nothing was found. Null, empty and wordless texts have no words, empty
    labels and score 0. A null doc_id is kept; repeated rows give equal rows.
    Other columns are ignored, whatever their names.
    """
    def run(batches):
        for b in slices(batches):
            rows = [scan(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array([r[c] for r in rows], t) for c, t in _COLUMNS],
                ["doc_id"] + [c for c, _ in _COLUMNS])
    return text_only(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
             "base_labels string, labels string, score double, "
             "spans array<struct<start: bigint, end: bigint, label: string, score: double>>")


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).withColumn(
        "n_spans", F.size("spans")).drop("spans")


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLES = {}
