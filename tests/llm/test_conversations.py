"""Conversation repair against a plain dynamic programme: faults, ties, blocks, odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from ledgerline.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, " \
         "conv string, copies int, digest string, seen string"
LONG = 2**63 - 1


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 3, "d", "s") for r in rows], SCHEMA)


def damage(rows):
    """conv_id -> rows after the damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        out[conv]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        out[conv] += [(turn, role, text)] * (2 if hit == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                      hashlib.sha256(r[2].encode()).digest()))
    return out


def least(rows):
    """(cost, letters, lines) of the least cost, ties by letters, for rows (role, text, fault)."""
    def closed(best):
        for _ in range(2):
            for q, to, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
                if q in best:
                    c, a, t = best[q]
                    best[to] = min(best.get(to, (10**9, "", ())), (c + 5, a + "I", (*t, role + ":")))
        return best
    best = closed({0: (0, "", ())})
    for role, text, fault in rows:
        after = {}

        def offer(q, entry):
            after[q] = min(after.get(q, (10**9, "", ())), entry)
        for q, (c, a, t) in best.items():
            offer(q, (c + 2, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            to = 3 if q == 2 else 2
            offer(to, (c + 1 + extra, a + "R", (*t, ("assistant" if to == 3 else "user") + ":" + text)))
            to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((q, role[:1]))
            if to:
                offer(to, (c + extra, a + "K", (*t, role + ":" + text)))
        best = closed(after)
    return min(best[q] for q in (0, 3) if q in best)


def brute(rows):
    out = []
    for conv, own in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                          "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = least([(r, t, f) for (_, r, t), f in zip(own, faults)])
        assert cost == least([(r, t, f) for (_, r, t), f in zip(own, faults)])[0]
        out.append((conv, min(gaps, LONG), *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    out = C.repair_conversations(C.damaged(df), **kw).collect()
    return sorted(((int(r[0]) if r[0] else None, *r[1:]) for r in out), key=str)


def random_rows(seed, convs, turns):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "Ass", None]
    texts = ["Fine.", "Fine.", "no end", "What?", "", " \t", None, "Stop! ", "x.y", "é。", "long " * 400 + "."]
    return [(c, t + rng.choice([0, 0, 0, 1, 5]), rng.choice(roles),
             rng.choice(texts) if rng.random() < .6 else f"m{rng.randrange(99)}.")
            for c in range(convs) for t in range(rng.randrange(1, turns))]


@pytest.mark.parametrize("block", [4096, 3])
def test_random_conversations_equal_brute_force(spark, block):
    rows = random_rows(7, 120, 14)
    assert found(frame(spark, rows), block=block) == brute(rows)


def test_long_conversation_over_many_blocks(spark):
    rows = random_rows(11, 1, 900) + random_rows(12, 5, 60)
    rows += [(77, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(1500)]
    want = brute(rows)
    assert found(frame(spark, rows), block=64) == want
    assert found(frame(spark, rows).repartition(7)) == want


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "Hi."), (5, None, "user", "a."),
            (5, None, "user", "a."), (5, 2**62, "assistant", "b."), (5, -2**63, "assistant", "b."),
            (6, None, None, None), (6, None, None, None), (8, 1, "user", None),
            (9, 1, "system", "only."), (10, 1, "assistant", "x" * 200_000)]
    rows += [(11, 4, "user", "same.")] * 900 + [(12, None, "user", "same.")] * 3
    assert found(frame(spark, rows)) == brute(rows)


def test_dropped_conversations_are_returned(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    none = hashlib.sha256(b"").hexdigest()
    assert found(frame(spark, gone)) == sorted(((c, 0, 0, 0, 0, 0, 0, "", none) for c, *_ in gone), key=str)


def test_empty_table(spark):
    assert found(frame(spark, [(1, 1, "user", "x")]).limit(0)) == []


def test_auction_prices_are_distances():
    """Against the plain programme on random lattices, cost and letters, in whole and in blocks."""
    rng = random.Random(3)
    for n in list(range(8)) * 20 + [60, 61]:
        rows, layers = [], []
        for _ in range(n):
            role, text, fault = rng.choice("suax"), "t", rng.choice(["", "", "truncated", "blank"])
            rows.append((role, text, fault))
            layers.append(C.must_go(1) if fault == "blank" else
                          C.ROWS[{"s": 1, "u": 2, "a": 3, "x": 0}[role], fault == "truncated"])
        cost, letters, _ = least(rows)
        assert C.repair(layers) == (cost, letters)
        cuts = sorted(rng.randrange(n + 1) for _ in range(3)) if n else []
        parts = [layers[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
        blocks = [C.ways(p) for p in parts if p] or [C.ways([])]
        taken, tail = C.choose(blocks)
        by = [{(w["q"], w["to"]): w for w in b}[t] for b, t in zip(blocks, taken)]
        assert "".join(w["edits"] for w in by) + tail == letters
        assert sum(w["cost"] for w in by) + 5 * len(tail) == cost
