"""Repair of a conversation's structure as a shortest path, found by auction.

A conversation's rows are the layers of a lattice, its nodes are the roles that
may come last (nothing yet, system, user, assistant), and its arcs are edits at
integer costs. The auction algorithm keeps a path and a price for each node:
the path's end either extends along an arc that its price makes tight, or
raises its price to the best offer and contracts. Origins are taken from the
last layer to the first, so a path grows only until it meets converged nodes;
in the end all prices are exact distances, the tight arcs are those of the
cheapest repairs, and the first letter in order on tight arcs traces the
lexicographically least of them.

Rows that repeat one another are one row with a count, and a long conversation
is cut into blocks of ``BLOCK`` rows. Each block's cheapest ways from role to
role are arcs of a coarser lattice, solved by the same auction. So no task holds
a whole conversation's rows; only its audit string and its digest, which the
result asks for as one value, are put together in order, from a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small, table

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED = 5           # cost of leaving a truncated row in place
#: Rows of a conversation handled at once.
BLOCK = 4096
#: Repeated messages up to which their first places are broadcast (counted first).
REPEATS = 100_000

NONE, SYSTEM, USER, ASSISTANT = range(4)
#: Characters that count as blank.
SPACE = " \t\n\x0b\x0c\r"
INFINITE = 1 << 62
LONG = (1 << 63) - 1

_STATS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, " \
         "turns bigint, first_turn bigint, last_turn bigint, first_role int, last_role int"
_ARCS = "array<struct<q:int,to:int,cost:bigint,rank:int,edits:string>>"
_BLOCKS = f"conv string, part int, seq int, whole boolean, cost bigint, edits string, " \
          f"arcs {_ARCS}, {_STATS}"
_CHOICE = "conv string, part int, seq int, q int, to int, tail string, illegal_before bigint, " \
          "same_turn bigint"
_REPAIRED = "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, " \
            "illegal bigint, cost bigint, audit string, repaired_sha256 string"


# --- the lattice -----------------------------------------------------------

def _inserts(q: int) -> list:
    return [("I", INSERT, (ASSISTANT if q == USER else USER) - q)]


def _row_arcs(role: int, truncated: bool) -> list:
    """For each last role, the edits of a row as (letter, cost, step to the next node), by letter."""
    extra = TRUNCATED if truncated else 0
    out = []
    for q in range(4):
        arcs = [("D", DELETE, 4), *_inserts(q)]
        follows = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}[q]
        if role in follows:
            arcs.append(("K", KEEP + extra, 4 + role - q))
        to = ASSISTANT if q == USER else USER
        arcs.append(("R", REROLE + extra, 4 + to - q))
        out.append(arcs)
    return out


#: Arcs of a row that may stay, by role (NONE: a role that fits no place) and truncation.
ROWS = {(r, t): _row_arcs(r, t) for r in range(4) for t in (False, True)}
#: Arcs after the last row.
AFTER = [_inserts(q) for q in range(4)]


def must_go(rows: int) -> list:
    """Arcs of ``rows`` rows that must all be deleted."""
    return [[("D" * rows, DELETE * rows, 4), *_inserts(q)] for q in range(4)]


def auction(layers: list, price: list[int], done: bytearray, most: int) -> None:
    """Raise ``price`` of every node to its distance from the nodes that are ``done``.

    ``layers[i][q]`` has the arcs of node ``4 * i + q``. A node whose price
    passes ``most`` leads nowhere and gets an infinite one.
    """
    for origin in range(4 * len(layers) - 1, -1, -1):
        path = [origin]
        while path and not done[path[-1]]:
            v = path[-1]
            best, to = INFINITE, v
            for _, cost, step in layers[v >> 2][v & 3]:
                offer = cost + price[v + step]
                if offer < best:
                    best, to = offer, v + step
            if best > most:
                price[v] = INFINITE
                done[v] = 1
                path.pop()
            elif price[v] < best:      # contract
                price[v] = best
                if len(path) > 1:
                    path.pop()
            else:                      # extend
                path.append(to)
        for v in path:
            done[v] = 1


def trace(layers: list, price: list[int], ends: frozenset, v: int) -> list[tuple]:
    """The tight arcs from ``v`` to one of ``ends``, the least letter first."""
    out = []
    while v not in ends:
        arc = next(a for a in layers[v >> 2][v & 3] if price[v] == a[1] + price[v + a[2]])
        out.append(arc)
        v += arc[2]
    return out


def solve(layers: list, ends: Iterable[int], most: int, barred: Iterable[int] = ()
          ) -> tuple[list[int], frozenset]:
    """Prices of all nodes of ``layers`` and of the layer after them, where ``ends`` cost nothing.

    No end can be reached from the roles ``barred``.
    """
    n = 4 * len(layers)
    ends = frozenset(ends)
    price = [0] * (n + 4)
    done = bytearray(n + 4)
    for v in range(n, n + 4):
        done[v] = 1
        price[v] = 0 if v in ends else INFINITE
    for v in ends:
        done[v] = 1
    for q in barred:
        done[q:n:4] = b"\x01" * len(layers)
        price[q:n:4] = [INFINITE] * len(layers)
    auction(layers, price, done, most)
    return price, ends


def _most(layers: list) -> int:
    return sum(arcs[NONE][0][1] for arcs in layers) + 2 * INSERT


def repair(layers: list) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of a whole conversation."""
    n = 4 * len(layers)
    price, ends = solve([*layers, AFTER], (n + NONE, n + ASSISTANT), _most(layers))
    return price[0], "".join(a[0] for a in trace([*layers, AFTER], price, ends, NONE))


def ways(layers: list) -> list[dict]:
    """The cheapest edits from each role before a block to each role after it."""
    n, out = 4 * len(layers), []
    most = _most(layers)
    for to in range(4):
        # no way leads back to the start, nor to a system message after a later role
        barred = range(to + 1, 4) if to < USER else ()
        price, ends = solve(layers, (n + to,), most, barred)
        out += [{"q": q, "to": to, "cost": price[q],
                 "edits": "".join(a[0] for a in trace(layers, price, ends, q))}
                for q in range(4) if price[q] < INFINITE]
    # letters decide between ways of equal cost
    for q in range(4):
        for rank, way in enumerate(sorted((w for w in out if w["q"] == q), key=lambda w: w["edits"])):
            way["rank"] = rank
    return out


def choose(blocks: list[list[dict]]) -> tuple[list[tuple[int, int]], str]:
    """Of each block's ways the one taken, as (q, to), and the inserts after the last block."""
    layers, most = [], 2 * INSERT
    for block in blocks:
        arcs = [sorted(((w["rank"], w["cost"], 4 + w["to"] - q) for w in block if w["q"] == q))
                for q in range(4)]
        layers.append(arcs)
        most += max(w["cost"] for w in block)
    n = 4 * len(layers)
    layers.append(AFTER)
    price, ends = solve(layers, (n + NONE, n + ASSISTANT), most)
    taken, q = [], NONE
    arcs = trace(layers, price, ends, NONE)
    for _, _, step in arcs[:len(blocks)]:
        taken.append((q, q + step - 4))
        q = taken[-1][1]
    return taken, "I" * (len(arcs) - len(blocks))


# --- tables ----------------------------------------------------------------

def damaged(convs: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies): what the fixed damage leaves of each row.

    ``conv`` is conv_id as text, empty for null. A null role or text is one
    space. By the CRC-32 of ``conv_id:turn`` (a null as one space) modulo 20: 0
    drops the row (``copies`` 0), 1 empties its text, 2 takes ``.!?`` out of
    it, 3 repeats it (``copies`` 2), 4 makes its role user.
    """
    col = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(col("conv_id"), F.lit(":"), col("turn")).cast("binary")) % 20
    return convs.select(
        F.coalesce(F.col("`conv_id`").cast("string"), F.lit("")).alias("conv"),
        F.col("`turn`").cast("bigint").alias("turn"),
        F.when(hit == 4, "user").otherwise(col("role")).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(col("text"), ".!?", ""))
        .otherwise(col("text")).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def messages(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, copies, blank, open, seen): equal rows as one, without texts.

    ``seen``: role and text stand at an earlier turn. A conversation's dropped
    rows are one of no copies, so that it is not lost.
    """
    there = F.col("copies") > 0
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    msgs = rows.select(
        "conv", "copies", F.when(there, F.col("turn")).alias("turn"),
        F.when(there, F.col("role")).alias("role"), F.when(there, _digest(F.col("text"))).alias("digest"),
        (there & (bare == "")).alias("blank"),
        (there & ~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"))
    msgs = cut(msgs.groupBy("conv", "turn", "role", "digest", "blank", "open").agg(
        F.sum("copies").cast("bigint").alias("copies")), "conversation-messages")
    key = ["conv", "role", "digest"]
    first = msgs.where("copies > 0").groupBy(*key).agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places"))
    first = cut(first.where("places > 1").drop("places"), "conversation-repeats")
    found = msgs.join(small(first, REPEATS), key, "left")
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return found.withColumn("seen", seen).drop("first")


class _Run:
    """Up to ``BLOCK`` neighbouring rows of a conversation."""

    def __init__(self, conv: str):
        self.conv, self.layers, self.rows = conv, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first_role = self.last_role = None
        self._gone = 0

    def _settle(self) -> None:
        if self._gone:
            self.layers.append(must_go(self._gone))
            self._gone = 0

    def add(self, turn, role: int, blank: bool, open_: bool, seen: bool, copies: int) -> None:
        if not copies:
            return
        self.rows += 1
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if self.first_role is None:
            self.first_role = role
        else:
            self.illegal += not follows(self.last_role, role)
        self.illegal += copies - 1     # a role after itself is never right
        self.last_role = role
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies if seen else copies - 1
        if not blank and not seen:
            self._settle()
            self.truncated += open_
            self.layers.append(ROWS[role, open_])
            copies -= 1
        self._gone += copies

    def row(self, part: int, seq: int, whole: bool) -> dict:
        self._settle()
        cost, edits = repair(self.layers) if whole else (None, None)
        return {"conv": self.conv, "part": part, "seq": seq, "whole": whole, "cost": cost,
                "edits": edits, "arcs": None if whole else ways(self.layers),
                **{k: getattr(self, k) for k in (
                    "blank", "duplicate", "truncated", "illegal", "turns", "first_turn",
                    "last_turn", "first_role", "last_role")}}


def follows(before: int, role: int) -> bool:
    return (before, role) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _arrow(rows: Iterable[dict], schema: pa.Schema, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def blocks(msgs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Solved blocks: a range sort splits even a single conversation over many tasks.

    A conversation that lies within one task and one block is ``whole`` and has
    its cost and edits; another block has its ``arcs``.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(),
             F.col("digest").asc_nulls_first()]
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(
        initial == "a", ASSISTANT).otherwise(NONE)
    laid = msgs.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", "turn", role.alias("role"), "blank", "open", "seen", "copies")
    schema = _arrow_schema(_BLOCKS)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        run, seq, first = None, 0, True
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, *message in zip(*columns, strict=True):
                if run is None or run.conv != conv:
                    if run is not None:   # its rows may go on only before the task's first
                        yield run.row(part, seq, not seq and not first)
                        first = False
                    run, seq = _Run(conv), 0
                elif run.rows >= block:
                    yield run.row(part, seq, False)
                    run, seq = _Run(conv), seq + 1
                run.add(*message)
        if run is not None:
            yield run.row(part, seq, False)

    def solve_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _arrow(runs(batches), schema)
    return cut(laid.mapInArrow(solve_runs, _BLOCKS), "conversation-blocks")


def joined_blocks(parts: DataFrame) -> DataFrame:
    """For each block that is not whole: the way taken through it, and what it adds at its start.

    A task holds a conversation's blocks without their letters, a few numbers
    for ``BLOCK`` rows.
    """
    schema = _arrow_schema(_CHOICE)
    slim = parts.select("conv", "part", "seq", F.transform("arcs", lambda a: F.struct(
        a["q"].alias("q"), a["to"].alias("to"), a["cost"].alias("cost"), a["rank"].alias("rank")))
        .alias("arcs"), "first_turn", "last_turn", "first_role", "last_role")
    laid = slim.repartition("conv").sortWithinPartitions("conv", "part", "seq")

    def solved(conv: list[dict]) -> Iterator[dict]:
        taken, tail = choose([b["arcs"] for b in conv])
        turn = role = None
        for k, (b, (q, to)) in enumerate(zip(conv, taken, strict=True)):
            bad = role is not None and b["first_role"] is not None and not follows(role, b["first_role"])
            same = turn is not None and b["first_turn"] == turn
            yield {"conv": b["conv"], "part": b["part"], "seq": b["seq"], "q": q, "to": to,
                   "tail": tail if k == len(conv) - 1 else "", "illegal_before": int(bad),
                   "same_turn": int(same)}
            turn = turn if b["last_turn"] is None else b["last_turn"]
            role = role if b["last_role"] is None else b["last_role"]

    def convs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = []
        for batch in batches:
            for b in batch.to_pylist():
                if held and held[0]["conv"] != b["conv"]:
                    yield from solved(held)
                    held = []
                held.append(b)
        if held:
            yield from solved(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _arrow(convs(batches), schema, 4096)
    return laid.mapInArrow(run, _CHOICE)


def audits(solved: DataFrame) -> DataFrame:
    """(conv, blank, duplicate, truncated, illegal, turns, first_turn, last_turn, cost, audit)."""
    counts = ["blank", "duplicate", "truncated"]
    whole = solved.where("whole").select("conv", *counts, "illegal", "turns", "first_turn",
                                         "last_turn", "cost", F.col("edits").alias("audit"))
    parts = solved.where("not whole")
    both = parts.join(joined_blocks(parts), ["conv", "part", "seq"])
    way = F.filter("arcs", lambda a: (a["q"] == F.col("q")) & (a["to"] == F.col("to")))[0]
    both = both.withColumn("way", way)
    letters = F.struct("part", "seq", F.concat("way.edits", "tail").alias("edits"))
    rest = both.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.sum(F.col("illegal") + F.col("illegal_before")).alias("illegal"),
        F.sum(F.col("turns") - F.col("same_turn")).alias("turns"),
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"),
        F.sum(F.col("way.cost") + INSERT * F.length("tail")).alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(letters)), lambda x: x["edits"]), "")
        .alias("audit"))
    return whole.unionByName(rest)


def repaired(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Each conversation's result: its rows stream by in order behind its audit.

    The digest of a repaired conversation is one value over all of it, so one
    task reads it row by row; it holds the audit and a row.
    """
    gaps = (F.col("last_turn").cast("decimal(38,0)") - F.col("first_turn") + 1 - F.col("turns"))
    gaps = F.when(gaps.isNull(), 0).otherwise(F.least(gaps, F.lit(LONG)).cast("bigint"))
    numbers = F.array(gaps, "blank", "duplicate", "truncated", "illegal", "cost")
    heads = audit.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("digest"),
                         F.col("audit").alias("text"), F.lit(0).alias("copies"), numbers.alias("numbers"))
    lines = rows.where("copies > 0").select(
        "conv", F.lit(1).alias("kind"), "turn", "role", _digest(F.col("text")).alias("digest"), "text",
        "copies", F.lit(None).cast("array<bigint>").alias("numbers"))
    order = ["conv", "kind", F.col("turn").asc_nulls_first(), "role", "digest"]
    laid = heads.unionByName(lines).repartition("conv").sortWithinPartitions(*order).select(
        "conv", "kind", "role", "text", "copies", "numbers")
    schema = _arrow_schema(_REPAIRED)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out = None
        audit, at, last, sha, lines = "", 0, NONE, None, 0

        def say(role: str, text: str) -> None:
            nonlocal lines
            sha.update((("\n" if lines else "") + role + ":" + text).encode())
            lines += 1

        def inserts() -> None:
            nonlocal at, last
            while at < len(audit) and audit[at] == "I":
                last = ASSISTANT if last == USER else USER
                say("assistant" if last == ASSISTANT else "user", "")
                at += 1

        def ended() -> dict:
            inserts()
            return {**out, "repaired_sha256": sha.hexdigest()}

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, kind, role, text, copies, numbers in zip(*columns, strict=True):
                if not kind:
                    if out is not None:
                        yield ended()
                    audit, at, last, sha, lines = text, 0, NONE, hashlib.sha256(), 0
                    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
                    out = {"conv": conv, "audit": audit, **dict(zip(names, numbers, strict=True))}
                    continue
                for _ in range(copies):
                    inserts()
                    letter = audit[at]
                    at += 1
                    if letter == "K":
                        last = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                        say(role, text)
                    elif letter == "R":
                        last = ASSISTANT if last == USER else USER
                        say("assistant" if last == ASSISTANT else "user", text)
        if out is not None:
            yield ended()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _arrow(results(batches), schema)
    return laid.mapInArrow(run, _REPAIRED)


def repair_conversations(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per ``conv`` of ``rows`` (conv, turn, role, text, copies): faults, cost, audit, digest.

    Rows are taken by turn, nulls first; rows of one turn by role, then by the
    digest of their text, so equal rows stand side by side. A role without
    any character fits no place and is never kept. A conversation without rows
    has zeros, an empty audit and the digest of an empty string; so has one
    whose rows are all deleted an empty text. No rows give no rows.
    """
    return repaired(rows, audits(blocks(messages(rows), block)))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Repair of the whole damaged ``conversations`` table.

    Null conv_ids are one conversation, with a null conv_id in the result; other
    nulls as in :func:`damaged`, odd input as in :func:`repair_conversations`.
    """
    out = repair_conversations(damaged(table(spark, sf_dir, "conversations")))
    conv = F.when(F.col("conv") != "", F.col("conv")).cast("bigint")
    return out.select(conv.alias("conv_id"), *[c for c in out.columns if c != "conv"])


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda a, b:
    CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)) AS t),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a // 256, crc.t[(xor(a, b) % 256) + 1]))) % 20 AS hit
  FROM conversations, crc),
dmg AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE hit WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM dmg),
faulty AS (
  SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN bare = '' THEN 'b'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
         WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
arcs(q, letter, nxt, need, price) AS (VALUES
  (0, 'D', 0, '', 2), (1, 'D', 1, '', 2), (2, 'D', 2, '', 2), (3, 'D', 3, '', 2),
  (0, 'K', 1, 's', 0), (0, 'K', 2, 'u', 0), (1, 'K', 2, 'u', 0), (2, 'K', 3, 'a', 0), (3, 'K', 2, 'u', 0),
  (0, 'R', 2, '', 1), (1, 'R', 2, '', 1), (2, 'R', 3, '', 1), (3, 'R', 2, '', 1)),
adds(q, nxt, letters, price, lines) AS (VALUES
  (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
  (0, 2, 'I', 5, chr(10) || 'user:'), (1, 2, 'I', 5, chr(10) || 'user:'), (3, 2, 'I', 5, chr(10) || 'user:'),
  (2, 3, 'I', 5, chr(10) || 'assistant:'),
  (0, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:')),
best AS (
  SELECT c.conv_id, 0::BIGINT AS i, a.nxt AS q, lpad(a.price::VARCHAR, 12, '0') || a.letters AS k, a.lines AS t
  FROM (SELECT DISTINCT conv_id FROM conversations) c JOIN adds a ON a.q = 0
  UNION ALL
  SELECT conv_id, i, q, min(k), arg_min(t, k) FROM (
    SELECT b.conv_id, f.i, a.nxt AS q,
      lpad((left(b.k, 12)::BIGINT + e.price + a.price
            + CASE WHEN f.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END)::VARCHAR, 12, '0')
        || substr(b.k, 13) || e.letter || a.letters AS k,
      b.t || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
        ELSE chr(10) || CASE e.nxt WHEN 3 THEN 'assistant:' ELSE 'user:' END || f.text END || a.lines AS t
    FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
      JOIN arcs e ON e.q = b.q AND (e.letter = 'D' OR f.fault NOT IN ('b', 'd'))
        AND e.need IN ('', left(f.role, 1))
      JOIN adds a ON a.q = e.nxt)
  GROUP BY conv_id, i, q),
ended AS (
  SELECT b.conv_id, any_value(c.gaps) AS gaps, any_value(c.blank) AS blank,
    any_value(c.duplicate) AS duplicate, any_value(c.truncated) AS truncated,
    any_value(c.illegal) AS illegal, min(b.k) AS k, arg_min(b.t, b.k) AS t
  FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
  WHERE b.i = coalesce(c.n, 0) AND b.q IN (0, 3)
  GROUP BY b.conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, left(k, 12)::BIGINT AS cost, substr(k, 13) AS audit,
  sha256(substr(t, 2)) AS repaired_sha256
FROM ended
"""

QUERIES = {"op11_conversation_repair": op11_conversation_repair}
ORACLES = {"op11_conversation_repair": ORACLE}
