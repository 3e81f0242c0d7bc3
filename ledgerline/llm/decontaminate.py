"""Benchmark decontamination by template windows.

Texts become sequences of canonical tokens: numbers, names and units turn into
typed placeholders, other words are lower-cased. Windows of k tokens of the
documents are hash-joined with those of the benchmark items. Along a matched
stretch the placeholders' values must be consistent: one value in the item
always stands for one value in the copy. So a question whose numbers or names
were replaced is found, also if it stands there with several replacements, and
a text that merely has a similar shape is not. Items with few literal words are
found with their own values only, and every item as a sequence of whole words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, slices, table, text_bytes, text_only, token_bounds, word_hashes

WINDOW = 5
COVERAGE = 0.8  # share of an item's windows that make a leak
RUN = 13        # or so many consecutive tokens
LITERALS = 8    # of which so many are no placeholders, or all that the item has
#: Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

# fixed values: spelled numbers and units of measure
NUMBERS = ("one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
           "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
           "eighty ninety hundred thousand million billion dozen half").split()
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram "
         "kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon "
         "gallons second seconds minute minutes hour hours day days week weeks month months "
         "year years cent cents dollar dollars euro euros meter meters metre metres kilometer "
         "kilometers kilometre kilometres percent degrees mph kmh").split()
NUM, NAME, UNIT = 1, 2, 3  # classes of tokens; 0 is a literal word
_MARK = mix(np.arange(101, 105, dtype=np.uint64))


def _hash_words(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = token_bounds(data, np.array([0, len(data)]), _WORD)
    return np.sort(word_hashes(data, starts, ends))


_NUMBERS, _UNITS = _hash_words(NUMBERS), _hash_words(UNITS)


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


class Words(NamedTuple):
    """The lower-cased bytes, each word's start, end and hash, and each row's range of words."""

    low: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hash: np.ndarray
    tok: np.ndarray


def split_words(data: np.ndarray, off: np.ndarray) -> Words:
    """Words are runs of ASCII letters, digits and non-ASCII bytes.

    A point or comma between digits belongs to the number.
    """
    n = len(data)
    if not n:
        z = np.empty(0, np.int64)
        return Words(data, z, z, np.empty(0, np.uint64), np.zeros(len(off), np.int64))
    digit = _DIGIT[data]
    word_byte = _WORD[data]
    point = np.flatnonzero((data == 46) | (data == 44))
    point = point[(point > 0) & (point < n - 1)]
    point = point[digit[point - 1] & digit[point + 1]
                  & ~np.isin(point, off) & ~np.isin(point + 1, off)]
    # bytes as they count for words: a point inside a number is made a letter-like byte
    shaped = np.where(word_byte, data, np.uint8(32))
    shaped[point] = 48
    starts, ends, tok = token_bounds(shaped, off, _WORD)
    low = _LOWER[data]
    high = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
                          & (data[:-1] == 0xC3)) + 1
    low[high] += 32  # Latin-1 capitals in UTF-8
    return Words(low, starts, ends, word_hashes(low, starts, ends), tok)


def canonical(data: np.ndarray, words: Words, names: bool = True):
    """Canonical token hashes, classes, raw value hashes, and each row's range of tokens.

    A name is a capitalised word
    (its second character not a capital) that does not begin a sentence; with
    ``names`` false there are none, so that case does not matter. Neighbouring
    placeholders of one class are one token.
    """
    n = len(data)
    low, starts, ends, h, tok = words
    if not len(starts):
        return h, np.empty(0, np.int8), h, tok
    kind = np.zeros(len(starts), np.int8)
    kind[_in(_UNITS, h)] = UNIT
    kind[_DIGIT[data[starts]] | _in(_NUMBERS, h)] = NUM
    if names:
        first = low[starts] != data[starts]
        accent = (data[starts] == 0xC3) & (low[np.minimum(starts + 1, n - 1)]
                                           != data[np.minimum(starts + 1, n - 1)])
        second = np.minimum(starts + np.where(accent, 2, 1), n - 1)
        small = (low[second] == data[second]) & (ends - starts > np.where(accent, 2, 1))
        stop = np.concatenate([[0], np.cumsum((data == 46) | (data == 33) | (data == 63)
                                              | (data == 10))])
        mid = np.zeros(len(starts), bool)
        mid[1:] = stop[starts[1:]] == stop[ends[:-1]]
        mid[tok[:-1][tok[:-1] < len(starts)]] = False
        kind[(first | accent) & small & mid & (kind == 0)] = NAME
    token = np.where(kind > 0, _MARK[kind], h)
    same = np.zeros(len(starts), bool)
    same[1:] = (kind[1:] > 0) & (kind[1:] == kind[:-1])
    same[tok[:-1][tok[:-1] < len(starts)]] = False
    keep = np.flatnonzero(~same)
    value = np.add.reduceat(h, keep)
    return token[keep], kind[keep], value, np.searchsorted(keep, tok)


def windows(token: np.ndarray, tok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all windows of k tokens within one row."""
    n = len(token) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + token[j:n + j]
    inside = np.ones(n, bool)
    for back in range(1, k):  # a row's last k-1 tokens start no window
        at = tok[1:] - back
        at = at[(at >= 0) & (at < n)]
        inside[at] = False
    starts = np.flatnonzero(inside)
    return starts, mix(h[starts])


class Items:
    """Some benchmark items, looked for with names as placeholders and as plain words."""

    def __init__(self, ids: list[int], texts: list[str], k: int):
        self.ids = np.array(ids, np.int64)
        data, off = text_bytes(pa.array(texts, pa.string()))
        words = split_words(data, off)
        self.views = [_View(data, words, k, names) for names in (True, False)]
        self.verbatim = _Verbatim(words, k)

    def hits(self, data, off, coverage, run, literals):
        """(row, item, item's windows, matched ones, longest run of tokens) of each leak."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        words = split_words(data, off)
        for view in self.views:
            for row, item, *found in view.hits(data, words, coverage, run, literals):
                best[row, item] = max(best.get((row, item), (0, 0, 0)), tuple(found),
                                      key=lambda x: x[1])
        plain = self.views[-1]
        for row, item in self.verbatim.hits(words):
            n = int(plain.n_windows[item])
            whole = n, n, int(plain.tok[item + 1] - plain.tok[item])
            best[row, item] = max(best.get((row, item), whole), whole, key=lambda x: x[1])
        return [(*k, *v) for k, v in sorted(best.items())]


class _Verbatim:
    """Every item as a sequence of words, looked for by its first k or fewer words."""

    def __init__(self, words: Words, k: int):
        self.word, self.tok = words.hash, words.tok
        self.size = np.diff(words.tok)
        self.sum = self._sums(words.hash)
        self.heads = []
        for n in range(1, k + 1):
            item = np.flatnonzero(self.size == n if n < k else self.size >= k)
            if len(item):
                starts, h = windows(self.word, self.tok, n)
                h = h[np.searchsorted(starts, self.tok[item])]
                order = np.argsort(h, kind="stable")
                maybe = np.zeros(1 << 16, bool)
                maybe[(h & np.uint64(0xFFFF)).astype(np.int64)] = True
                self.heads.append((n, h[order], item[order], maybe))

    @staticmethod
    def _sums(h):
        """Sums of the first words' hashes, and the powers that each is multiplied by."""
        power = np.cumprod(np.full(len(h) + 1, np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64)
        return np.concatenate([[np.uint64(0)], np.cumsum(h * power[:-1], dtype=np.uint64)]), power

    def hits(self, words: Words) -> list[tuple[int, int]]:
        """(row, item) of the rows that hold all of an item's words, one after the other."""
        h, tok = words.hash, words.tok
        out, sums = set(), None
        for n, head, items, maybe in self.heads:
            at, found = windows(h, tok, n)
            pick = np.flatnonzero(maybe[(found & np.uint64(0xFFFF)).astype(np.int64)])
            at, found = at[pick], found[pick]
            lo, hi = np.searchsorted(head, found), np.searchsorted(head, found, side="right")
            some = hi > lo
            at, lo, count = at[some], lo[some], (hi - lo)[some]
            if not len(at):
                continue
            which = np.repeat(np.arange(len(at)), count)
            item = items[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                         + np.repeat(lo, count)]
            d = at[which]
            row = np.searchsorted(tok, d, side="right") - 1
            size = self.size[item]
            fits = np.flatnonzero(d + size <= tok[row + 1])
            d, row, item, size = d[fits], row[fits], item[fits], size[fits]
            (total, power), (own, own_power) = sums or self._sums(h), self.sum
            sums = total, power
            i = self.tok[item]
            same = (total[d + size] - total[d]) * own_power[i] == (own[i + size] - own[i]) * power[d]
            out.update(zip(row[same].tolist(), item[same].tolist()))
        return sorted(out)


class _View:
    """The template windows of the items, sorted by hash."""

    def __init__(self, data, words: Words, k: int, names: bool):
        self.k, self.names = k, names
        self.token, self.kind, self.value, self.tok = canonical(data, words, names)
        literal = np.concatenate([[0], np.cumsum(self.kind == 0)])
        self.own_literals = np.diff(literal[self.tok])
        starts, h = windows(self.token, self.tok, k)
        order = np.argsort(h, kind="stable")
        self.hash, self.start = h[order], starts[order]
        self.item = np.searchsorted(self.tok, self.start, side="right") - 1
        self.n_windows = np.bincount(self.item, minlength=len(self.tok) - 1)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hash & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, data, words: Words, coverage, run, literals):
        k = self.k
        token, kind, value, tok = canonical(data, words, self.names)
        at, h = windows(token, tok, k)
        pick = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at, h = at[pick], h[pick]
        lo, hi = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, side="right")
        n = hi - lo
        total = int(n.sum())
        if not total:
            return []
        which = np.repeat(np.arange(len(at)), n)
        w = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        d_at, i_at, item = at[which], self.start[w], self.item[w]
        row = np.searchsorted(tok, d_at, side="right") - 1
        pair = row * np.int64(len(self.n_windows)) + item
        order = np.lexsort((i_at, d_at - i_at, pair))
        pair, d_at, i_at, item, row = (x[order] for x in (pair, d_at, i_at, item, row))
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        last = np.append(first[1:], len(pair))
        need = np.minimum(np.ceil(coverage * self.n_windows[item[first]]), max(run - k + 1, 1))
        out = []
        for a, b in zip(first[last - first >= need], last[last - first >= need]):
            m = int(item[a])
            best = self._best if self.own_literals[m] >= literals else self._equal
            leak, found, longest = best(d_at[a:b], i_at[a:b], kind, value, m,
                                        coverage, run, literals)
            if leak:
                out.append((int(row[a]), m, int(self.n_windows[m]), found, longest))
        return out

    def _best(self, d, i, kind, value, m: int, coverage, run, floor) -> tuple[bool, int, int]:
        """Do the windows make a leak, how many are there, tokens of the longest stretch.

        The windows are in order of their diagonal d - i, so each diagonal is
        one place of the item in the document. Slots must be consistent over
        the whole document, over one diagonal, or over the diagonals beside
        one (a copy with words put in or left out).
        """
        least = coverage * self.n_windows[m]
        span = np.arange(self.k)
        di, ii = d[:, None] + span, i[:, None] + span
        slot = (self.kind[ii] == NUM) | (self.kind[ii] == NAME)
        iv, dv = self.value[ii], value[di]
        lane = np.cumsum(np.concatenate([[0], np.diff(d - i) != 0]))
        got = self._voted(np.zeros(len(d), np.int64), iv, dv, slot)
        found = len(np.unique(i[got]))
        leak = self._enough(i[got], least, floor) > 0
        longest = self._longest(d, i, value, not got.all(), run, floor)
        if not got.all() and len(np.unique(i)) >= least:
            got = self._voted(lane, iv, dv, slot)
            size = np.bincount(lane[got], minlength=lane[-1] + 1)
            ends = np.searchsorted(lane, np.arange(lane[-1] + 2))
            for n in np.flatnonzero(size >= least):
                if size[n] <= found and leak:
                    continue
                part = slice(ends[n], ends[n + 1])
                if self._enough(i[part][got[part]], least, floor):
                    leak, found = True, max(found, int(size[n]))
            if not leak:
                beside = self._beside(d, i, lane, got, iv, dv, slot, m, least, floor)
                leak, found = beside > 0, max(found, beside)
        return leak or longest >= run, found, longest

    def _equal(self, d, i, kind, value, m: int, coverage, run, literals) -> tuple[bool, int, int]:
        """The same for an item with few literals: all its tokens, with equal values."""
        span = np.arange(self.k)
        di, ii = d[:, None] + span, i[:, None] + span
        got = ~((self.kind[ii] > 0) & (self.value[ii] != value[di])).any(1)
        if not got.any():
            return False, 0, 0
        d, i = d[got], i[got]
        found = len(np.unique(i))
        whole = len(np.unique(i[:, None] + span)) == self.tok[m + 1] - self.tok[m]
        return (bool(whole and found >= coverage * self.n_windows[m]), found,
                self._longest(d, i, value, False, run, 0))

    def _voted(self, group, iv, dv, slot) -> np.ndarray:
        """Which windows have no slot whose item value stands for several document values.

        Of several values in a group the most frequent one counts, ties the smallest.
        """
        if not slot.any():
            return np.ones(len(slot), bool)
        g, x, y = np.repeat(group, slot.sum(1)), iv[slot], dv[slot]
        order = np.lexsort((y, x, g))
        g, x, y = g[order], x[order], y[order]
        new_x = np.concatenate([[True], (g[1:] != g[:-1]) | (x[1:] != x[:-1])])
        new_y = new_x | np.concatenate([[True], y[1:] != y[:-1]])
        at = np.flatnonzero(new_y)
        seen = np.diff(np.append(at, len(y)))
        of = np.cumsum(new_x[at]) - 1  # the (group, item value) of each run of equal ones
        most = np.flatnonzero(seen == np.maximum.reduceat(seen, np.flatnonzero(new_x[at]))[of])
        chosen = np.zeros(len(at), bool)
        chosen[most[np.unique(of[most], return_index=True)[1]]] = True
        right = np.empty(len(y), bool)
        right[order] = chosen[np.cumsum(new_y) - 1]
        wrong = np.zeros(slot.shape, bool)
        wrong[slot] = ~right
        return ~wrong.any(1)

    def _beside(self, d, i, lane, got, iv, dv, slot, m: int, least, floor) -> int:
        """The same over several diagonals: each one's values hold for its surroundings.

        Windows within an item's length of a diagonal's own join it, nearest
        diagonals first, if their slots fit the values so far.
        """
        size = int(self.tok[m + 1] - self.tok[m])
        by_d = np.argsort(d, kind="stable")
        sorted_d, diagonal = d[by_d], d - i
        first = np.flatnonzero(np.concatenate([[True], np.diff(lane) != 0]))
        last = np.append(first[1:], len(d))
        for a, b in zip(first.tolist(), last.tolist()):
            near = by_d[np.searchsorted(sorted_d, d[a] - size):
                        np.searchsorted(sorted_d, d[b - 1] + size, side="right")]
            if len(np.unique(i[near])) < least or not got[a:b].any():
                continue
            held: dict[int, int] = {}
            taken = []
            near = near[got[near] | (lane[near] != lane[a])]
            for w in near[np.lexsort((d[near], np.abs(diagonal[near] - diagonal[a])))].tolist():
                pairs = list(zip(iv[w][slot[w]].tolist(), dv[w][slot[w]].tolist()))
                mine = dict(pairs)
                if all(mine[x] == y and held.get(x, y) == y for x, y in pairs):
                    held.update(mine)
                    taken.append(w)
            found = self._enough(i[taken], least, floor)
            if found:
                return found
        return 0

    def _enough(self, i, least, floor) -> int:
        """How many different windows, 0 if too few or with too few literals."""
        n = len(np.unique(i))
        return n if n >= least and self._literals(i) >= floor else 0

    def _literals(self, i) -> int:
        return int((self.kind[np.unique(i[:, None] + np.arange(self.k))] == 0).sum())

    def _longest(self, d, i, value, check: bool, run, floor) -> int:
        """Tokens in the longest stretch of consecutive windows that has enough literals.

        With ``check`` only stretches with consistent slots count.
        """
        ends = np.flatnonzero(np.concatenate([(np.diff(d) != 1) | (np.diff(i) != 1), [True]]))
        best = 0
        for a, b in zip(np.append(0, ends[:-1] + 1).tolist(), ends.tolist()):
            lo, hi, shift = int(i[a]), int(i[b]) + self.k, int(d[a] - i[a])
            if hi - lo <= best:
                continue
            kinds = self.kind[lo:hi]
            cuts = [(lo, hi)]
            if check:
                at = lo + np.flatnonzero((kinds == NUM) | (kinds == NAME))
                cuts = self._consistent(at, self.value[at], value[at + shift], lo, hi)
            for x, y in cuts:
                if y - x > best and y - x >= self.k and (
                        y - x < run or (kinds[x - lo:y - lo] == 0).sum() >= floor):
                    best = y - x
        return best

    @staticmethod
    def _consistent(at, iv, dv, lo: int, hi: int) -> list[tuple[int, int]]:
        """The longest parts of lo..hi in which no item value has several document values."""
        parts, start = [], lo
        last: dict[int, tuple[int, int]] = {}  # item value: its last place and value there
        for p, x, y in zip(at.tolist(), iv.tolist(), dv.tolist()):
            before = last.get(x)
            if before and before[1] != y and before[0] >= start:
                parts.append((start, p))
                start = before[0] + 1
            last[x] = p, y
        return [*parts, (start, hi)]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, k: int):
    """The benchmark in blocks of a bounded size, one after the other."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"),
                             F.col(text_col).alias("text")) \
        .where("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    if blocks > 1:  # dealt out row by row, so many rows of one item_id do not meet in a block
        items = cut(items.repartition(blocks).withColumn("block", F.spark_partition_id()), "items")
    for b in range(blocks):
        part = (items.where(F.col("block") == b) if blocks > 1 else items) \
            .orderBy("item_id", "text").collect()
        yield Items([r.item_id for r in part], [r.text for r in part], k)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", k: int = WINDOW, coverage: float = COVERAGE,
                 run: int = RUN, literals: int = LITERALS) -> DataFrame:
    """The leaks: doc_id, item_id, n_windows, n_matched, longest_run, one row for each pair.

    A document leaks an item when it has ``coverage`` of the item's distinct
    windows of ``k`` canonical tokens, or ``run`` consecutive tokens of it, with
    at least ``literals`` literal words and consistent slots. The slots of a run
    are consistent in themselves, those of the windows in one copy or over the
    whole document. Of an item with fewer literals all tokens must be there, the
    placeholders with the item's values. Besides, a document leaks every
    item whose words it holds one after the other, however short: an item of
    one word is found wherever that word stands. ``n_windows`` is 0 for items
    shorter than ``k`` tokens. A null or empty text leaks nothing; items
    without id, text or words are never found; repeated items give a row each, repeated documents too.
    Empty tables give no rows. Other columns are ignored.

    The benchmark is looked for in blocks of at most ``BLOCK_BYTES`` or so of
    its text: a block's hash table goes to every task (a proven bound), the
    documents are read once for each block and never shuffled.
    """
    spark = docs.sparkSession
    schema = ("doc_id bigint, item_id bigint, n_windows bigint, n_matched bigint, "
              "longest_run bigint")
    names = ["doc_id", "item_id", "n_windows", "n_matched", "longest_run"]
    text = text_only(docs, id_col, text_col)
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col, k):
        held = spark.sparkContext.broadcast(block)

        def search(batches, held=held):
            items = held.value
            for b in slices(batches):
                hits = items.hits(*text_bytes(b.column("text")), coverage, run, literals)
                if hits:
                    row, item, size, found, longest = (np.array(x, np.int64) for x in zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array(row)), pa.array(items.ids[item]),
                         pa.array(size), pa.array(found), pa.array(longest)], names)
        out = out.unionByName(text.mapInArrow(search, schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", k: int = WINDOW,
                      coverage: float = COVERAGE, run: int = RUN,
                      literals: int = LITERALS) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns; same rules, no shuffle."""
    spark, schema, at = docs.sparkSession, docs.schema, docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col, k):
        held = spark.sparkContext.broadcast(block)

        def keep(batches, held=held):
            for b in slices(batches, at):
                clean = np.ones(b.num_rows, bool)
                hits = held.value.hits(*text_bytes(b.column(at)), coverage, run, literals)
                clean[[h[0] for h in hits]] = False
                yield b.filter(pa.array(clean))
        docs = docs.mapInArrow(keep, schema)
    return docs


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_decontamination": op5_decontamination}
ORACLES = {}
