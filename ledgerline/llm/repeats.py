"""Repeated-substring removal with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts earlier in
the corpus is removed. The corpus is never in one suffix array:

1. Each string of ``length`` bytes (a window) belongs to one of its 32-byte
   grams, the one with the smallest hash (the first such). Equal windows thus
   belong to equal grams. Neighbouring windows of one gram form a stretch, known
   by its gram, a hash of its bytes and its place.
2. Of equal stretches all but the earliest are repeats: a task settles its own
   copies, the rest meet by gram. A gram with one stretch content is done; only
   the contents of grams with several go on, with their bytes.
3. They go to shards by gram. The windows of a gram with more than ``hot``
   contents go one by one, by their own hash, so no shard grows with one passage.
   Each shard is sorted by a suffix array (Larsson-Sadakane refinement), the
   common prefixes of neighbours show equal windows, all but the earliest are
   marked. What a shard's last gram has in the shard before it is found by
   binary search in that shard's sorted windows.
4. The marked windows of a document are united and cut out of its text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix, numbered, slices, table, text_bytes, text_only

LENGTH = 100
GRAM = 32
#: A gram with more stretch contents than this sends single windows.
HOT = 20_000
#: Stretches among which a task settles copies before it sends them on.
LOCAL_ROWS = 1_000_000
#: Bytes of stretches that one suffix array holds, and that a task remembers to find copies.
SHARD_BYTES = 2 << 20
LOCAL_BYTES = 16 << 20

_P = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << i, 1 << 64)) for i in range(6)]
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Hash of the k bytes from each position on (k a power of two), by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    n, level = 1, 0
    while n < k:
        if len(h) <= n:
            return np.empty(0, np.uint64)
        h = h[:-n] * _P[level] + h[n:]
        n, level = 2 * n, level + 1
    return mix(h)


def stretches(data: np.ndarray, off: np.ndarray, length: int = LENGTH):
    """(gram hash, content hash, row, first window, last window) of all stretches.

    Positions count from the row's start.
    """
    none = np.empty(0, np.int64)
    if len(data) < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), none, none, none
    h = gram_hashes(data)
    # smallest hash first, then the first position
    best = ((h >> np.uint64(32)) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width, n = length - GRAM + 1, 1
    while 2 * n <= width:
        best = np.minimum(best[:-n], best[n:])
        n *= 2
    if width > n:
        best = np.minimum(best[:len(best) - (width - n)], best[width - n:])
    owner = (best & _LOW).astype(np.int64)  # of the window that starts here
    count = np.maximum(np.diff(off) - length + 1, 0)
    if not count.any():
        return np.empty(0, np.uint64), np.empty(0, np.uint64), none, none, none
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + off[:-1][row]
    own = owner[at]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (row[1:] != row[:-1])]))
    last = np.append(first[1:], len(own)) - 1
    start, end = at[first], at[last] + length - GRAM
    content = (end - start).astype(np.uint64)
    for step in range(0, 2 * length, GRAM):  # grams that cover all of the stretch
        content = mix(content ^ h[np.minimum(start + step, end)]) * _P[0]
    return h[own[first]], content, row[first], start - off[row[first]], at[last] - off[row[first]]


def suffix_array(data: np.ndarray, depth: int):
    """Positions sorted by their next ``depth`` bytes, and the rank of each position.

    Larsson-Sadakane: sort by eight bytes, then double the sorted length; each
    round touches only groups that are still undecided, ordering them by the
    rank of the position one sorted length further on.
    """
    n = len(data)
    words = eight_bytes(data)
    sa = np.argsort(words)
    sorted_words = words[sa]
    new = np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]])
    place = np.arange(n)
    group = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = group
    done = 8
    while done < depth:
        step = min(done, depth - done)
        todo = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(todo):
            break
        at = sa[todo]
        after = at + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = (group[todo] << 32) | second
        order = np.argsort(key)
        sa[todo] = at[order]
        key = key[order]
        new[todo] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(new, place, 0))
        rank[sa[todo]] = group[todo]
        done += step
    return sa, rank


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number (zeros past the end)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(n, np.uint64)
    for b in range(8):
        out = (out << np.uint64(8)) | padded[b:n + b]
    return out


def common_prefixes(words: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Kasai's table up to ``depth``: the bytes that each entry of ``sa`` shares with the one before.

    As in Kasai's sweep the pairs are taken in text order (position and its
    predecessor in ``sa``); eight bytes are compared at a time, for all pairs
    that have been equal so far.
    """
    before = np.empty(len(words), np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.sort(sa[1:])
    lcp = np.zeros(len(words), np.int16)
    done = 0
    while done < depth and len(at):
        step = min(8, depth - done)
        # the last comparison may overlap the one before
        from_ = done if step == 8 else depth - 8
        x = words[at + from_] ^ words[before[at] + from_]
        same = x == 0
        part = at[~same]
        if len(part):
            bits = np.floor(np.log2(x[~same].astype(np.float64))).astype(np.int16)
            lcp[part] = np.minimum(from_ + 7 - np.minimum(bits, 63) // 8, depth)
        at = at[same]
        done += step
    lcp[at] = depth
    return lcp[sa]


def mark_repeats(blob: np.ndarray, off: np.ndarray, doc: np.ndarray, lo: np.ndarray,
                 length: int = LENGTH):
    """Windows of some stretches that also start earlier in them.

    ``blob`` holds the stretches' bytes, ``off`` their bounds, ``doc`` and ``lo``
    say where each begins. Returns (stretch, position in it) of all windows and
    a flag for those that are repeats.
    """
    count = np.maximum(np.diff(off) - length + 1, 0)
    stretch = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(stretch)) - np.repeat(np.cumsum(count) - count, count)
    repeat = np.zeros(len(stretch), bool)
    if len(stretch) < 2:
        return stretch, inner, repeat
    at = off[:-1][stretch] + inner
    number = np.full(len(blob), -1, np.int64)
    number[at] = np.arange(len(at))
    sa, _ = suffix_array(blob, length)
    sa = sa[number[sa] >= 0]
    equal = np.zeros(len(sa), bool)
    equal[1:] = common_prefixes(eight_bytes(blob), sa, length)[1:] >= length
    in_group = equal | np.append(equal[1:], False)
    group = np.cumsum(~equal)[in_group]
    w = number[sa[in_group]]
    order = np.lexsort((lo[stretch[w]] + inner[w], doc[stretch[w]], group))
    group, w = group[order], w[order]
    repeat[w[1:][group[1:] == group[:-1]]] = True
    return stretch, inner, repeat


def _united(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Intervals united within each document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    base = np.cumsum(first) * np.int64(1 << 40)  # keeps one document's ends below the next one's
    reach = np.maximum.accumulate(base + end)
    cut_ = np.flatnonzero(first | (base + start > np.concatenate([[0], reach[:-1]])))
    return doc[cut_], start[cut_], (reach - base)[np.append(cut_[1:], len(doc)) - 1]


class _Shards:
    """Takes stretches in the order of their grams and yields repeated intervals shard by shard."""

    def __init__(self, length: int, shard_bytes: int):
        self.length, self.limit = length, shard_bytes
        self.rows: list[tuple[int, int, int, bytes]] = []
        self.group: list[tuple[int, int, int, bytes]] = []
        self.size = 0
        self.gram, self.known = None, np.empty(0, f"S{length}")

    def add(self, gram: int, doc: int, lo: int, text: bytes) -> bool:
        """Take one stretch; true if the shard is full."""
        if self.group and gram != self.group[0][0]:
            self._close()
        self.group.append((gram, doc, lo, text))
        self.size += len(text)
        return self.size >= self.limit

    def _close(self):
        """A gram with one stretch repeats nothing, unless the shard before has some of it."""
        if len(self.group) > 1 or self.group and self.group[0][0] == self.gram:
            self.rows += self.group
        else:
            self.size -= sum(len(r[3]) for r in self.group)
        self.group = []

    def flush(self, end: bool = False):
        """The repeated intervals of the shard; its last gram may go on in the next one."""
        if end:
            self._close()
        else:
            self.rows, self.group = self.rows + self.group, []
        rows, self.rows, self.size = self.rows, [], 0
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        n = self.length
        doc, lo = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        off = np.cumsum([0] + [len(r[3]) for r in rows])
        blob = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        stretch, inner, repeat = mark_repeats(blob, off, doc, lo, n)

        def strings(which):
            at = (off[:-1][stretch[which]] + inner[which])[:, None] + np.arange(n)
            return blob[at].reshape(-1).view(f"S{n}")
        # the shard before this one held earlier rows of its last gram: binary search
        if len(self.known) and rows[0][0] == self.gram:
            to = next((i for i, r in enumerate(rows) if r[0] != self.gram), len(rows))
            mine = np.flatnonzero(stretch < to)
            s = strings(mine)
            found = np.minimum(np.searchsorted(self.known, s), len(self.known) - 1)
            repeat[mine[self.known[found] == s]] = True
        last = rows[-1][0]
        begin = next(i for i, r in enumerate(rows) if r[0] == last)
        new = np.unique(strings(np.flatnonzero((stretch >= begin) & ~repeat)))
        if last == self.gram:
            new = np.unique(np.concatenate([self.known, new]))
        self.gram, self.known = last, new
        d, p = doc[stretch[repeat]], lo[stretch[repeat]] + inner[repeat]
        return _united(d, p, p + n)


_STRETCH = "gram bigint, content bigint, ord bigint, lo bigint, hi bigint, known boolean"


def _grams(docs: DataFrame, length: int) -> DataFrame:
    """All stretches: gram, content, ord, first window lo, end of the last one hi.

    Copies that a task sees itself come as known repeats, united, on their own.
    """
    def settle(parts):
        gram, content, doc, lo, hi = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((lo, doc, content, gram))
        gram, content, doc, lo, hi = (x[order] for x in (gram, content, doc, lo, hi))
        copy = np.zeros(len(gram), bool)
        copy[1:] = (gram[1:] == gram[:-1]) & (content[1:] == content[:-1])
        d, a, z = _united(doc[copy], lo[copy], hi[copy])
        known = np.repeat([False, True], [int((~copy).sum()), len(d)])
        columns = [[gram[~copy], mix(d.view(np.uint64))], [content[~copy], np.zeros(len(d), np.uint64)],
                   [doc[~copy], d], [lo[~copy], a], [hi[~copy], z]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).view(np.int64)) for c in columns] + [pa.array(known)],
            ["gram", "content", "ord", "lo", "hi", "known"])

    def run(batches):
        parts, rows = [], 0
        for b in slices(batches):
            gram, content, row, lo, hi = stretches(*text_bytes(b.column("text")), length)
            parts.append((gram, content, b.column("ord").to_numpy()[row], lo, hi + length))
            rows += len(gram)
            if rows >= LOCAL_ROWS:
                yield settle(parts)
                parts, rows = [], 0
        if rows:
            yield settle(parts)
    return docs.mapInArrow(run, _STRETCH)


def _meet(found: DataFrame) -> DataFrame:
    """Repeats (gram null), and the stretches whose gram has several contents.

    Runs over each partition in the order of gram, content and place, with one
    stretch held back, so a gram of any size needs no memory.
    """
    names = ["gram", "ord", "lo", "hi"]

    def out(gram, doc, lo, hi):
        return pa.RecordBatch.from_arrays([gram, *map(pa.array, (doc, lo, hi))], names)

    def run(batches):
        held = np.empty((5, 0), np.int64)  # the last distinct stretch: gram, content, ord, lo, hi
        several = False                    # whether its gram had one before it
        for b in batches:
            known = b.column("known")
            x = np.stack([b.column(c).to_numpy() for c in ("gram", "content", "ord", "lo", "hi")])
            is_known = np.asarray(known.to_pylist(), bool)
            done, x = x[:, is_known], np.concatenate([held, x[:, ~is_known]], 1)
            if x.shape[1]:
                copy = np.zeros(x.shape[1], bool)
                copy[1:] = (x[0, 1:] == x[0, :-1]) & (x[1, 1:] == x[1, :-1])
                done = np.concatenate([done, x[:, copy]], 1)
                x = x[:, ~copy]
                like = np.zeros(x.shape[1] + 1, bool)
                like[1:-1] = x[0, 1:] == x[0, :-1]
                like[0] = several
                go = (like[:-1] | like[1:])[:-1]
                send, held, several = x[:, :-1][:, go], x[:, -1:], bool(like[-2])
                yield out(pa.array(send[0]), *send[2:])
            yield out(pa.nulls(done.shape[1], pa.int64()), *done[2:])
        if several:
            yield out(pa.array(held[0]), *held[2:])
    return found.repartition("gram").sortWithinPartitions("gram", "content", "ord", "lo") \
        .mapInArrow(run, "gram bigint, ord bigint, lo bigint, hi bigint")


_OUT = "gram bigint, ord bigint, lo bigint, hi bigint, body binary"


def _send(docs: DataFrame, length: int) -> DataFrame:
    """Stretches with their bytes, each content once for each task; later copies as intervals.

    An interval (body null) says that ord's bytes lo to hi are repeats already.
    """
    def run(batches):
        first: dict[tuple[int, bytes], tuple[int, int]] = {}
        held = 0

        def batch(rows, settled):
            doc, lo, hi = _united(*(np.array([s[i] for s in settled], np.int64) for i in range(3)))
            spread = mix(doc.view(np.uint64)).view(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array([g for g, _ in rows], pa.int64()), pa.array(spread)]),
                pa.concat_arrays([pa.array([first[r][0] for r in rows], pa.int64()), pa.array(doc)]),
                pa.concat_arrays([pa.array([first[r][1] for r in rows], pa.int64()), pa.array(lo)]),
                pa.concat_arrays([pa.array([first[r][1] + len(r[1]) for r in rows], pa.int64()),
                                  pa.array(hi)]),
                pa.array([r[1] for r in rows] + [None] * len(doc), pa.binary())],
                ["gram", "ord", "lo", "hi", "body"])

        for b in batches:
            settled = []
            for ord_, text, found in zip(b.column("ord").to_pylist(),
                                         b.column("text").cast(pa.binary()),
                                         b.column("found")):
                if not found.is_valid:
                    continue
                text = text.as_buffer().to_pybytes()
                for s in found.as_py():
                    lo, hi, gram = s["lo"], s["hi"], s["gram"]
                    if s["hot"]:  # single windows, by their own hash
                        own = gram_hashes(np.frombuffer(text[lo:hi], np.uint8))
                        n = hi - lo - length + 1
                        own = mix(own[:n] ^ mix(own[length - GRAM:][:n]))
                        pieces = [(int(g), lo + j, text[lo + j:lo + j + length])
                                  for j, g in enumerate(own.view(np.int64))]
                    else:
                        pieces = [(gram, lo, text[lo:hi])]
                    for g, at, body in pieces:
                        key, here = (g, body), (ord_, at)
                        seen = first.get(key)
                        if seen is None:
                            first[key] = here
                            held += len(body) + 150
                        else:
                            if here < seen:
                                first[key], here = here, seen
                            settled.append((*here, here[1] + len(body)) if here != seen
                                           else (seen[0], seen[1], seen[1] + len(body)))
            if held > LOCAL_BYTES * 4 or settled:
                rows = list(first) if held > LOCAL_BYTES * 4 else []
                yield batch(rows, settled)
                if rows:
                    first.clear()
                    held = 0
        if first:
            yield batch(list(first), [])
    return docs.mapInArrow(run, _OUT)


def _shard(sent: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """ord, lo, hi of all repeats."""
    def run(batches):
        shards = _Shards(length, shard_bytes)

        def batch(doc, lo, hi):
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(hi)],
                                              ["ord", "lo", "hi"])
        for b in batches:
            body = b.column("body")
            ready = pa.compute.is_null(body)
            yield b.select(["ord", "lo", "hi"]).filter(ready)
            rest = b.filter(pa.compute.invert(ready))
            for row in zip(*(rest.column(c).to_pylist() for c in ("gram", "ord", "lo", "body"))):
                if shards.add(*row):
                    yield batch(*shards.flush())
        yield batch(*shards.flush(end=True))
    return sent.repartition("gram").sortWithinPartitions("gram", "ord", "lo") \
        .mapInArrow(run, "ord bigint, lo bigint, hi bigint")


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text, ord: the order of the documents, a number unlike any other's.

    Normally doc_id itself. With repeated or missing ids the rows of one id are
    ordered by text, and rows without id come last.
    """
    alike = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if not alike.limit(1).count():
        return docs.withColumn("ord", F.col("doc_id"))
    # numbered by a range sort, whatever the ids and however often one stands there
    laid = docs.select("doc_id", "text", F.col("doc_id").isNull().alias("last"), F.lit(0).alias("all"))
    placed = numbered(laid, "all", ["last", "doc_id", "text"])
    return cut(placed.select("doc_id", "text", F.col("rank").alias("ord")), "numbered")


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """ord, spans (array of lo, hi) of the documents that have repeats; ``docs`` has ord and text."""
    met = cut(_meet(_grams(docs.select("ord", "text"), length)), "stretches")
    several = met.where("gram IS NOT NULL")
    many = several.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot) \
        .select("gram", F.lit(True).alias("hot"))
    found = several.join(many, "gram", "left").groupBy("ord").agg(F.collect_list(F.struct(
        "lo", "hi", "gram", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("found"))
    sent = _send(docs.select("ord", "text").join(found, "ord", "left"), length)
    spans = _shard(sent, length, shard_bytes).unionByName(
        met.where("gram IS NULL").select("ord", "lo", "hi"))
    return cut(spans.groupBy("ord").agg(
        F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, hot: int = HOT,
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    ``kept`` is what is left of the text's UTF-8 bytes (binary: a cut may fall
    inside a character). Earlier means a smaller doc_id, or an earlier start in
    the same document; of rows with one doc_id the smaller text is earlier, and
    rows without doc_id come last. A null text counts as empty; texts shorter
    than ``length`` bytes lose nothing. No rows give no rows. Other columns are
    ignored, whatever their names.
    """
    text = _numbered(text_only(docs, id_col, text_col))
    spans = repeated_spans(text, length, hot, shard_bytes)
    joined = text.join(spans, "ord", "left").select("doc_id", "text", "spans")
    schema = ("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
              "kept_sha256 string, kept binary")

    def run(batches):
        for b in batches:
            n, gone, runs, kept = [], [], [], []
            for text, spans in zip(b.column("text").cast(pa.binary()), b.column("spans")):
                raw = text.as_buffer().to_pybytes()
                n.append(len(raw))
                if not spans.is_valid:
                    kept.append(raw)
                    gone.append(0)
                    runs.append(0)
                    continue
                lo, hi = (np.array([s[k] for s in spans.as_py()], np.int64) for k in ("lo", "hi"))
                _, lo, hi = _united(np.zeros(len(lo), np.int64), lo, hi)
                parts = [raw[a:z] for a, z in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)])]
                kept.append(b"".join(parts))
                gone.append(int((hi - lo).sum()))
                runs.append(len(lo))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(runs, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                 pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return joined.mapInArrow(run, schema)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS x
      FROM (SELECT doc_id, unnest(range(0, len(h) // 2 - 99)) AS p, h FROM d)),
v AS (SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS nth FROM w),
g AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100
                             THEN 0 ELSE 1 END AS new FROM v WHERE nth > 1),
r AS (SELECT doc_id, min(p) AS lo, max(p) + 100 AS hi FROM (
        SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g)
      GROUP BY doc_id, k),
k AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS from_
      FROM r),
parts AS (
  SELECT k.doc_id, from_, substr(h, 2 * from_ + 1, 2 * (lo - from_)) AS part
  FROM k JOIN d USING (doc_id)
  UNION ALL
  SELECT d.doc_id, e.hi, substr(d.h, 2 * e.hi + 1)
  FROM d JOIN (SELECT doc_id, max(hi) AS hi FROM r GROUP BY doc_id) e USING (doc_id)
  UNION ALL
  SELECT doc_id, 0, h FROM d WHERE doc_id NOT IN (SELECT doc_id FROM r)),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY from_) AS h FROM parts GROUP BY doc_id),
n AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

QUERIES = {"op2_substring_dedup": op2_substring_dedup}
ORACLES = {"op2_substring_dedup": ORACLE}
