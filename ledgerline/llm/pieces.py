"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The distinct marked words of a piece of a table are sorted, which lays them out
as a trie in depth-first order: a word takes over the forward states of the
prefix it shares with the word before it, and only its new positions are
computed. A forward state is the best way to cut the prefix that ends there.

* unigram models: the state is the best sum of piece scores (ordinary Viterbi);
* BPE models: merges do not add up to a sum of scores, so the state is the last
  piece of the prefix's one valid cut: a cut is the merge result exactly when
  merging any two neighbouring pieces by themselves gives these two back, which
  is told by undoing their merges, latest first.

A worker remembers the ids of words in flat arrays, looked up by the hash of
many words at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, table, text_bytes, text_only, word_hashes

MARK = "▁"
#: Bytes of remembered words in a worker (key, length, place, use and ids of each); beyond
#: that the less used half is forgotten. A reused worker keeps them between stages.
CACHE_BYTES = 48 << 20
#: Pairs of neighbouring pieces that are remembered; beyond that it starts anew.
CACHE_PAIRS = 200_000
#: Words of more bytes are cut each time they come and not remembered.
LONG_WORD = 512
#: Bytes of text hashed at once.
HASH_BYTES = 512 << 10


class Words:
    """Ids of words by the words' 64-bit hash and length, in arrays sorted by hash."""

    def __init__(self):
        self.key = np.empty(0, np.uint64)
        self.size = np.empty(0, np.int32)   # bytes of the word: another word of that hash is unknown
        self.at, self.n, self.used = (np.empty(0, np.int32) for _ in range(3))
        self.ids, self.end = np.empty(1 << 16, np.int32), 0

    def nbytes(self) -> int:
        return 4 * self.end + 24 * len(self.key)

    def find(self, key: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key (sorted) is or would be, and whether it is there."""
        at = np.searchsorted(self.key, key)
        if not len(self.key):
            return at, np.zeros(len(key), bool)
        near = np.minimum(at, len(self.key) - 1)
        return at, (self.key[near] == key) & (self.size[near] == size)

    def add(self, key: np.ndarray, size: np.ndarray, ids: list[list[int]]) -> None:
        """Words that are not there; of two with one hash the first stays."""
        at, _ = self.find(key, size)
        clash = np.zeros(len(key), bool)
        if len(self.key):
            clash = self.key[np.minimum(at, len(self.key) - 1)] == key
        new = [x for x, c in zip(ids, clash.tolist(), strict=True) if not c]
        key, size, at = key[~clash], size[~clash], at[~clash]
        n = np.array([len(x) for x in new], np.int32)
        flat = np.array([i for x in new for i in x], np.int32)
        while self.end + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.end:self.end + len(flat)] = flat
        begin = (self.end + np.cumsum(n) - n).astype(np.int32)
        self.end += len(flat)
        self.key, self.size = np.insert(self.key, at, key), np.insert(self.size, at, size)
        self.at, self.n = np.insert(self.at, at, begin), np.insert(self.n, at, n)
        self.used = np.insert(self.used, at, 0)

    def forget(self, most: int) -> None:
        """The less used half goes if there are more than ``most`` bytes; uses count half from then on."""
        if self.nbytes() <= most:
            return
        keep = np.sort(np.argsort(-self.used, kind="stable")[:len(self.key) // 2])
        n = self.n[keep]
        flat = self.ids[np.repeat(self.at[keep] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        self.key, self.size, self.used, self.n = self.key[keep], self.size[keep], self.used[keep] // 2, n
        self.at, self.ids, self.end = (np.cumsum(n) - n).astype(np.int32), flat, len(flat)
        if not len(self.ids):
            self.ids = np.empty(1 << 16, np.int32)


class Pieces:
    """A SentencePiece model's vocabulary with its encoder and decoder.

    Spaces become the mark, one more mark goes in front of a text that is not
    empty, characters without a piece become their UTF-8 byte pieces (or the
    unknown piece where the model has none). No other normalisation is done.
    """

    def __init__(self, proto: bytes, kind: str = "bpe"):
        import sentencepiece  # only to read the vocabulary out of the file
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.kind, self.unk = kind, sp.unk_id()
        self.ids, self.scores, self.bytes_, self.raw = {}, {}, {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = bytes([int(piece[3:5], 16)])
                self.bytes_[value[0]] = i
                self.raw.append(value)
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append("⁇".encode() if sp.is_unknown(i) else b"")
            else:
                self.raw.append(piece.replace(MARK, " ").encode())
                if not sp.is_unused(i):
                    self.ids[piece], self.scores[piece] = i, sp.get_score(i)
        by_end: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 3:
                by_end.setdefault(p[-4:], set()).add(len(p))
        self._len = np.array([len(x) for x in self.raw], np.int64)
        self._at = np.cumsum(self._len) - self._len
        self._buffer = np.frombuffer(b"".join(self.raw), np.uint8)
        #: Lengths of the pieces of four characters or more by their last four, longest first.
        self.lengths = {end: sorted(n, reverse=True) for end, n in by_end.items()}
        #: Without a piece that has a mark after another character, words are cut independently.
        self.whole = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.floor = min(self.scores.values(), default=0.0) - 10.0
        self.text = {i: p for p, i in self.ids.items()}
        self._halves: dict[int, tuple[float, int, int]] = {}
        self._pairs: dict[int, bool] = {}
        self._words = Words()

    # -- forward states -------------------------------------------------
    def _made(self, piece: int) -> tuple[float, int, int]:
        """When a piece's last merge comes (early: small) and the two pieces that it joins.

        Characters, known or not (then ``~code point``), are there from the
        start: -inf. A piece that merging does not make of its characters never comes: inf.
        """
        found = self._halves.get(piece)
        if found is None:
            text = self.text.get(piece) or chr(~piece)
            parts, last = list(text), (-1, -1)
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    s = self.scores.get(parts[i] + parts[i + 1])
                    if s is not None and (best is None or s > best):
                        best, at = s, i
                if best is None:
                    break
                last = tuple(self.ids.get(x, ~ord(x[0])) for x in parts[at:at + 2])
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            when = -np.inf if len(text) == 1 else -self.scores[text] if len(parts) == 1 else np.inf
            found = self._halves[piece] = (when, *last)
        return found

    def _stay(self, a: int, b: int) -> bool:
        """Whether merging the text of two pieces gives these two back.

        Their merges are undone, the latest first; before one of them a merge across
        the border would have come if it comes earlier (or as early, where it is to the left).
        """
        made, text, ids = self._made, self.text, self.ids
        (when_a, _, right), (when_b, left, _) = made(a), made(b)
        if np.inf in (when_a, when_b):
            return False
        limit, as_early = np.inf, False
        while True:
            across = ids.get((text.get(a) or chr(~a)) + (text.get(b) or chr(~b)))
            if across is not None:
                comes = -self.scores[text[across]]
                if comes < limit or (as_early and comes == limit):
                    return False
            if when_a > when_b:
                limit, as_early, a = when_a, False, right
                when_a, _, right = made(a)
            elif when_b > -np.inf:
                limit, as_early, b = when_b, True, left
                when_b, left, _ = made(b)
            else:
                return True

    def _merged(self, words: list[str]) -> Iterable[list[int]]:
        """The pieces of each of the sorted words, an unknown character as ``~code point``.

        ``last[i]`` is the last piece of the cut of a word's first i characters and
        ``back[i]`` its length; a word keeps both up to the prefix that it shares with
        the word before.
        """
        before, last, back = "", [0], [0]
        pairs, base, known, lengths, short = self._pairs, 1 << 22, self.ids.get, self.lengths, (3, 2)
        for word in words:
            same, top = 0, min(len(word), len(before))
            while same < top and word[same] == before[same]:
                same += 1
            del last[same + 1:], back[same + 1:]
            if len(pairs) > CACHE_PAIRS:
                pairs.clear()
            for i in range(same + 1, len(word) + 1):
                for n in (*longer, 3, 2) if i > 3 and (longer := lengths.get(word[i - 4:i])) else short:
                    if n <= i and (piece := known(word[i - n:i])) is not None:
                        if n == i:
                            ok = self._made(piece)[0] < np.inf
                        else:
                            pair = last[i - n] * base + piece
                            ok = pairs.get(pair)
                            if ok is None:
                                ok = pairs[pair] = self._stay(last[i - n], piece)
                        if ok:
                            last.append(piece)
                            back.append(n)
                            break
                else:
                    piece = known(word[i - 1])
                    last.append(~ord(word[i - 1]) if piece is None else piece)
                    back.append(1)
            cut, i = [], len(word)
            while i:
                cut.append(last[i])
                i -= back[i]
            before = word
            cut.reverse()
            yield cut

    def _cuts(self, words: list[str]) -> Iterable[tuple[str, list[str]]]:
        """The pieces of each of the sorted words.

        ``last[i]`` is the last piece of the cut of a word's first i characters
        and ``total[i]`` its score; a word keeps both up to the prefix that it
        shares with the word before.
        """
        before, last, total = "", [""], [0.0]
        for word in words:
            same, top = 0, min(len(word), len(before))
            while same < top and word[same] == before[same]:
                same += 1
            del last[same + 1:], total[same + 1:]
            self._scored_step(word, last, total)
            cut, i = [], len(word)
            while i:
                cut.append(last[i])
                i -= len(last[i])
            before = word
            cut.reverse()
            yield word, cut

    def _scored_step(self, word: str, last: list[str], total: list[float]) -> None:
        known, floor = self.scores, self.floor
        for i in range(len(last), len(word) + 1):
            best, score = word[i - 1], total[i - 1] + known.get(word[i - 1], floor)
            for n in (*self.lengths.get(word[i - 4:i] if i > 3 else "", ()), 3, 2):
                if n <= i and (p := word[i - n:i]) in known and total[i - n] + known[p] > score:
                    best, score = p, total[i - n] + known[p]
            last.append(best)
            total.append(score)

    def _spelled(self, text: str) -> list[int]:
        """The ids of characters without a piece."""
        if self.bytes_:
            return [self.bytes_[x] for x in text.encode("utf-8", "replace")]
        return [self.unk] * len(text)

    def _ids(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of distinct words."""
        words = sorted(words)
        if self.kind == "bpe":
            cuts = zip(words, self._merged(words), strict=True)
            return {w: cut if min(cut) >= 0 else
                    [x for i in cut for x in ((i,) if i >= 0 else self._spelled(chr(~i)))]
                    for w, cut in cuts}
        return {w: [x for p in cut for x in
                    ((self.ids[p],) if p in self.ids else self._spelled(p))]
                for w, cut in self._cuts(words)}

    # -- whole texts ----------------------------------------------------
    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's begin (and the last one's end)."""
        return self.encode_bytes(*text_bytes(pa.array(texts, pa.large_string())))

    def encode_bytes(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for the bytes of texts and where each begins; a mark in a text counts as a space."""
        if raw.tobytes().find(MARK.encode()) >= 0:
            texts = [raw[a:z].tobytes().replace(MARK.encode(), b" ") for a, z in zip(off, off[1:])]
            raw = np.frombuffer(b"".join(texts), np.uint8)
            off = np.cumsum([0] + [len(t) for t in texts])
        # a space in front of each text that is not empty
        filled = np.diff(off) > 0
        put = off + np.concatenate([[0], np.cumsum(filled)])
        buf = np.full(put[-1], 32, np.uint8)
        own = np.ones(len(buf), bool)
        own[put[:-1][filled]] = False
        buf[own] = raw
        # a word: spaces and what follows up to the next space
        if self.whole:
            start = put[:-1][filled]
        else:
            space = buf == 32
            first = space.copy()
            first[1:] &= ~space[:-1]
            first[put[:-1][filled]] = True
            start = np.flatnonzero(first)
        end = np.append(start[1:], len(buf))
        of_text = np.searchsorted(start, put)
        flat, n = self._looked_up(buf, start, end)
        return flat, np.concatenate([[0], np.cumsum(n)])[of_text]

    def _looked_up(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray):
        """The ids of some words one after the other, and how many each has."""
        size = (end - start).astype(np.int32)
        short = np.flatnonzero(size <= LONG_WORD)
        key = np.empty(len(short), np.uint64)
        cuts = np.searchsorted(np.cumsum(size[short]), np.arange(0, size[short].sum(), HASH_BYTES))
        for a, z in zip(cuts, [*cuts[1:], len(short)]):
            key[a:z] = word_hashes(buf, start[short[a:z]], end[short[a:z]])
        key ^= size[short].astype(np.uint64)
        key, seen, of = np.unique(key, return_index=True, return_inverse=True)
        seen = short[seen]
        count = np.bincount(of, minlength=len(key)).astype(np.int32)

        def word(w: int) -> str:
            return buf[start[w]:end[w]].tobytes().decode().replace(" ", MARK)
        known = self._words
        at, there = known.find(key, size[seen])
        new, lone = np.flatnonzero(~there), {}
        if len(new):
            names = [word(w) for w in seen[new]]
            ids = self._ids(names)
            known.add(key[new], size[seen[new]], [ids[x] for x in names])
            at, there = known.find(key, size[seen])
            # words whose hash another word has (as good as never) are kept aside
            lone = {int(k): word(seen[k]) for k in np.flatnonzero(~there)}
        at = np.minimum(at, max(len(known.key) - 1, 0))
        known.used[at[there]] += count[there]

        n, begin = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        if len(known.key):
            n[short], begin[short] = known.n[at][of], known.at[at][of]
        aside = {int(w): word(w) for w in np.flatnonzero(size > LONG_WORD)}
        for k, name in lone.items():
            aside |= {int(w): name for w in short[np.flatnonzero(of == k)]}
        if aside:
            ids = self._ids(list(set(aside.values())))
            for w, name in aside.items():
                n[w], begin[w] = len(ids[name]), 0
        total = np.cumsum(n)
        place = np.repeat(begin - (total - n), n) + np.arange(int(total[-1]) if len(n) else 0)
        if aside:
            place = np.minimum(place, known.end)    # those of words aside are filled in below
        flat = known.ids[np.minimum(place, len(known.ids) - 1)]
        for w, name in aside.items():
            flat[total[w] - n[w]:total[w]] = ids[name]
        known.forget(CACHE_BYTES)
        return flat, n

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The texts of some runs of ids."""
        size = self._len[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        at = np.arange(total) + np.repeat(self._at[ids] - (end - size), size)
        raw = self._buffer[at].tobytes()
        bound = np.concatenate([[0], end])[off].tolist()
        texts = (raw[a:z] for a, z in zip(bound, bound[1:]))
        return [t[t[:1] == b" ":].decode("utf-8", "replace") for t in texts]


@lru_cache(maxsize=2)
def load(model: bytes, kind: str = "bpe") -> Pieces:
    """One per worker process, so tasks that follow reuse its words and pairs."""
    return Pieces(model, kind)


def model_bytes(path: str | None = None) -> bytes:
    """The model file; by default the 32,000-piece model of the installed vocabulary files."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


#: Ids that are decoded at once inside a task.
DECODE_IDS = 1 << 20


def _list_column(flat: np.ndarray, off: np.ndarray, null: list[bool]) -> pa.Array:
    offsets = pa.array(off.astype(np.int32))
    if any(null):
        return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array(null))
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def encode_pieces(docs: DataFrame, model: bytes, kind: str = "bpe", text_col: str = "text",
                  out_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with an array<int> column of piece ids.

    A null text has null ids, an empty one an empty array. Texts of any length
    are encoded whole. ``model`` is the file's content (a vocabulary, of the
    order of a megabyte, sent with the task). With ``decoded_col`` the ids are
    also decoded again, in the same pass. Rows are independent: repeated ones
    give equal results, an empty table an empty one; other columns are kept, but
    those named like the new ones give way.
    """
    docs = docs.drop(*[c for c in (out_col, decoded_col) if c and c != text_col])
    added = [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        added.append(T.StructField(decoded_col, T.StringType()))
    schema = T.StructType([*docs.schema.fields, *added])
    at = docs.columns.index(text_col)

    def run(batches):
        pieces = load(model, kind)
        for b in slices(batches, at):
            null = b.column(at).is_null().to_pylist()
            flat, off = pieces.encode_bytes(*text_bytes(b.column(at)))
            columns = [*b.columns, _list_column(flat, off, null)]
            if decoded_col:
                back = pieces.decode(flat, off)
                columns.append(pa.array([None if n else t for n, t in zip(null, back)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return docs.mapInArrow(run, schema)


def decode_pieces(docs: DataFrame, model: bytes, ids_col: str = "ids",
                  out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of its piece ids; null ids give a null text.

    Exact for every text without the mark character itself (U+2581), which
    SentencePiece cannot tell from a space. Repeated rows give equal texts, an
    empty table an empty one; a column named like the new one gives way.
    """
    docs = docs.drop(out_col) if out_col != ids_col else docs
    schema = T.StructType([*docs.schema.fields, T.StructField(out_col, T.StringType())])
    at = docs.columns.index(ids_col)

    def run(batches):
        pieces = load(model)
        for whole in batches:
            size = pa.compute.fill_null(pa.compute.list_value_length(whole.column(at)), 0)
            end = np.cumsum(size.to_numpy(zero_copy_only=False))
            first = 0
            while first < whole.num_rows:
                limit = (end[first - 1] if first else 0) + DECODE_IDS
                last = max(int(np.searchsorted(end, limit, side="right")), first + 1)
                b = whole.slice(first, last - first)
                ids, first = b.column(at), last
                off = np.concatenate([[0], np.cumsum(pa.compute.fill_null(
                    pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
                texts = pieces.decode(ids.flatten().to_numpy(), off)
                texts = [t if v else None for t, v in zip(texts, ids.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                                 names=schema.names)
    return docs.mapInArrow(run, schema)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and whether decoding gives the text back."""
    model = model_bytes()
    docs = table(spark, sf_dir, "documents")
    coded = encode_pieces(text_only(docs), model, decoded_col="decoded")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
ORACLES = {}
