"""Operator 3: SentencePiece encoding and decoding by a shared-prefix Viterbi.

A text is cut into marked words (a run of U+2581 word marks and what follows it); no
piece of the vocabulary crosses such a border, so words are encoded one by one. The
distinct words of a batch are sorted, which lines them up as a depth-first walk of
their trie: each word keeps the forward states of the prefix that it shares with the
word before and computes only the rest. A forward state depends on the prefix alone.

* Unigram models: the state is the best score that ends at the position and the piece
  that reaches it (plain Viterbi).
* BPE models: the greedy merges of a prefix end in exactly one piece, the one whose
  left neighbour it is stable with (merging the two pieces' text gives the two pieces
  back). So the lattice has one admissible path, the scores of its steps being 0 or
  minus infinity, and the walk finds the same pieces as the merges.

Words with two or more marks in a row (repeated blanks) have pieces of equal score
there, where the order of the merges decides; these few go through the merges
themselves. Characters outside the vocabulary become byte pieces, or the unknown piece
where the model has none.

The encoding is that of the SentencePiece library for models with the identity
normalizer (the dummy prefix is honoured); other normalizers are refused. A literal
U+2581 in a text decodes to a blank, as there.

Defined results: a null text has null ids, an empty one no ids; repeated rows are
encoded alike; an empty table gives an empty result. Extra columns are carried, result
columns replace input columns of the same name. Nothing is shuffled.
"""

from __future__ import annotations

import gc
import heapq
import re
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from voltcube.llm.common import add_columns, small_batches, with_fields

MARK = "▁"
NEVER = float("inf")
#: Marks cache keys that hold a whole word; texts that contain it go by the pattern.
LINE = "\x1e"
#: Words and pairs of pieces kept between batches (about 250 and 100 bytes each); bytes of text encoded together.
CACHE_WORDS, CACHE_PAIRS, BATCH_BYTES = 1 << 18, 1 << 18, 2 << 20


@contextmanager
def no_cycles():
    """Python's search for reference cycles put off: the encoder makes none, and with the kept words the search
    would walk over some 100,000 objects again and again. Objects go by their reference counts as ever."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def fields_of(data: bytes):
    """(number, value) of each field of a protocol buffer message; value: int or bytes."""
    def varint(at):
        n = shift = 0
        while True:
            b = data[at]
            n |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return n, at
    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            v, at = varint(at)
        else:
            n, at = varint(at) if kind == 2 else (8 if kind == 1 else 4, at)
            v, at = data[at:at + n], at + n
        yield tag >> 3, v


@dataclass
class Vocabulary:
    """What encoding needs of a SentencePiece model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]                  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
    unigram: bool
    dummy_prefix: bool
    byte_ids: list[int] | None
    unk: int
    ids: dict[str, int] = field(default_factory=dict)
    longest: int = 0

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls.parse(Path(path).read_bytes())

    @classmethod
    def parse(cls, data: bytes) -> Vocabulary:
        pieces, scores, kinds, trainer, normalizer = [], [], [], {}, {}
        for number, value in fields_of(data):
            if number == 1:
                f = dict(fields_of(value))
                pieces.append(f[1].decode())
                scores.append(float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0]))
                kinds.append(f.get(3, 1))
            elif number == 2:
                trainer = dict(fields_of(value))
            elif number == 3:
                normalizer = dict(fields_of(value))
        if normalizer.get(1, b"") != b"identity" or normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only models with the identity normalizer that keep all blanks are encoded")
        if trainer.get(3, 1) not in (1, 2) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only unigram and BPE models with word marks in front are encoded")
        ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == 1}
        if 4 in kinds or 5 in kinds or any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("user-defined and unused pieces, and pieces over a word border, are not handled")
        byte_ids = [i for i, k in enumerate(kinds) if k == 6]
        return cls(pieces, scores, kinds, trainer.get(3, 1) == 1, bool(normalizer.get(3, 1)), byte_ids if len(byte_ids) == 256 else None,
                   kinds.index(2), ids, max(map(len, ids), default=1))


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.stable: dict[int, bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}
        lowest = min((vocab.scores[i] for i in vocab.ids.values()), default=0.0)
        self.unk_score = lowest - 10.0
        self.rank = {p: -vocab.scores[i] for p, i in vocab.ids.items()}.get
        # Ends of pieces: the id where the end is a piece itself, else -1.
        self.tails = {p[i:]: -1 for p in vocab.ids for i in range(len(p))} | vocab.ids
        self.line_ends = "\n" not in vocab.ids
        line = "\n" if self.line_ends else ""
        # A line end that the vocabulary lacks is a word of its own.
        self.words = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (r"|\n" if line else ""))
        text = [bytes([i - vocab.byte_ids[0]]) if vocab.byte_ids and vocab.kinds[i] == 6 else b"" if vocab.kinds[i] == 3 else
                " ⁇ ".encode() if vocab.kinds[i] == 2 else p.replace(MARK, " ").encode() for i, p in enumerate(vocab.pieces)]
        self.text = text
        self.text_len = np.array([len(t) for t in text], np.int64)
        self.text_at = np.concatenate([[0], np.cumsum(self.text_len)])
        self.text_bytes = np.frombuffer(b"".join(text), np.uint8)

    # -- merges ---------------------------------------------------------------
    def merge(self, word: str) -> list[int]:
        """Pieces by greedy merges: best score first, leftmost among equals."""
        ids, scores = self.v.ids, self.v.scores
        sym: list[str | None] = list(word)
        prev, nxt = [*range(-1, len(sym) - 1)], [*range(1, len(sym) + 1)]
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < len(sym) and (k := ids.get(both := sym[i] + sym[j])) is not None:
                heap.append((-scores[k], i, both)) if not started else heapq.heappush(heap, (-scores[k], i, both))

        started = False
        for i in range(len(sym) - 1):
            offer(i)
        heapq.heapify(heap)
        started = True
        while heap:
            _, i, both = heapq.heappop(heap)
            if sym[i] is None or (j := nxt[i]) >= len(sym) or sym[i] + sym[j] != both:
                continue
            sym[i], sym[j], nxt[i] = both, None, nxt[j]
            if nxt[j] < len(sym):
                prev[nxt[j]] = i
            if prev[i] >= 0:
                offer(prev[i])
            offer(i)
        return [ids.get(s, -ord(s) - 1 if len(s) == 1 else -1) for s in sym if s is not None]

    def is_stable(self, a: int, b: int) -> bool:
        key = a << 32 | b
        if (s := self.stable.get(key)) is None:
            if len(self.stable) > CACHE_PAIRS:
                self.stable.clear()
            s = self.stable[key] = self._stays(self.v.pieces[a], self.v.pieces[b])
        return s

    def _stays(self, a: str, b: str) -> bool:
        """Whether the merges of a + b never cross the border between them."""
        rank, sym = self.rank, [*a, *b]
        ranks = [rank(x + y, NEVER) for x, y in zip(sym, sym[1:], strict=False)]
        border = len(a) - 1                      # of the pair over it
        while (best := min(ranks)) != NEVER:
            i = ranks.index(best)
            if i == border:
                return False
            border -= i < border
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(sym[i - 1] + sym[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank(sym[i] + sym[i + 1], NEVER)
        return True

    # -- the walk -------------------------------------------------------------
    def walk(self, words: list[str]) -> list[list[int]]:
        """Pieces of each word of a sorted list. Unknown characters are negative: -1 - code point."""
        grow = self._grow_unigram if self.v.unigram else self._grow_merges
        # Per position of the current path: the piece that ends there, where it starts, its best score.
        piece, start, score = [0], [0], [0.0]
        before, out = "", []
        for word in words:
            n, keep = len(word), 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                keep += 1
            del piece[keep + 1:], start[keep + 1:], score[keep + 1:]
            grow(word, keep, piece, start, score)
            path, at = [], n
            while at:
                path.append(piece[at])
                at = start[at]
            path.reverse()
            out.append(path)
            before = word
        return out

    def _grow_unigram(self, word, keep, piece, start, score) -> None:
        for end in range(keep + 1, len(word) + 1):
            best_p, best_s, best = -1 - ord(word[end - 1]), end - 1, score[end - 1] + self.unk_score
            if word[end - 1] in self.v.ids:
                best = -np.inf
            for s in range(end - 1, -1, -1):
                if (p := self.tails.get(word[s:end])) is None:
                    break
                if p >= 0 and score[s] + self.v.scores[p] >= best:
                    best_p, best_s, best = p, s, score[s] + self.v.scores[p]
            piece.append(best_p)
            start.append(best_s)
            score.append(best)

    def _grow_merges(self, word, keep, piece, start, score) -> None:
        tails, stable = self.tails.get, self.stable.get
        for end in range(keep + 1, len(word) + 1):
            s = end - 1
            while s >= 0:
                if (p := tails(word[s:end])) is None:
                    s = -1
                    break
                if p >= 0:
                    if not s or (left := piece[s]) < 0:
                        break
                    if (ok := stable(left << 32 | p)) is None:
                        ok = self.is_stable(left, p)
                    if ok:
                        break
                s -= 1
            if s < 0:
                p, s = -1 - ord(word[end - 1]), end - 1
            piece.append(p)
            start.append(s)

    def final(self, path: list[int]) -> tuple[int, ...]:
        """Ids; unknown characters as bytes, or as one unknown piece for a run of them."""
        if min(path, default=0) >= 0:
            return tuple(path)
        out: list[int] = []
        for p in path:
            if p >= 0:
                out.append(p)
            elif self.v.byte_ids:
                out += [self.v.byte_ids[b] for b in chr(-1 - p).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.v.unk:
                out.append(self.v.unk)
        return tuple(out)

    def split(self, text: str) -> list[str]:
        """The marked words, written as cache keys: the word itself if one mark stands before it, else LINE and
        the whole word."""
        if not self.v.dummy_prefix or not text or text[0] == " " or "  " in text or MARK in text or LINE in text:
            return [LINE + w for w in self.words.findall((MARK if self.v.dummy_prefix and text else "") + text.replace(" ", MARK))]
        if not self.line_ends or "\n" not in text:
            return text.split(" ")
        out: list[str] = []
        for line in text.split("\n"):
            words = line.split(" ")
            if out:
                out.append(LINE + "\n")
                if words[0]:
                    out.append(LINE + words[0])
                out += words[1:]
            else:
                out = words
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        with no_cycles():
            return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        cache = self.cache
        new = {w for ws in split for w in ws if w not in cache}
        if len(cache) + len(new) > CACHE_WORDS:       # words of these texts stay
            cache = self.cache = {w: cache[w] for ws in split for w in ws if w in cache}
        keys = {w[1:] if w[:1] == LINE else MARK + w: w for w in new}
        plain = sorted(w for w in keys if self.v.unigram or MARK + MARK not in w)
        for w, path in zip(plain, self.walk(plain), strict=True):
            cache[keys[w]] = self.final(path)
        for w in keys.keys() - set(plain):
            cache[keys[w]] = self.final(self.merge(w))
        for w in new:                             # the same word under both kinds of keys
            if w not in cache:
                cache[w] = cache[keys[w[1:] if w[:1] == LINE else MARK + w]]
        return [np.array([*chain.from_iterable(map(cache.__getitem__, ws))], np.int32) for ws in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        n = self.text_len[ids]
        at = np.repeat(self.text_at[ids] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(ids) else np.zeros(0, np.int64)
        text = self.text_bytes[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.v.dummy_prefix and text.startswith(" ") else text


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The worker's encoder for a broadcast vocabulary, so that its words serve later tasks as well."""
    if shared.value.pieces and (e := _ENCODERS.get(key := hash((len(shared.value.pieces), shared.value.pieces[-1], shared.value.unigram)))) is None:
        _ENCODERS.clear()
        e = _ENCODERS[key] = Encoder(shared.value)
    return e


def encode(docs: DataFrame, vocab: Vocabulary, *, text: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_pieces``; with ``check`` also ``intact``: whether
    decoding the ids gives the text back."""
    docs = docs.drop("ids", "n_pieces", *["intact"] * check)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        e = _encoder(shared)
        for b in small_batches(batches, text, BATCH_BYTES):
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            got = e.encode([t or "" for t in texts])
            null = np.array([t is None for t in texts], bool)
            n = np.array([len(g) for g in got], np.int32)
            flat = pa.array(np.concatenate([*got, np.zeros(0, np.int32)]).astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), mask=np.append(null, False))
            more = {"intact": pa.array([None if t is None else e.decode(g) == t for t, g in zip(texts, got, strict=True)], pa.bool_())} if check else {}
            yield add_columns(b, ids=pa.ListArray.from_arrays(offsets, flat), n_pieces=pa.array(n.astype(np.int64), mask=null), **more)

    fields = {"ids": T.ArrayType(T.IntegerType()), "n_pieces": T.LongType()} | ({"intact": T.BooleanType()} if check else {})
    return docs.mapInArrow(run, with_fields(docs, **fields))


def decode(rows: DataFrame, vocab: Vocabulary, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids."""
    rows = rows.drop(into)
    shared = rows.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        e = _encoder(shared)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                col = part.column(part.schema.get_field_index(ids))
                texts = [e.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else None for x in col]
                yield add_columns(part, **{into: pa.array(texts, pa.string())})

    return rows.mapInArrow(run, with_fields(rows, **{into: T.StringType()}))


def round_trip(docs: DataFrame, vocab: Vocabulary, *, text: str = "text") -> DataFrame:
    """``encode`` and, in the same pass, the check that decoding gives the text back."""
    return encode(docs, vocab, text=text, check=True)
