"""Operator 12: phrases by mergeable Misra-Gries summaries, then counted exactly.

A phrase is 1 to 5 words in a row within a piece of a text, by language. Only phrases of at least
``least`` occurrences matter, and all their parts are as frequent, so:

1. Each task adds up the phrases of its texts, chunk by chunk (64-bit hashes of language and words),
   and sends the sums to hash partitions. A partition keeps one Misra-Gries summary: whenever it holds
   more counters than its capacity, the largest one beyond is taken off all. It drops what it took off
   at most from any count, and that is less than its mass over its capacity. Capacity exceeds four
   times mass over ``least``, so every phrase of ``least`` occurrences survives with most of its
   count. Partitions report what they took off; should one have taken off ``least`` or more (hashes
   that are dealt very unevenly), the pass is repeated with twice the capacity.
2. The sums went through the summaries to files, by partition. A second pass over them counts the
   survivors exactly. They are told to all tasks as a bitmap of fixed size (``BITS``), in which others
   may pass, but none is missed: the exact count decides.
3. This is done for one and two words first. Phrases of three to five words are only summed
   if all their word pairs are frequent.
4. Sums name a document (32 bits of its hash) that holds the phrase, and the least one counts: its
   owner. In a last pass over the texts owners spell their frequent phrases, so that a phrase is
   sent once, not by every task that meets it.
5. Parts are joined to phrases for the score; a phrase inside a longer one of the same count goes.

Words: A-Z lower-cased, pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``.

Defined results: null texts are empty; a null lang is ``und`` (and counted with texts of that lang); rows without
a doc_id or repeating one count each; phrases of equal rank in score and count follow the
bytes of their text; an empty table, or one without frequent phrases, gives an empty result.
Extra columns are ignored. Equal 64-bit hashes of different phrases within a task's chunk are taken as equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltcube.llm.common import cut, drop_path, small_batches

LONGEST = 5
UNKNOWN = "und"
#: Bits of the survivors' bitmap.
BITS = 1 << 26
#: Parts that a language's count is spread over where it is joined.
SALTS = 64
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


@dataclass(frozen=True)
class Sizes:
    """Memory of the passes; results are the same for any."""
    chunk: int = 1 << 21           # words of a chunk
    vocabulary: int = 1 << 19      # distinct words after which a chunk ends too
    counters: int = 1 << 19        # counters of a summary, about; phrases that a task adds up at a time
    slack: float = 4               # capacity over mass / least


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(text: str | None) -> list[list[bytes]]:
    """Words of each piece that has any."""
    data = (text or "").encode("utf-8", "surrogatepass").lower().translate(_ENDS)
    # What split() takes as white space besides blanks and tabs has ended pieces already.
    return [w for p in data.split(b"\n") if (w := p.split())]


class _Ids(dict):
    """Numbers words (or languages) by first appearance."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Chunk:
    """Words of a number of texts as numbers, with the end of each word's piece, its language and document."""

    def __init__(self, words, langs, ids, ends, lang, doc):
        self.words, self.langs = words, langs               # distinct ones, in the order of their numbers
        self.ids, self.lang, self.doc = ids, lang, doc
        self.room = ends - np.arange(len(ids))              # words from each one to the end of its piece
        by_word = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        by_lang = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"), 7) for x in langs], np.uint64)
        self.hash = by_word[ids]
        self.seed = by_lang[lang]

    def phrases(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every phrase of so many words."""
        at = np.flatnonzero(self.room >= order)
        h = self.seed[at] + np.uint64(order)
        for j in range(order):
            h = _mix(h * _M[0] + self.hash[at + j])
        return at, h

    def text(self, start: int, order: int) -> bytes:
        return b" ".join(self.words[i] for i in self.ids[start:start + order])


def chunks(batches, sizes: Sizes) -> Iterator[Chunk]:
    words, langs = _Ids(), _Ids()
    ids: list[np.ndarray] = []
    lengths: list[int] = []
    of_doc: list[tuple[int, int]] = []          # language and hash of each document
    held = 0

    def made() -> Chunk:
        n, each = np.array(lengths, np.int64), np.array([len(x) for x in ids])
        lang, doc = np.array(of_doc, np.int64).T
        return Chunk(list(words), list(langs), np.concatenate(ids), np.repeat(np.cumsum(n), n),
                     np.repeat(lang.astype(np.int32), each), np.repeat(doc.astype(np.uint32), each))

    for b in small_batches(batches, "text"):
        for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
            found = pieces(t)
            if not found:
                continue
            own = langs[lang]
            flat = [w for p in found for w in p]
            ids.append(np.fromiter(map(words.__getitem__, flat), np.int32, len(flat)))
            lengths.extend(map(len, found))
            of_doc.append((own, xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass"))))
            held += len(flat)
            if held >= sizes.chunk or len(words) >= sizes.vocabulary:
                yield made()
                words, langs, ids, lengths, of_doc, held = _Ids(), _Ids(), [], [], [], 0
    if held:
        yield made()


class Bitmap:
    """Set of 64-bit hashes, of which others may seem to be members too."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.words = np.zeros(bits >> 6, np.uint64)

    @classmethod
    def of(cls, hashes: DataFrame, bits: int = BITS) -> Bitmap:
        """From a column ``h``; at most ``bits`` / 64 rows come to the driver."""
        out = cls(bits)
        place = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1))
        rows = hashes.select(place.alias("b")).selectExpr("shiftright(b, 6) as word", "shiftleft(1L, cast(pmod(b, 64) as int)) as bit")
        t = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        out.words[t.column("word").to_numpy()] = t.column("bits").to_numpy().view(np.uint64)
        return out

    def has(self, h: np.ndarray) -> np.ndarray:
        place = h >> self.shift
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class Summary:
    """Misra-Gries summary of weighted keys; ``lost``: what any count lacks at most."""

    def __init__(self, capacity: int):
        self.capacity, self.lost, self.mass = capacity, 0, 0
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.wait: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.wait.append((keys, counts))
        self.waiting += len(keys)
        self.mass += int(counts.sum())
        if self.waiting > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.wait)])
        counts = np.concatenate([self.counts, *(c for _, c in self.wait)])
        self.wait, self.waiting = [], 0
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first)
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            left = self.counts > off
            self.keys, self.counts = self.keys[left], self.counts[left] - off
            self.lost += off


def _within(chunk: Chunk, order: int, pairs: Bitmap | None) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of a chunk; of those of three words or more, the ones whose word pairs are all in ``pairs``."""
    at, h = chunk.phrases(order)
    if order < 3 or pairs is None:
        return at, h
    starts, pair = chunk.phrases(2)
    ok = np.zeros(len(chunk.ids), bool)
    ok[starts[pairs.has(pair)]] = True
    fine = ok[at]
    for j in range(1, order - 1):
        fine &= ok[at + j]
    return at[fine], h[fine]


PART, KEPT, LOST = 0, 1, 2


def summarised(texts: DataFrame, orders: tuple[int, ...], words: int, least: int, sizes: Sizes, pairs: Bitmap | None) -> tuple[DataFrame, str]:
    """(kind, h, v): PART rows are sums of chunks (document << 32 | occurrences), by hash partition; KEPT ones the phrases
    that may occur ``least`` times, which all that do are among. ``words``: a bound of the texts' words."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(pairs) if pairs else None

    def emit(batches):
        for chunk in chunks(batches, sizes):
            for m in orders:
                at, h = _within(chunk, m, shared.value if shared else None)
                h, first, n = np.unique(h, return_index=True, return_counts=True)
                v = chunk.doc[at[first]].astype(np.uint64) << np.uint64(32) | n.astype(np.uint64)
                yield pa.record_batch({"h": pa.array(h.view(np.int64)), "v": pa.array(v.view(np.int64))})

    def rows(kind: int, h: pa.Array, v: pa.Array) -> pa.RecordBatch:
        return pa.record_batch({"kind": pa.array(np.full(len(h), kind, np.int8)), "h": h, "v": v})

    slack = sizes.slack
    while True:
        needed = ceil(slack * len(orders) * words / least)
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(needed / sizes.counters))
        capacity = max(1, ceil(needed / partitions))

        def reduce(batches, capacity=capacity):
            s = Summary(capacity)
            for b in batches:
                h, v = b.column("h"), b.column("v")
                s.add(h.to_numpy(), v.to_numpy() & 0xFFFFFFFF)
                yield rows(PART, h, v)
            s.merge()
            kept = s.keys[s.counts + s.lost >= least]
            yield rows(KEPT, pa.array(kept), pa.array(np.zeros(len(kept), np.int64)))
            yield rows(LOST, pa.array([0], pa.int64()), pa.array([s.lost], pa.int64()))

        sent = texts.mapInArrow(emit, "h long, v long").repartition(partitions, "h")
        found, path = cut(spark, sent.mapInArrow(reduce, "kind byte, h long, v long"), "phrase-sums")
        if (found.filter(F.col("kind") == LOST).agg(F.max("v")).head()[0] or 0) < least:
            return found, path
        drop_path(spark, path)
        slack *= 2


def exact(sums: DataFrame, least: int, sizes: Sizes) -> DataFrame:
    """(h, f, d) of the phrases of at least ``least`` occurrences: their count and the document that spells them."""
    spark = sums.sparkSession
    shared = spark.sparkContext.broadcast(Bitmap.of(sums.filter(F.col("kind") == KEPT)))

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def added():
            h, f, d = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            h, f, d = h[order], f[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            return h[first], np.add.reduceat(f, first), np.minimum.reduceat(d, first)

        for b in batches:
            h, v = b.column("h").to_numpy(), b.column("v").to_numpy()
            known = shared.value.has(h.view(np.uint64))
            held.append((h[known], v[known] & 0xFFFFFFFF, v[known].view(np.uint64) >> np.uint64(32)))
            size += len(held[-1][0])
            if size >= 2 * sizes.counters:
                held = [added()]
                size = len(held[0][0])
                if size >= sizes.counters:
                    yield pa.record_batch({k: pa.array(x.astype(np.int64)) for k, x in zip("hfd", held[0], strict=True)})
                    held, size = [], 0
        if size:
            yield pa.record_batch({k: pa.array(x.astype(np.int64)) for k, x in zip("hfd", added(), strict=True)})

    some = sums.filter(F.col("kind") == PART).select("h", "v").mapInArrow(run, "h long, f long, d long")
    return some.groupBy("h").agg(F.sum("f").alias("f"), F.min("d").alias("d")).filter(F.col("f") >= least)


def spelled(texts: DataFrame, known: DataFrame, sizes: Sizes) -> DataFrame:
    """(h, lang, m, phrase, n) of the known phrases, spelled by their owners; rows of m = 0 have the words n of a language."""
    own = Bitmap.of(known.select(F.expr("h ^ shiftleft(d, 32)").alias("h")))
    shared = texts.sparkSession.sparkContext.broadcast((Bitmap.of(known), own))

    def run(batches):
        done: set[int] = set()
        for chunk in chunks(batches, sizes):
            there, mine = shared.value
            n = np.bincount(chunk.lang, minlength=len(chunk.langs))
            out = [(None, g, 0, "", int(x)) for g, x in zip(chunk.langs, n, strict=True)]
            for m in range(1, LONGEST + 1):
                at, h = _within(chunk, m, there)
                fits = there.has(h)
                at, h = at[fits], h[fits]
                fits = mine.has(h ^ (chunk.doc[at].astype(np.uint64) << np.uint64(32)))
                for i, x in zip(at[fits].tolist(), h[fits].view(np.int64).tolist(), strict=True):
                    if x not in done:
                        done.add(x)
                        out.append((x, chunk.langs[chunk.lang[i]], m, chunk.text(i, m).decode("utf-8", "surrogatepass"), 0))
            if len(done) > sizes.counters:
                done.clear()
            types = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["h", "lang", "m", "phrase", "n"])

    return texts.mapInArrow(run, "h long, lang string, m int, phrase string, n long")


def frequent(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 100, sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, m, phrase, f) of all phrases of ``least`` occurrences or more; m = 0: all words of the lang."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words = texts.agg(F.sum(F.octet_length("text") / 2 + 1).cast("long")).head()[0] or 0     # words are a byte and its end at least

    def level(orders: tuple[int, ...], pairs: Bitmap | None) -> DataFrame:
        sums, path = summarised(texts, orders, words, least, sizes, pairs)
        found, _ = cut(spark, exact(sums, least, sizes), "phrase-counts")
        drop_path(spark, path)
        return found

    short = level((1, 2), None)
    known = short.union(level((3, 4, 5), Bitmap.of(short)))          # lengths have hashes of their own
    words_of, _ = cut(spark, spelled(texts, known, sizes), "phrase-texts")
    texts_of = words_of.filter("m > 0").groupBy("h").agg(F.min(F.struct("lang", "m", "phrase")).alias("t"))
    phrases = known.join(texts_of.hint("merge"), "h").select("t.*", "f")
    out, _ = cut(spark, phrases.union(words_of.filter("m = 0").groupBy("lang", "m", "phrase").agg(F.sum("n").alias("f"))), "phrases")
    return out


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000, sizes: Sizes = Sizes()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's best phrases of two words or more. The score of a phrase
    is that of its worst cut, floor(1000 * a * n / (l * r))."""
    counted = frequent(docs, text=text, lang=lang, least=least, sizes=sizes)
    known = counted.filter("m > 0").select("lang", "phrase", "f")
    found = counted.filter("m > 1").withColumnRenamed("f", "a")
    words = F.split("phrase", " ", -1)

    # Inside a longer phrase of the same count: then also inside one of one word more.
    ends = F.explode(F.array(F.slice(words, F.lit(1), F.col("m") - 1), F.slice(words, F.lit(2), F.col("m") - 1)))
    covered = found.filter("m > 2").select("lang", ends.alias("part"), "a").select("lang", F.concat_ws(" ", "part").alias("phrase"), "a").distinct()
    left = found.join(covered, ["lang", "phrase", "a"], "left_anti")

    cuts = left.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"), words.alias("w"), "m")
    cuts = cuts.select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("head"),
                       F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("m") - F.col("k"))).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # A language may hold most rows: its one count is spread over salts.
    total = counted.filter("m = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).join(total, ["lang", "salt"])
    big = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    over = (big["a"] * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * big["n"]
    score = F.expr("over div under")
    cuts = cuts.withColumn("over", over).withColumn("under", big["l"] * big["r"]).withColumn("score", score)
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = worst.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
