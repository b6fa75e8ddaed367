"""Operator 4: line dedup by a sharded minimal perfect hash.

1. Each task hashes the distinct line keys of its documents (128 bits: ``h1``, ``h2``);
   Spark counts the documents of each key and takes its largest doc_id.
2. Keys in at least ``min_docs`` documents are dealt into shards by hash. Each shard
   becomes one row: a minimal perfect hash over ``h1`` (levels of bit sets, each key
   at the first level where its position is its own) and three arrays in its order:
   the 64-bit fingerprint ``h2``, the document count and the keeping doc_id.
3. Documents probe the arrays: (doc_id, h1, h2) rows go to their key's shard. The most
   frequent keys (each over 1/HOT of all probes, so fewer than HOT) form a broadcast
   index of the same kind that is probed where the document is read. A shard whose
   keys get more than SHARD_PROBES probes nevertheless is copied to several salts, over which
   the documents are spread, so that no task gets more, whatever the size of the input.
   Lines themselves are never shuffled.
4. The hits return to their documents, which drop the lines.

A line key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.
A wrong hit needs two lines that agree in 128 hash bits (slot and fingerprint), or two
lines of one document that agree in the first 64.

Defined results: each row is a document; a null or empty text is one empty line
and keeps its value; rows without a doc_id are not counted and lose nothing; rows
repeating the largest doc_id all keep their lines; a document whose lines all go
has an empty text; an empty table gives an empty result. Extra columns are
carried, result columns replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.llm.common import add_columns, cut, drop_path, fresh, small_batches, with_fields

WHITE = b" \t\n\x0b\x0c\r"
#: Keys over 1/HOT of all probes are looked up in the broadcast index.
HOT = 4096
#: Shards hold about so many keys, and get about so many probes.
SHARD_KEYS, SHARD_PROBES, SHARDS = 1 << 16, 1 << 17, 512
#: Shards of several salts that are told to all tasks one by one; beyond, all shards get as many salts as the largest needs.
SALTED = 1 << 20


def line_key(line: bytes, least: int) -> bytes | None:
    """The key, or None where it has fewer than ``least`` code points."""
    k = line.strip(WHITE).lower()
    if len(k) < least or len(k) < 4 * least and len(k.decode("utf-8", "replace")) < least:
        return None
    return k


def key_hash(key: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(key)
    return x >> 64, x & 0xFFFFFFFFFFFFFFFF


def doc_keys(text: str, least: int) -> set[tuple[int, int]]:
    found = {line_key(x, least) for x in text.encode("utf-8", "surrogatepass").split(b"\n")}
    return {key_hash(k) for k in found if k is not None}


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    x = h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: levels of bit sets with rank counts.

    A key's slot is the number of set bits before its own. Keys that no level
    separates (equal ``h1`` of different lines) stay out, in ``rest``."""

    LEVELS = 48

    def __init__(self, levels: list[tuple[int, np.ndarray]], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        words = np.concatenate([w for _, w in levels]) if levels else np.zeros(0, np.uint64)
        self.words = words
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.start = np.cumsum([0] + [len(w) for _, w in levels])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        for level in range(cls.LEVELS):
            if not len(keys):
                break
            size = -(-max(64, 2 * len(keys)) // 64) * 64
            pos = (_mixed(keys, level) % np.uint64(size)).astype(np.int64)
            own = np.bincount(pos, minlength=size)[pos] == 1
            bits = np.zeros(size, np.uint8)
            bits[pos[own]] = 1
            levels.append((size, np.packbits(bits, bitorder="little").view(np.uint64)))
            keys = keys[~own]
        return cls(levels, np.sort(keys))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where it surely isn't in the set."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (size, _) in enumerate(self.levels):
            if not len(left):
                break
            pos = (_mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            word = self.start[level] + (pos >> 6)
            bit = (pos & 63).astype(np.uint64)
            w = self.words[word]
            hit = (w >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(w & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.rank[word] + below)[hit]
            left = left[~hit]
        return out


class LineIndex:
    """A shard: the perfect hash and its fingerprint, count and keeper arrays."""

    def __init__(self, mph: PerfectHash, fingerprint, count, keeper, rest):
        self.mph, self.fingerprint, self.count, self.keeper, self.rest = mph, fingerprint, count, keeper, rest

    @classmethod
    def build(cls, h1, h2, n, keeper) -> LineIndex:
        mph = PerfectHash.build(h1)
        slot = mph.slots(h1)
        inside = ~np.isin(h1, mph.rest)
        arrays = []
        for values in (h2, n, keeper):
            a = np.zeros(int(mph.rank[-1]), values.dtype)
            a[slot[inside]] = values[inside]
            arrays.append(a)
        rest = {(int(a), int(b)): (int(c), int(d)) for a, b, c, d in zip(h1[~inside], h2[~inside], n[~inside], keeper[~inside], strict=True)}
        return cls(mph, *arrays, rest)

    def probe(self, h1, h2) -> tuple[np.ndarray, np.ndarray]:
        """(document count, keeper); count 0 for keys that are not in the index."""
        slot = self.mph.slots(h1)
        n, keeper = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        hit = slot >= 0
        hit[hit] = self.fingerprint[slot[hit]] == h2[hit]
        n[hit], keeper[hit] = self.count[slot[hit]], self.keeper[slot[hit]]
        if self.rest:
            for i in np.flatnonzero(~hit & np.isin(h1, self.mph.rest)):
                n[i], keeper[i] = self.rest.get((int(h1[i]), int(h2[i])), (0, 0))
        return n, keeper

    FIELDS = "shard int, sizes array<long>, words binary, fingerprint binary, n binary, keeper binary, rest array<long>"

    def row(self, shard: int) -> dict:
        return {"shard": shard, "sizes": [s for s, _ in self.mph.levels], "words": self.mph.words.tobytes(),
                "fingerprint": self.fingerprint.tobytes(), "n": self.count.tobytes(), "keeper": self.keeper.tobytes(),
                "rest": [int(np.uint64(x).view(np.int64)) for k, v in self.rest.items() for x in (*k, *map(np.int64, v))]}

    @classmethod
    def read(cls, r: dict) -> LineIndex:
        words, levels, at = np.frombuffer(r["words"], np.uint64), [], 0
        for s in r["sizes"]:
            levels.append((s, words[at:at + s // 64]))
            at += s // 64
        flat = np.array(r["rest"], np.int64)
        rest = {tuple(map(int, x[:2].view(np.uint64))): (int(x[2]), int(x[3])) for x in flat.reshape(-1, 4)}
        mph = PerfectHash(levels, np.sort(np.array([k[0] for k in rest], np.uint64)))
        return cls(mph, np.frombuffer(r["fingerprint"], np.uint64), np.frombuffer(r["n"], np.int64), np.frombuffer(r["keeper"], np.int64), rest)


def _u64(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).view(np.uint64)


def _signed(xs: list[int]) -> np.ndarray:
    return np.array(xs, np.uint64).view(np.int64)


def count_keys(docs: DataFrame, least: int) -> DataFrame:
    """(h1, h2, n documents, largest doc_id) of every line key; ``docs`` has doc_id and text."""

    def emit(batches):
        for b in small_batches(batches, "text"):
            ids, h1, h2 = [], [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                for x, y in doc_keys(t or "", least):
                    ids.append(i)
                    h1.append(x)
                    h2.append(y)
            yield pa.record_batch({"h1": pa.array(_signed(h1)), "h2": pa.array(_signed(h2)), "doc_id": pa.array(ids, pa.int64())})

    return (docs.filter("doc_id is not null").mapInArrow(emit, "h1 long, h2 long, doc_id long")
                .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")))


def _to_index(t: pa.Table) -> LineIndex:
    t = t.combine_chunks()
    return LineIndex.build(*(t.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")), *(t.column(c).to_numpy() for c in ("n", "keeper")))


def build_shards(keys: DataFrame, shards: int) -> DataFrame:
    def build(t: pa.Table) -> pa.Table:
        row = _to_index(t).row(t.column("shard")[0].as_py())
        return pa.Table.from_pylist([row], schema=pa.schema([
            ("shard", pa.int32()), ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("fingerprint", pa.binary()),
            ("n", pa.binary()), ("keeper", pa.binary()), ("rest", pa.list_(pa.int64()))]))

    return keys.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(build, LineIndex.FIELDS)


def _send(docs: DataFrame, least: int, shared, shards: int, turn: int) -> DataFrame:
    """(route, doc_id, h1, h2, lost) of each document's line keys but those that the broadcast index knows and leaves."""

    def emit(batches):
        top, at, salts, least_salts = shared.value
        for b in small_batches(batches, "text"):
            ids, h1, h2 = [], [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                for x, y in doc_keys(t or "", least):
                    ids.append(i)
                    h1.append(x)
                    h2.append(y)
            ids, h1, h2 = np.array(ids, np.int64), np.array(h1, np.uint64), np.array(h2, np.uint64)
            n, keeper = top.probe(h1, h2)
            known = n > 0
            lost = known & (ids != keeper)
            shard = h1.view(np.int64) % shards
            among = np.full(len(ids), least_salts, np.int64)
            if len(at):
                place = np.minimum(np.searchsorted(at, shard), len(at) - 1)
                among = np.where(at[place] == shard, salts[place], 1)
            salt = (_mixed(ids.view(np.uint64), 0) % among.astype(np.uint64)).astype(np.int64)
            route = np.where(known, shards + np.abs(ids) % shards, salt * turn + shard)
            go = lost | ~known
            yield pa.record_batch({"route": pa.array(route[go], pa.int64()), "doc_id": pa.array(ids[go]), "h1": pa.array(h1.view(np.int64)[go]),
                                   "h2": pa.array(h2.view(np.int64)[go]), "lost": pa.array(lost[go])})

    return docs.filter("doc_id is not null").mapInArrow(emit, "route long, doc_id long, h1 long, h2 long, lost boolean")


def find_hits(spark: SparkSession, docs: DataFrame, least: int, min_docs: int) -> tuple[DataFrame, list[str]]:
    """(doc_id, hits): the ``h1`` of keys that the document loses; and paths to delete once it has been read."""
    seen = Observation()
    counted = count_keys(docs, least).observe(seen, F.sum("n").alias("probes"))
    keys, path = cut(spark, counted.filter(F.col("n") >= min_docs), "line-keys")
    probes = seen.get["probes"] or 0
    hot_from = max(probes // HOT, min_docs)
    hot = keys.filter(F.col("n") > hot_from).toArrow()      # fewer than HOT rows: their counts sum to at most ``probes``
    cold = keys.filter(F.col("n") <= hot_from)
    shards = max(SHARDS, keys.count() // SHARD_KEYS, probes // SHARD_PROBES)
    index, index_path = cut(spark, build_shards(cold, shards), "line-index")
    # Keys below ``min_docs`` are dealt evenly; what makes a shard large are its indexed keys, whose probes are known.
    load = cold.groupBy(F.pmod("h1", F.lit(shards)).cast("int").alias("shard")).agg(F.sum("n").alias("n"))
    salted = load.select("shard", (F.lit(1) + F.floor(F.col("n") / SHARD_PROBES)).cast("int").alias("salts")).filter("salts > 1")
    several = salted.orderBy("shard").limit(SALTED + 1).toArrow()
    if several.num_rows <= SALTED:
        at, salts, least_salts = several.column("shard").to_numpy(), several.column("salts").to_numpy(), 1
        copies = index.join(F.broadcast(salted), "shard", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    else:
        at, salts, least_salts = np.zeros(0, np.int32), np.zeros(0, np.int32), int(salted.agg(F.max("salts")).head()[0])
        copies = index.withColumn("salts", F.lit(least_salts))
    # Routes: the shards, as many places for hits on hot keys, then the same again for each further salt.
    turn = 2 * shards
    copies = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    copies = copies.withColumn("route", F.col("salt").cast("long") * turn + F.col("shard")).drop("salt", "salts", "shard")
    sent = _send(docs, least, spark.sparkContext.broadcast((_to_index(hot), at, salts, least_salts)), shards, turn)

    def probe(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        lost = left.column("lost").to_numpy(zero_copy_only=False).copy()
        if right.num_rows:
            n, keeper = LineIndex.read(right.to_pylist()[0]).probe(*(left.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")))
            lost |= (n > 0) & (keeper != left.column("doc_id").to_numpy())
        return left.select(["doc_id", "h1"]).filter(pa.array(lost))

    hits = (sent.groupBy("route").cogroup(copies.groupBy("route"))
                .applyInArrow(probe, "doc_id long, h1 long"))
    return hits.groupBy("doc_id").agg(F.collect_set("h1").alias("hits")), [path, index_path]


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the text of kept lines, ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hits, paths = find_hits(spark, plain, least, min_docs)
    hits, _ = cut(spark, hits, "line-hits")
    for p in paths:
        drop_path(spark, p)
    hid, got = fresh(docs, "_hid", "_hits")
    # The hits grow with the input, so the plan is the same at every size: no broadcast.
    joined = docs.join(hits.select(F.col("doc_id").alias(hid), F.col("hits").alias(got)).hint("merge"), F.col(doc_id).cast("long") == F.col(hid), "left").drop(hid)
    out = with_fields(docs, n_lines=T.LongType(), n_dropped=T.LongType())
    kept_columns = docs.columns

    def apply(batches):
        for b in small_batches(batches, text):
            texts, n_lines, n_dropped = [], [], []
            for t, lose in zip(b.column(b.schema.get_field_index(text)).to_pylist(), b.column(b.schema.get_field_index(got)).to_pylist(), strict=True):
                n, gone = (t or "").count("\n") + 1, 0
                if lose:
                    lose, kept = set(lose), []
                    for line in t.encode("utf-8", "surrogatepass").split(b"\n"):
                        k = line_key(line, least)
                        if k is not None and int(np.uint64(key_hash(k)[0]).view(np.int64)) in lose:
                            gone += 1
                        else:
                            kept.append(line)
                    t = b"\n".join(kept).decode("utf-8", "surrogatepass")
                texts.append(t)
                n_lines.append(n)
                n_dropped.append(gone)
            b = b.select(kept_columns)
            b = b.set_column(b.schema.get_field_index(text), text, pa.array(texts, b.column(b.schema.get_field_index(text)).type))
            yield add_columns(b, n_lines=pa.array(n_lines, pa.int64()), n_dropped=pa.array(n_dropped, pa.int64()))

    return joined.mapInArrow(apply, out)
