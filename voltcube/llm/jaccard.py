"""Operator 10: n-gram Jaccard join with hashed bitmap signatures and exact intersections.

A document is the set of its distinct 5-word shingles (64-bit hashes); documents of equal
sets are one node. Links are all pairs with 100 * intersection >= 80 * union.

1. Order. Tokens are ordered rare first: shingles that some task met in several documents
   come last, by their count; all others by hash. Any order gives the same links, this one
   keeps passages that many documents share out of the prefixes.
2. Prefixes. Linked sets overlap in at least 4/5 of each, so their first n - ceil(4n/5) + 1
   tokens share one. Rows (token, node) go on if the token has a row of a size within the
   band 4/5 to 5/4; sorted by size, that is a look at the neighbours.
3. Signatures. The nodes of a token are a tile, taken in the order of their sizes; pairs that
   sizes and signatures allow to link connect them, whatever connects them already being left
   out. Tokens of more nodes than a tile takes are salted; then the nodes outside the token's
   largest component meet its nodes of like sizes: these are cut into size bands, the bands into
   blocks, and two blocks of the same or neighbouring bands make a tile.
4. Exact intersections. The components of what may link are clusters. Only their nodes' sets
   are fetched, and each cluster is a tile, in which pairs are tested by size, signature and
   exact intersection of sorted arrays. A cluster larger than a tile, by nodes or by shingles, is
   cut into blocks that share a few nodes; then the nodes outside its largest component meet the
   others likewise.

A signature is the parity bitmap of the hashed shingles, as wide as the set is large; the
bits in which two differ are at most the shingles in which the sets differ, so
(|A| + |B| - differing bits) / 2 bounds the overlap from above. Wider ones fold by XOR.

Defined results: null texts and texts without words have no shingles, link with nothing and
are their own component; a row without doc_id links with nothing (null component) unless its
text equals others' (it never names a component); rows repeating a doc_id are separate rows;
an empty table gives an empty result. Extra columns are ignored. Equal 64-bit hashes of
different shingles or sets are taken as equal.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltcube.llm.common import cut, drop_path, fresh, give_back, small_batches
from voltcube.llm.components import components

SHINGLE = 5
#: A shingle is common once a task has met it in so many documents; the FREQUENT most common are told to all.
COMMON, CHUNK, FREQUENT = 3, 1 << 22, 1 << 18
#: Nodes of a tile, and nodes of a salted token or a cut cluster that are in all of its tiles.
TILE, SPINE = 2048, 32
#: Shingles of the sets in a tile of exact intersections, about (8 bytes each; a larger set is a tile's alone).
TILE_SHINGLES = 1 << 21
#: Ratio of the size bands.
BAND = 1.2501
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's 5-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"\n".join(words), len(words))], np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    m = len(h) - SHINGLE + 1
    s = h[:m] * _M[0]
    for j in range(1, SHINGLE):
        s += _mix(h[j:j + m] ^ _M[j]) * _M[j]
    return np.unique(_mix(s))


def set_id(s: np.ndarray) -> int:
    """The node of a set (signed 64 bits)."""
    x = xxhash.xxh3_64_intdigest(s.tobytes())
    return x - (1 << 64) if x >> 63 else x


def width(n: int) -> int:
    """Bits of a signature: the power of two from n on, 64 at least."""
    return max(64, 1 << max(0, n - 1).bit_length())


def signature(s: np.ndarray) -> np.ndarray:
    """Parity bitmap in 64-bit words."""
    w = width(len(s))
    odd = (np.bincount((s & np.uint64(w - 1)).astype(np.int64), minlength=w) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def fold(sig: np.ndarray, words: int) -> np.ndarray:
    return np.bitwise_xor.reduce(sig.reshape(-1, words), axis=0)


def needed(a, b):
    """The least overlap of linked sets of these sizes."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


class Pile:
    """Signatures of one tile, folded to each width that a partner may have."""

    def __init__(self, n: np.ndarray, sigs: list[np.ndarray]):
        self.n, self.sigs = n, sigs
        self.words = np.array([len(s) for s in sigs])
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def differing(self, i: int, others: np.ndarray) -> np.ndarray:
        """Differing bits of signature i and each of the others, at the smaller width of the two."""
        out = np.zeros(len(others), np.int64)
        mine, w = self.sigs[i], len(self.sigs[i])
        for v in np.unique(self.words[others]):
            at = self.words[others] == v
            use = min(w, int(v))
            if use not in self.held:
                rows = np.flatnonzero(self.words >= use)
                where = np.full(len(self.n), -1)
                where[rows] = np.arange(len(rows))
                self.held[use] = where, np.array([fold(self.sigs[r], use) for r in rows])
            where, table = self.held[use]
            out[at] = np.bitwise_count(table[where[others[at]]] ^ fold(mine, use)).sum(1)
        return out

    def possible(self, i: int, others: np.ndarray) -> np.ndarray:
        """The others whose size and signature allow a link with i."""
        a, b = self.n[i], self.n[others]
        others = others[(5 * np.minimum(a, b) >= 4 * np.maximum(a, b))]
        if not len(others):
            return others
        b = self.n[others]
        return others[(a + b - self.differing(i, others)) // 2 >= needed(a, b)]


def tile_links(nodes: np.ndarray, comp: np.ndarray, n: np.ndarray, sigs: list[np.ndarray], sets: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """Links that connect the nodes of a tile as all its links do; nodes of one component count as connected.
    Without the sets: pairs that sizes and signatures allow to link."""
    order = np.argsort(n, kind="stable")          # bands of like sizes lie together
    nodes, n, label = nodes[order], n[order], np.unique(comp[order], return_inverse=True)[1]
    pile, out = Pile(n, [sigs[i] for i in order]), []
    for i in range(len(nodes)):
        others = np.arange(i + 1, np.searchsorted(n, 5 * n[i] // 4, side="right"))
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        for j in pile.possible(i, others):
            if label[j] != label[i] and (sets is None or len(np.intersect1d(sets[order[i]], sets[order[j]], assume_unique=True)) >= needed(n[i], n[j])):
                out.append((int(nodes[i]), int(nodes[j])))
                label[label == label[j]] = label[i]
    return out


def runs(batches, key: str) -> Iterator[pa.Table]:
    """Tables of equal keys from batches sorted by key."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if held and k[s] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = k[s]
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def _survey(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, node, sig) of documents, and rows (token, times) of shingles met in several documents of a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sig", pa.binary()), ("token", pa.int64()), ("times", pa.int64())])

    def full(m: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(m, f.type)) for f in schema], schema=schema)

    def run(batches):
        chunk, size, seen = [], 0, set()

        def common():
            tokens = np.concatenate(chunk)
            chunk.clear()
            tokens.sort()
            often = np.unique(tokens[COMMON - 1:][tokens[COMMON - 1:] == tokens[:max(0, len(tokens) - COMMON + 1)]])
            times = np.searchsorted(tokens, often, "right") - np.searchsorted(tokens, often)
            return full(len(often), token=pa.array(often.view(np.int64)), times=pa.array(times.astype(np.int64)))

        for b in small_batches(batches, "text"):
            sets = [shingle_set(t) for t in b.column("text").to_pylist()]
            ids = [set_id(s) if len(s) else None for s in sets]
            sigs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield full(len(sets), doc_id=b.column("doc_id"), n=pa.array([len(s) for s in sets], pa.int64()), node=pa.array(ids, pa.int64()), sig=pa.array(sigs, pa.binary()))
            for i, s in zip(ids, sets, strict=True):
                if i is not None and i not in seen:
                    seen.add(i)
                    chunk.append(s)
                    size += len(s)
            if size > CHUNK:
                yield common()
                size, seen = 0, set()
        if chunk:
            yield common()

    return docs.mapInArrow(run, "doc_id long, n long, node long, sig binary, token long, times long")


def _prefixes(docs: DataFrame, frequent: pa.Table) -> DataFrame:
    """(token, node, meta) of each node's prefix; a task gives a node once (as long as it remembers it).
    ``meta`` is the set's size, the token's position and whether it is common, in one number that sorts by size."""
    tokens = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    # Rank 0 is left to tokens that are not common; equal counts fall back on the hash.
    rank = np.unique(frequent.column("times").to_numpy(), return_inverse=True)[1][order] + 1
    shared = docs.sparkSession.sparkContext.broadcast((tokens[order], rank))

    def run(batches):
        known, ranks = shared.value
        seen: set[int] = set()
        for b in small_batches(batches, "text"):
            out_t, out_n, out_m = [], [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t)
                if not len(s) or (node := set_id(s)) in seen:
                    continue
                if len(seen) > 1 << 20:
                    seen.clear()
                seen.add(node)
                p = prefix_length(len(s))
                r = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    r = np.where(known[at] == s, ranks[at], 0)
                first = np.argsort(r, kind="stable")[:p]
                out_t.append(s[first].view(np.int64))
                out_n.append(np.full(p, node, np.int64))
                out_m.append((len(s) << 32) + (np.arange(p) << 1) + (r[first] > 0))
            cat = lambda xs: pa.array(np.concatenate([*xs, np.zeros(0, np.int64)]).astype(np.int64))
            yield pa.record_batch({"token": cat(out_t), "node": cat(out_n), "meta": cat(out_m)})

    return docs.mapInArrow(run, "token long, node long, meta long")


def _not_alone(rows: DataFrame, partitions: int) -> DataFrame:
    """(token, node, n) of rows whose token has another row of a like size. Common tokens pass at once and are
    dealt by node too, so none crowds a task."""
    common = F.col("meta") % 2 == 1

    def run(batches):
        held, paired = None, False           # the last row so far, and whether it is known to have a partner
        for b in batches:
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            k, meta = b.column("token").to_numpy(), b.column("meta").to_numpy()
            if not len(k):
                continue
            n, pos = meta >> 32, (meta & 0xFFFFFFFF) >> 1
            same = k[1:] == k[:-1]
            ok = same & (5 * n[:-1] >= 4 * n[1:])
            # Where the token surely has these two rows only, it must be early enough in both to be their first shared one.
            two = same & np.concatenate([[False], ~same[:-1]]) & np.concatenate([~same[1:], [False]])
            need = needed(n[:-1], n[1:])
            ok &= ~two | (n[:-1] - pos[:-1] >= need) & (n[1:] - pos[1:] >= need)
            keep = np.concatenate([[paired], ok]) | np.concatenate([ok, [False]]) | (meta & 1 == 1)
            out = b.slice(0, len(k) - 1).filter(pa.array(keep[:-1]))
            yield pa.record_batch({"token": out.column("token"), "node": out.column("node"), "n": pa.array(n[:-1][keep[:-1]])})
            held, paired = b.slice(len(k) - 1), bool(keep[-1])
        if paired:
            yield pa.record_batch({"token": held.column("token"), "node": held.column("node"), "n": pa.array(held.column("meta").to_numpy() >> 32)})
        give_back()

    rows = rows.repartition(partitions, "token", F.when(common, F.col("node")))
    return rows.sortWithinPartitions("token", "meta").mapInArrow(run, "token long, node long, n long")


def _sets(docs: DataFrame, want: DataFrame) -> DataFrame:
    """(node, items) of the wanted nodes; ``want``: (node, rep), rep being a document of that node."""
    # What is wanted grows with the input, so the plan is the same at every size: no broadcast.
    rows = docs.join(want.hint("merge"), docs["doc_id"] == want["rep"]).select("node", "text")

    def run(batches):
        for b in small_batches(batches, "text"):
            nodes, items = [], []
            for node, t in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                s = shingle_set(t)
                if len(s) and set_id(s) == node:
                    nodes.append(node)
                    items.append(s.tobytes())
            yield pa.record_batch({"node": pa.array(nodes, pa.int64()), "items": pa.array(items, pa.binary())})

    return rows.mapInArrow(run, "node long, items binary")


def _links(tiles: DataFrame, more: DataFrame, partitions: int) -> DataFrame:
    """Links (a, b) that connect the nodes of each tile (tile, node, component). ``more`` has the nodes' sizes and
    signatures (n, sig), for links that are possible, or their sets (items), for links that are."""
    exact = "items" in more.columns

    def run(batches):
        for t in runs(batches, "tile"):
            if t.num_rows < 2:
                continue
            nodes, first = np.unique(t.column("node").to_numpy(), return_index=True)
            held = t.column("items" if exact else "sig").to_pylist()
            sets = [np.frombuffer(held[i], np.uint64) for i in first]
            n = np.array([len(x) for x in sets]) if exact else t.column("n").to_numpy()[first]
            links = tile_links(nodes, t.column("component").to_numpy()[first], n, [signature(x) for x in sets] if exact else sets, sets if exact else None)
            if links:
                yield pa.record_batch({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    rows = tiles.select("tile", "node", "component").join(more, "node")
    return rows.repartition(partitions, "tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long")


def _salted(rows: DataFrame, key: str, salts: str, spread) -> DataFrame:
    """Rows with their tile: one of the key's salts, or all of them where ``spread`` holds."""
    own = F.array(F.pmod(F.xxhash64("node", F.lit(11)), F.col(salts)))
    at = F.explode(F.when(spread, F.sequence(F.lit(0).cast("long"), F.col(salts) - 1)).otherwise(own))
    return rows.withColumn("at", at).withColumn("tile", F.xxhash64(key, "at"))


def _spine(size: str):
    """The few nodes that all tiles of a key of this size have."""
    return F.pmod(F.xxhash64("node", F.lit(13)), F.col(size)) < SPINE


def _outer(rows: DataFrame, key: str) -> DataFrame:
    """Rows of keys that still have several components; ``outer``: not in the key's largest one."""
    per = (rows.groupBy(key, "component").agg(F.count("*").alias("k")).groupBy(key)
               .agg(F.count("*").alias("r"), F.max_by("component", F.struct("k", "component")).alias("largest")))
    return rows.join(per.filter("r > 1").select(key, "largest"), key).withColumn("outer", F.col("component") != F.col("largest"))


def _band(n):
    """Sizes by bands a little wider than 5/4: linked sets lie in the same band or in neighbouring ones."""
    return F.floor(F.log(F.col(n)) / math.log(BAND)).cast("long")


def _meetings(rows: DataFrame, key: str, shingles: int | None = None) -> DataFrame:
    """Rows of ``_outer`` (with the size ``n``) with their tiles, in which each outer node meets all nodes of its key that are
    in its band or the ones beside it. Outer nodes and others of a band are cut into blocks of about TILE nodes, or
    ``shingles`` shingles; a tile is two blocks of near bands, of which one at least is of outer nodes."""
    def blocks(of):
        n = F.ceil(F.count_if(of) / TILE)
        return n if shingles is None else F.greatest(n, F.ceil(F.sum(F.when(of, F.col("n")).otherwise(0)) / shingles))

    rows = rows.withColumn("band", _band("n"))
    held = rows.groupBy(key, "band").agg(blocks(~F.col("outer")).alias("inner"), blocks(F.col("outer")).alias("parts"))
    # A block as one number: band, whether it is of outer nodes, and its place among those.
    block = lambda band, outer, at: (band * 2 + outer) * (1 << 32) + at
    place = F.pmod(F.xxhash64("node", F.lit(11)), F.greatest(F.when(F.col("outer"), F.col("parts")).otherwise(F.col("inner")), F.lit(1)))
    rows = rows.join(held, [key, "band"]).withColumn("block", block(F.col("band"), F.col("outer").cast("long"), place)).drop("inner", "parts")
    near = held.select(key, F.col("band").alias("other"), "inner", "parts", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    upto = lambda n, outer: F.transform(F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<long>")),
                                        lambda at: block(F.col("other"), F.lit(outer), at))
    met = F.concat(upto("parts", 1), F.when(F.col("outer"), upto("inner", 0)).otherwise(F.array().cast("array<long>")))
    rows = rows.join(near, [key, "band"]).withColumn("met", F.explode(met))
    return rows.withColumn("tile", F.xxhash64(key, F.least("block", "met"), F.greatest("block", "met")))


def _in(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of their node (a node without links is its own)."""
    return rows.drop("component").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))


def link_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    paths: dict[str, str] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        df, paths[name] = cut(spark, df, name)
        return df

    def drop(*names: str) -> None:
        for n in names:
            drop_path(spark, paths.pop(n))

    survey = keep(_survey(docs), "survey")
    signed = survey.filter("n is not null")
    frequent = (survey.filter("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
                      .orderBy(F.desc("times"), "token").limit(FREQUENT).toArrow())
    # A partition of prefix rows is bounded by the input's rows, not by the session's setting alone.
    total = signed.agg(F.sum("n")).head()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 5_000_000)
    # Of each token the distinct nodes, and of tokens of several nodes their number.
    rows = keep(_not_alone(_prefixes(docs, frequent), partitions).distinct(), "rows")
    shared = keep(rows.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1"), "shared")
    rows = keep(rows.join(shared, "token").withColumn("salts", F.ceil(F.col("c") / TILE)), "pairs")
    drop("rows", "shared")

    # What may link, by signatures.
    sigs = signed.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig"))
    single = rows.withColumn("component", F.col("node"))
    spread = (F.col("salts") > 1) & _spine("c")
    may = keep(_links(_salted(single, "token", "salts", spread), sigs, partitions), "may")
    comp = keep(components(may), "clusters")
    crowded = keep(_outer(_in(single.filter("salts > 1"), comp), "token"), "crowded")
    if crowded.head() is not None:
        more = keep(_links(_meetings(crowded, "token"), sigs, partitions), "may-more")
        comp = keep(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "clusters-more")
    drop("pairs", "may", "crowded")

    # What links, by exact intersections within the clusters.
    comp = comp.join(sigs.select("node", "n"), "node")
    size = comp.groupBy("component").agg(F.count("*").alias("c"), F.sum("n").alias("shingles"))
    salts = F.greatest(F.ceil(F.col("c") / TILE), F.ceil(F.col("shingles") / TILE_SHINGLES))
    clusters = comp.join(size, "component").withColumnRenamed("component", "cluster").withColumn("salts", salts).withColumn("component", F.col("node"))
    clusters = keep(clusters, "clustered")
    reps = signed.filter("doc_id is not null and node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    sets = keep(_sets(docs, clusters.select("node").join(reps, "node")), "sets")
    spread = (F.col("salts") > 1) & _spine("c")
    links = keep(_links(_salted(clusters, "cluster", "salts", spread), sets, partitions), "links")
    comp = keep(components(links), "components")
    left = keep(_outer(_in(clusters.filter("salts > 1"), comp), "cluster"), "left")
    if left.head() is not None:
        more = keep(_links(_meetings(left, "cluster", TILE_SHINGLES), sets, partitions), "links-more")
        comp = keep(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "components-more")
    drop("sets", "links", "left", "clustered")

    grouped = keep(signed.select("doc_id", "n", "node").join(comp, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("g")), "grouped")
    least, _ = cut(spark, grouped.filter("g is not null").groupBy("g").agg(F.min("doc_id").alias("least")), "least")
    out, _ = cut(spark, grouped.join(least, "g", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                               F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")), "jaccard")
    drop(*paths)
    return out


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (rows without one after all others; of
    equal ids any one, the same in every run over the written rows). Rows count, not ids: rows that share an
    id but no link all stay, and so does every row without words."""
    spark = docs.sparkSession
    nr, at = fresh(docs, "_nr", "_at")
    # Rows are numbered once and written, so that each keeps its number whatever runs again.
    rows, _ = cut(spark, docs.withColumn(nr, F.monotonically_increasing_id()), "numbered")
    found = link_components(rows, doc_id=nr, text=text).select(F.col("doc_id").alias(at), F.col("component_id").alias("_group"))
    known = found.join(rows.select(F.col(nr).alias(at), F.col(doc_id).alias("_id")).hint("merge"), at)
    first = F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", at)).alias("first")
    kept, _ = cut(spark, known.groupBy("_group").agg(first).select(F.col("first")[at].alias(at)), "kept")
    # What stays grows with the input, so the plan is the same at every size: no broadcast.
    return rows.join(kept.hint("merge"), F.col(nr) == F.col(at), "left_semi").select(*docs.columns)
