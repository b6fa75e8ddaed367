"""Operator 2: sharding by histogram sort (DataFrame only).

Documents are ordered by (text hash, doc_id), so that equal texts are neighbours,
and cut into shards of nearly equal bytes. Splitters are found without sorting:
each round counts, over all partitions, the exact bytes between evenly spaced
probe keys inside every interval that still holds an unsettled splitter, and
narrows the intervals to one probe step. When an interval has shrunk to a single
hash (a hot group of copies), its probes go on over doc_id. A splitter is settled
once the bytes below it meet the tolerance. Rows are then exchanged once, to
(shard, run), a run being a sorted piece of a shard.

Defined results: null texts have no bytes (size 1, crc32 0); repeated rows are
separate documents; null doc_ids sort first; an empty table gives an empty
result. Extra columns are carried, result columns replace input columns of the
same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voltcube.llm.common import fresh

#: Probes in each interval and round, and the largest rounds needed to single out a 63-bit key at both levels.
PROBES, ROUNDS = 1024, 16
TOP = (1 << 63) - 1
#: Rows of a run that are sorted together; a shard has RUNS runs at least.
RUN_ROWS, RUNS = 50_000, 64


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_hash(text: Column) -> Column:
    """63 bits of the text's hash, never negative."""
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def id_key(doc_id: Column) -> Column:
    """Order-preserving, never negative (it joins two neighbouring ids)."""
    return F.shiftrightunsigned(F.coalesce(doc_id, F.lit(-(1 << 63))).bitwiseXOR(F.lit(-(1 << 63))), 1)


@dataclass
class Interval:
    """Keys [lo, hi] of one level; at level 1 the hash is ``fixed`` and keys are ids. ``below``: bytes before lo."""

    level: int
    fixed: int
    lo: int
    hi: int
    below: int
    targets: list[int]

    @property
    def step(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // PROBES))

    def holds(self, h: Column, d: Column) -> Column:
        return h.between(self.lo, self.hi) if self.level == 0 else (h == self.fixed) & d.between(self.lo, self.hi)

    def cell(self, h: Column, d: Column) -> Column:
        return F.call_function("div", (h if self.level == 0 else d) - F.lit(self.lo), F.lit(self.step))


def splitters(rows: DataFrame, h: str, d: str, size: str, shards: int, tolerance: float) -> list[tuple[int, int]]:
    """At most ``shards - 1`` keys (hash, id key); a row's shard is the number of keys not above its own.

    What comes to the driver in a round is one sum per probe cell that holds rows:
    at most (shards - 1) * PROBES numbers, whatever the input."""
    total = rows.agg(F.sum(size)).head()[0] or 0
    most = max(1, int(tolerance * total / shards))
    found: dict[int, tuple[int, int]] = {}
    todo = [Interval(0, 0, 0, TOP, 0, [total * i // shards for i in range(1, shards)])] if total else []
    for _ in range(ROUNDS):
        if not todo:
            break
        which = cell = None
        for i, iv in enumerate(todo):
            hit = iv.holds(F.col(h), F.col(d))
            which = F.when(hit, F.lit(i)) if which is None else which.when(hit, F.lit(i))
            c = iv.cell(F.col(h), F.col(d))
            cell = F.when(hit, c) if cell is None else cell.when(hit, c)
        counted = (rows.select(which.alias("i"), cell.alias("cell"), F.col(size).alias("s"))
                       .filter("i is not null").groupBy("i", "cell").agg(F.sum("s").alias("s")).collect())
        cells: dict[int, list] = {}
        for r in counted:
            cells.setdefault(r.i, []).append((r.cell, r.s))
        left = []
        for i, iv in enumerate(todo):
            at = iv.below
            for c, s in sorted(cells.get(i, [])):
                lo = iv.lo + c * iv.step
                hi = min(iv.hi, lo + iv.step - 1)
                inner = [t for t in iv.targets if at <= t < at + s]
                near = [t for t in inner if min(t - at, at + s - t) <= most]
                for t in near:   # the nearer end of the cell is close enough
                    key = lo if t - at <= at + s - t else hi + 1
                    found[t] = (key, 0) if iv.level == 0 else (iv.fixed, key)
                if deep := [t for t in inner if t not in near]:
                    if lo < hi:
                        left.append(Interval(iv.level, iv.fixed, lo, hi, at, deep))
                    elif iv.level == 0:
                        left.append(Interval(1, lo, 0, TOP, at, deep))
                    else:        # a single large document
                        for t in deep:
                            found[t] = (iv.fixed, lo if t - at <= at + s - t else lo + 1)
                at += s
        todo = left
    return [found[t] for t in sorted(found)]


def histogram_shard(docs: DataFrame, shards: int = 16, *, doc_id: str = "doc_id", hash_col: str, size: str,
                    tolerance: float = 0.001) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (gapless from 0 in each shard).

    Slots come from prefix-summed run counts plus the row number in the run, so no
    task handles more than a run, whatever a shard or a group of copies holds; rows
    that repeat both the doc_id (or have none) and the text are in one run."""
    docs = docs.drop("shard", "slot")
    d, run, off = fresh(docs, "_d", "_run", "_off")
    rows = docs.withColumn(d, id_key(F.col(doc_id)))
    keys = splitters(rows, hash_col, d, size, shards, tolerance)
    shard = F.lit(0)
    for kh, kd in keys:
        shard = shard + F.when((F.col(hash_col) > kh) | ((F.col(hash_col) == kh) & (F.col(d) >= kd)), 1).otherwise(0)
    runs = max(RUNS, rows.count() // (shards * RUN_ROWS))
    rows = rows.withColumn("shard", shard.cast("int"))
    rows = rows.withColumn(run, F.pmod(F.xxhash64(F.col(doc_id), F.col(hash_col), F.lit(7)), F.lit(runs)))
    counts = rows.groupBy("shard", run).agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy(run).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("shard", run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(off))
    rows = rows.join(counts, ["shard", run])
    number = F.row_number().over(W.partitionBy("shard", run).orderBy(hash_col, doc_id))
    return rows.select(*docs.columns, "shard", (number - 1 + F.col(off)).cast("long").alias("slot"))
