"""Operator 6: language identification.

Multinomial naive Bayes over hashed character n-grams (orders 1 to 3 over letters,
lower-cased, other characters being word ends). Counts come from all training
rows: each task sums its own per language and bucket, Spark adds them up. The
log-probability matrix (languages x buckets, a size that the input's length does
not change) is broadcast and texts are scored in numpy, whole.

Defined results: null texts, and texts without a letter, are ``und`` with score 0;
with no training rows every text is ``und``; rows whose language is null are not
learned from; more than ``MAX_LANGS`` languages are an error (``TooManyLanguages``). Repeated rows count as often as
they occur; of equally likely languages the first by code point is predicted; an empty table gives an empty result.
Extra columns are carried; result columns replace input columns of
the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube.llm import chars
from voltcube.llm.common import add_columns, small_batches, with_fields

ORDERS = (1, 2, 3)
BITS = 16
#: Languages that a model may have (1.6 MB each, on the driver and in every worker), and those that a task counts at once.
MAX_LANGS, HELD_LANGS = 256, 32
UNDETERMINED = "und"


class TooManyLanguages(ValueError):
    pass


@dataclass
class LanguageModel:
    langs: list[str]
    log_prob: np.ndarray     # (buckets of all orders, languages)
    prior: np.ndarray
    orders: tuple = ORDERS
    bits: int = BITS

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and its posterior probability, per text."""
        out, conf = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if not self.langs:
            return out, conf
        live = [i for i, t in enumerate(texts) if t and chars.LETTER.search(t)]
        for ids, points in chars.groups([chars.letter_points(texts[i]) for i in live]):
            like = np.tile(self.prior, (len(ids), 1))
            for k, n in enumerate(self.orders):
                for j, p in enumerate(points):
                    for at in range(0, len(p), chars.PIECE):
                        b = chars.ngram_buckets(p[at:at + chars.PIECE + n - 1], n, self.bits)
                        if len(b):
                            seen, times = np.unique(b, return_counts=True) if len(b) > 1 << 17 else (b, None)
                            rows = self.log_prob[(k << self.bits) + seen.astype(np.int64)]
                            like[j] += rows.sum(0) if times is None else times @ rows
            best = like.argmax(1)
            top = 1 / np.exp(like - like.max(1, keepdims=True)).sum(1)
            for j, i in enumerate(ids):
                out[live[i]], conf[live[i]] = self.langs[best[j]], top[j]
        return out, conf


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", orders=ORDERS, bits: int = BITS,
          smoothing: float = 0.5) -> LanguageModel:
    """Counts over every row with a text and a language. What reaches the driver is one
    number per language and bucket that occurs (at most languages * 3 * 2**bits)."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    # The bound is checked before anything of that size is counted or sent.
    if len(rows.select("lang").distinct().limit(MAX_LANGS + 1).collect()) > MAX_LANGS:
        raise TooManyLanguages(f"more than {MAX_LANGS} languages in the training rows")

    def count(batches):
        held: dict[str, np.ndarray] = {}
        n: dict[str, int] = {}

        def counted():
            for g, acc in held.items():
                at = np.flatnonzero(acc)
                yield pa.record_batch({"lang": pa.array([g] * (len(at) + 1), pa.string()),
                                       "bucket": pa.array(np.append(at, -1), pa.int32()),
                                       "n": pa.array(np.append(acc[at], n[g]), pa.int64())})
            held.clear()
            n.clear()

        for b in small_batches(batches, "text"):
            for t, g in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if g not in held:
                    if len(held) == HELD_LANGS:
                        yield from counted()
                    held[g] = np.zeros(len(orders) << bits, np.int64)
                acc = held[g]
                n[g] = n.get(g, 0) + 1
                p = chars.letter_points(t)
                for k, o in enumerate(orders):
                    for at in range(0, len(p), chars.PIECE):
                        got = chars.ngram_buckets(p[at:at + chars.PIECE + o - 1], o, bits)
                        if len(got) > 1 << 13:
                            acc[k << bits:(k + 1) << bits] += np.bincount(got, minlength=1 << bits)
                        elif len(got):
                            np.add.at(acc, (k << bits) + got.astype(np.int64), 1)
        yield from counted()

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.zeros((len(orders) << bits, len(langs)))
    docs_in = np.zeros(len(langs))
    for j, g in enumerate(langs):
        c = counts[counts["lang"] == g]
        docs_in[j] = c.loc[c["bucket"] == -1, "n"].sum()
        c = c[c["bucket"] >= 0]
        table[c["bucket"].to_numpy(), j] = c["n"].to_numpy()
    for k in range(len(orders)):
        part = table[k << bits:(k + 1) << bits]
        used = max(1, int((part.sum(1) > 0).sum()))       # unseen buckets share one smoothing mass per used bucket
        part[:] = np.log(part + smoothing) - np.log(part.sum(0) + smoothing * used)
    return LanguageModel(langs, table, np.log(docs_in / docs_in.sum()) if langs else docs_in, tuple(orders), bits)


def predict(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in small_batches(batches, text):
            langs, conf = shared.value.score(b.column(b.schema.get_field_index(text)).to_pylist())
            yield add_columns(b, lang_pred=pa.array(langs, pa.string()), score=pa.array(conf, pa.float64()))

    return docs.mapInArrow(run, with_fields(docs, lang_pred=T.StringType(), score=T.DoubleType()))
