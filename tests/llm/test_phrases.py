"""Operator 12 against counts of every phrase."""
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import LOWER
from voltcube.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def brute(docs, least, top):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = {(g, p[i:j]) for (g, p), a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
              if j - i < len(p) and cand.get((g, p[i:j])) == a}
    out = []
    for (g, p), a in cand.items():
        if (g, p) not in inside:
            cuts = [(1000 * a * n[g] // (f[g, p[:k]] * f[g, p[k:]]), k, f[g, p[:k]], f[g, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            out.append((g, -score, -a, " ".join(p).encode(), left, right, n[g]))
    rows, at = [], Counter()
    for g, s, a, p, left, right, words in sorted(out):
        at[g] += 1
        if at[g] <= top:
            rows.append((g, at[g], p.decode(), -a, left, right, words, -s))
    return rows


def mined(spark, docs, least, top=2000, **options):
    df = spark.createDataFrame([(i, t, g, 1) for i, (t, g) in enumerate(docs)], SCHEMA + ", score int").repartition(4)
    out = phrases.collocations(df, least=least, top=top, **options)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "B", "ccc", "de", "é", "ee-f", "the", "x1", "\x00", "\u00a0"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!", " ; "]
    return [("".join(rng.choice(words[:rng.randint(2, 10)]) + rng.choice(ends) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", None, "und", "DE", ""]))
            for _ in range(n)] + [(None, "en"), ("", None), (". , ;", "en")]


@pytest.mark.parametrize("least, counters", [(20, 1 << 19), (20, 16), (60, 64)])
def test_equals_counts_of_everything(spark, least, counters):
    docs = texts(least)
    want = brute(docs, least, 2000)
    assert want and mined(spark, docs, least, sizes=phrases.Sizes(counters=counters)) == sorted(want)


def test_a_hot_language_repeated_rows_and_ties(spark):
    docs = texts(7, 100) * 3 + [("same same same same same same", "en")] * 50 + [("p q. p r. q p", "de")] * 25
    assert mined(spark, docs, 25, top=7, sizes=phrases.Sizes(chunk=50, vocabulary=8)) == sorted(brute(docs, 25, 7))


def test_one_very_long_text_and_none(spark):
    rng = random.Random(2)
    long = " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 for _ in range(150_000))
    assert mined(spark, [(long, "en")], 300) == sorted(brute([(long, "en")], 300, 2000))
    assert mined(spark, [], 1) == [] and mined(spark, [("only once", "en")], 2) == []


def test_summary_keeps_what_is_frequent():
    rng = np.random.default_rng(4)
    stream = rng.zipf(1.3, 60_000) % 5000
    truth = np.bincount(stream)
    s = phrases.Summary(capacity=400)
    for part in np.array_split(stream, 37):
        k, n = np.unique(part, return_counts=True)
        s.wait.append((k, n))
        s.waiting += len(k)
        s.mass += len(part)
        s.merge()
    assert len(s.keys) <= 400 and 0 < s.lost <= s.mass // 400
    held = dict(zip(s.keys.tolist(), s.counts.tolist()))
    assert all(truth[k] - s.lost <= held.get(k, 0) <= truth[k] for k in range(len(truth)))
    assert set(np.flatnonzero(truth > s.mass // 400)) <= held.keys()


def test_a_pass_is_repeated_where_summaries_lost_too_much(spark):
    docs = texts(11, 60)
    got = mined(spark, docs, 20, sizes=phrases.Sizes(slack=0.01))      # begins with one counter a partition
    assert got == sorted(brute(docs, 20, 2000))


def test_bitmap(spark):
    h = [0, 1, -1, 2 ** 63 - 1, -(2 ** 63), 123456789 << 20]
    b = phrases.Bitmap.of(spark.createDataFrame([(x,) for x in h], "h long"))
    assert b.has(np.array(h, np.int64).view(np.uint64)).all()
    assert b.has(np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).sum() < 100
