import random

import numpy as np
import pytest

from voltcube.llm import pieces
from voltcube.llm.queries import PIECE_MODEL

sp = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def vocab():
    return pieces.Vocabulary.load(PIECE_MODEL)


def texts():
    rng = random.Random(3)
    alphabet = "ab the  ingtion  \n\t▁éü日本x<0x41><s>.,!!  1234\x1e\r😀"
    out = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(4000)]
    return out + [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)] + ["", "x" * 5000, "\n\n", " a", "a ", "ab" * 3000 + " end"]


def test_ids_are_those_of_the_library(vocab):
    library = sp.SentencePieceProcessor(model_file=PIECE_MODEL)
    mine, ts = pieces.Encoder(vocab), texts()
    want = library.encode(ts)
    for _ in range(2):                                    # the second time from kept words
        assert [x.tolist() for x in mine.encode(ts)] == want
    assert [mine.decode(x) for x in want] == [library.decode(x) for x in want]
    assert mine.decode(np.array([], int)) == ""


def test_cache_and_unknown_limits(vocab, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 50)
    library = sp.SentencePieceProcessor(model_file=PIECE_MODEL)
    mine, ts = pieces.Encoder(vocab), texts()
    for at in range(0, len(ts), 100):
        assert [x.tolist() for x in mine.encode(ts[at:at + 100])] == library.encode(ts[at:at + 100])


def as_unigram(data: bytes, bytes_too: bool) -> bytes:
    """The model file with its type changed to unigram, and byte pieces made ordinary ones if asked."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def put(number, value):
        return varint(number << 3 | (2 if isinstance(value, bytes) else 0)) + (varint(len(value)) + value if isinstance(value, bytes) else varint(value))

    out = b""
    for number, value in pieces.fields_of(data):
        if number == 1:
            f = dict(pieces.fields_of(value))
            score = float(np.frombuffer(f.get(2, b"\0" * 4), "<f4")[0])
            score = -30.0 if score < -1e6 else score / 4000 - 3           # like log probabilities
            value = put(1, f[1]) + varint(2 << 3 | 5) + np.float32(score).tobytes() + (put(3, f[3]) if 3 in f else b"")
        elif number == 2:
            value = b"".join(put(3, 1) if n == 3 else varint(n << 3 | 5) + v if isinstance(v, bytes) and n in (10, 15) else put(n, v)
                             for n, v in pieces.fields_of(value) if n != 35 or bytes_too)
        out += put(number, value)
    return out


def test_unigram_viterbi():
    data = as_unigram(open(PIECE_MODEL, "rb").read(), True)
    library = sp.SentencePieceProcessor(model_proto=data)
    vocab = pieces.Vocabulary.parse(data)
    assert vocab.unigram
    mine, ts = pieces.Encoder(vocab), [t for t in texts() if len(t) < 200]

    def score(ids):
        return sum(vocab.scores[i] for i in ids if vocab.kinds[i] == 1)
    for t, a, b in zip(ts, mine.encode(ts), library.encode(ts), strict=True):
        # Equal scores may be reached by different paths.
        assert a.tolist() == b or score(a) == pytest.approx(score(b), rel=1e-5), t
        assert mine.decode(a) == library.decode(b)


def test_shared_prefixes_are_not_computed_again(vocab):
    e, seen = pieces.Encoder(vocab), []
    grow = e._grow_merges
    e._grow_merges = lambda word, keep, *rest: (seen.append(len(word) - keep), grow(word, keep, *rest))[1]
    e.walk(["▁nation", "▁national", "▁nationality", "▁nations"])
    assert seen == [7, 2, 3, 1]


def test_frames(spark, vocab):
    from voltcube.llm.common import ship
    ship(spark)
    rows = [(1, "a b", "z"), (2, None, "z"), (3, "", None), (1, "a b", "z"), (4, "the end\n" * 40_000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = pieces.round_trip(df, vocab)
    assert out.columns == ["doc_id", "text", "ids", "n_pieces", "intact"]
    got = {r.doc_id: r for r in out.collect()}
    library = sp.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert got[1].ids == library.encode("a b") and got[1].n_pieces == 2 and got[2].ids is None and got[2].intact is None and got[3].ids == []
    assert got[4].ids == library.encode("the end\n" * 40_000) and got[4].intact and got[3].intact
    assert pieces.encode(df.limit(0), vocab).count() == 0 and out.count() == 5


def test_other_models_are_refused():
    data = open(PIECE_MODEL, "rb").read()
    with pytest.raises(ValueError):
        pieces.Vocabulary.parse(data.replace(b"identity", b"nmt_nfkc"))


def test_a_full_cache_keeps_the_words_in_use(vocab, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 5)
    e = pieces.Encoder(vocab)
    e.encode(["the end of the day"])
    seen, walk = [], e.walk
    e.walk = lambda words: (seen.extend(words), walk(words))[1]
    got = e.encode(["the end is near us"])
    assert seen == ["▁is", "▁near", "▁us"] and "day" not in e.cache
    assert got[0].tolist() == sp.SentencePieceProcessor(model_file=PIECE_MODEL).encode("the end is near us")


def test_the_search_for_cycles_rests_while_words_are_encoded(vocab):
    import gc
    e, seen = pieces.Encoder(vocab), []
    walk = e.walk
    e.walk = lambda words: (seen.append(gc.isenabled()), walk(words))[1]
    e.encode(["the end"])
    assert seen == [False] and gc.isenabled()
    gc.disable()
    try:
        e.encode(["an end"])
        assert not gc.isenabled()
    finally:
        gc.enable()
