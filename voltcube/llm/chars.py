"""Hashed character n-grams of whole texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import regex

LETTER = regex.compile(r"\p{L}")
#: Code points worked on together; longer texts are taken piece by piece.
PIECE = 1 << 20
_SEED = (0, 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)


def _letters() -> np.ndarray:
    t = np.full(1 << 16, 32, np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            t[c] = c
    return t


_LETTERS: np.ndarray | None = None


def letter_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text between spaces; all but letters are spaces, runs of them one."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letters()
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    far = np.unique(cp[cp >= 1 << 16])
    others = far[[not chr(c).isalpha() for c in far.tolist()]] if len(far) else far
    cp = np.where(cp < 1 << 16, _LETTERS[np.minimum(cp, (1 << 16) - 1)], np.where(np.isin(cp, others), 32, cp) if len(others) else cp).astype(np.uint32)
    cp = np.concatenate([[np.uint32(32)], cp, [np.uint32(32)]])
    return cp[~((cp == 32) & np.concatenate([[False], cp[:-1] == 32]))]


def raw_points(text: str) -> np.ndarray:
    """Code points of the text between spaces, white space as one space, letters' case kept."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    cp = np.where((cp >= 9) & (cp <= 13), np.uint32(32), cp)
    cp = np.concatenate([[np.uint32(32)], cp, [np.uint32(32)]])
    return cp[~((cp == 32) & np.concatenate([[False], cp[:-1] == 32]))]


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h


def ngram_buckets(cp: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram at each position (none for a text shorter than n)."""
    m = len(cp) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint32)
    h = np.full(m, _SEED[n], np.uint32)
    for j in range(n):
        h *= np.uint32(0x01000193)
        h ^= cp[j:j + m]
    return _mix(h) >> np.uint32(32 - bits)


def word_buckets(cp: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of each word (what lies between spaces)."""
    sp = np.flatnonzero(cp == 32)
    starts, ends = sp[:-1] + 1, sp[1:]
    full = ends > starts
    starts, ends = starts[full], ends[full]
    if not len(starts):
        return np.zeros(0, np.uint32)
    # A polynomial in the position counted from the word's start; sums wrap.
    pos = (np.arange(len(cp)) - np.repeat(np.concatenate([[0], sp]), np.diff(np.concatenate([[0], sp, [len(cp)]])))).astype(np.uint32)
    v = _mix(cp * np.uint32(0x9E3779B1) + pos * np.uint32(0x7FEB352D))
    v *= np.uint32(2 * 0x2545F491 + 1)
    acc = np.concatenate([[np.uint32(0)], np.cumsum(v, dtype=np.uint32)])
    return _mix((acc[ends] - acc[starts]) ^ np.uint32(_SEED[5])) >> np.uint32(32 - bits)


def groups(points: list[np.ndarray]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts in groups of about PIECE code points."""
    ids, held, n = [], [], 0
    for i, p in enumerate(points):
        if held and n + len(p) > PIECE:
            yield ids, held
            ids, held, n = [], [], 0
        ids.append(i)
        held.append(p)
        n += len(p)
    if held:
        yield ids, held
