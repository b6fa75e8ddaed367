"""Plain Python versions of the operators' contracts."""
import hashlib
import re
from collections import defaultdict

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs, least=20, min_docs=3):
    """docs: (doc_id, text) -> {doc_id: (n_lines, n_dropped, sha256)}"""
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def targets(sizes, weights=(1, 2, 3), cap=3):
    """{source: size} -> {source: target}, by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > cap * sizes[s]}
        if not over:
            return out | {s: w[s] * level for s in free}
        out |= {s: float(cap * sizes[s]) for s in over}
        free -= over
    return out


def shingles(text, n=5):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def jaccard_components(docs, links=False):
    """(doc_id, text) -> {doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                common[ids[b], ids[a]] += 1
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def top_k(vectors, k=20, every=20, score=None):
    """{vec_id: sequence of numbers} -> {query_id: [(vec_id, score)]}, exactly."""
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            found = [(-score(x, y), i) for i, y in vectors.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out
