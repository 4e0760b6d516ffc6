"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def groups(n, linked):
    """Smallest index of each index's group."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(x) for x in range(n)]


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()


def jaccard(texts):
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] and sets[b]
             and 100 * (i := len(sets[a] & sets[b])) >= 90 * (len(sets[a]) + len(sets[b]) - i)]
    return sets, groups(len(sets), links)


def repeated_bytes(texts, length=200):
    """Mask of removed bytes per text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        mask = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                mask[s:s + length] = b"\1" * length
        out.append((b, mask))
    return out


def tokens(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def tile_coverage(item, doc, shortest=5):
    """Greedy string tiling by trying every pair of places."""
    free_i, free_d = [True] * len(item), [True] * len(doc)
    covered = 0
    while True:
        best, places = shortest - 1, []
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (i + k < len(item) and j + k < len(doc) and free_i[i + k] and free_d[j + k]
                       and item[i + k] == doc[j + k]):
                    k += 1
                if k > best:
                    best, places = k, [(i, j)]
                elif k == best and k >= shortest:
                    places.append((i, j))
        if best < shortest:
            return covered / len(item) if item else 0
        for i, j in places:
            if all(free_i[i:i + best]) and all(free_d[j:j + best]):
                free_i[i:i + best] = free_d[j:j + best] = [False] * best
                covered += best


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, total, open_ = {}, sum(sizes.values()), list(names)
    while True:
        level = (total - sum(out.values())) / (sum(w[s] for s in open_) or 1)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            open_.remove(s)


def mix(rows):
    """Copies of each ``(doc_id, text, source)``; ids differ."""
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    by = Counter()
    for r, n in zip(rows, size):
        by[r[2]] += n
    target, copies = water_fill(by), [0] * len(rows)
    for source in by:
        own = sorted((k for k, r in enumerate(rows) if r[2] == source),
                     key=lambda k: int(hashlib.md5(str(rows[k][0]).encode()).hexdigest()[:15], 16))
        whole = int(target[source] // by[source]) if by[source] else 0
        budget, before = target[source] - whole * by[source], 0
        for k in own:
            more = before < budget and (before + size[k] <= budget or (budget - before) / size[k] >= 0.5)
            copies[k] = min(3, whole + (more and budget > 0))
            before += size[k]
    return copies
