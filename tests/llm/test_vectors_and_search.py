from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reefcensus.llm import lexical, near_vectors as near, whitening
from reefcensus.llm.lexical import ranked_search
from reefcensus.llm.near_vectors import drop_near_vectors, near_vectors
from reefcensus.llm.whitening import jacobi_davidson, minres, whiten

from .brute import LOWER, groups
from .conftest import same

#: extra columns have the names that the operators use inside
VECTORS = "vec_id long, embedding array<float>, label int, rid long, rep long, h long, x int, n long, component string, held int"


def vector_rows(spark, tmp_path, rows, parts=3):
    rows = [(*r, 1, 2, 3, 4, 5, "c", 6) for r in rows]
    path = str(tmp_path / "vectors")
    spark.createDataFrame(rows, VECTORS).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def odd_vectors(rng, dim=12):
    base = rng.standard_normal((60, dim)).astype(np.float32)
    rows = [(i, base[i].tolist(), i % 3) for i in range(60)]
    for k in range(30):  # near copies in a chain and around one point, copies, other labels
        v = base[k % 7] + rng.standard_normal(dim).astype(np.float32) * (0.02, 0.05, 0.08)[k % 3]
        rows.append((100 + k, v.astype(np.float32).tolist(), (k % 7) % 3))
    rows += [(200 + k, base[3].tolist(), 0) for k in range(9)] + [(300, base[3].tolist(), 1), (301, base[3].tolist(), None)]
    rows += [(302, (base[3] * 1000).tolist(), 0), (303, (base[3] * 1e-30).tolist(), 0), (304, (-base[3]).tolist(), 0)]
    rows += [(400, None, 0), (401, [0.0] * dim, 0), (402, [-0.0] * dim, 0), (403, [float("nan")] * dim, 0),
             (404, [float("inf")] + [1.0] * (dim - 1), 0), (405, [None] + [1.0] * (dim - 1), 0), (406, [], 0),
             (407, [1.0] * (dim + 1), 0), (408, [1.0] * (dim + 1), 0), (None, base[5].tolist(), 2), (None, None, None),
             (5, base[5].tolist(), 2), (5, base[5].tolist(), 2)]
    return rows


def brute_near(rows, cosine=0.98):
    def unit(v):
        if v is None or not v or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units, links = [unit(r[1]) for r in rows], []
    for a in range(len(rows)):
        for b in range(a):
            if (units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] is not None
                    and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine):
                links.append((a, b))
    held, root = Counter(x for link in links for x in link), groups(len(rows), links)
    low = {}
    for k, r in enumerate(rows):
        low.setdefault(root[k], []).append(r[0])
    out = []
    for k, r in enumerate(rows):
        least = min((i for i in low[root[k]] if i is not None), default=None)
        out.append((r[0], held[k], least, r[0] == least))
    return out


@pytest.mark.parametrize("tile", [2048, 4])
def test_near_vectors_match_brute_force(spark, tmp_path, monkeypatch, tile):
    monkeypatch.setattr(near, "TILE", tile)
    rows = odd_vectors(np.random.default_rng(2))
    # a recall of nearly one, so that no pair at the threshold is left to chance
    got = near_vectors(vector_rows(spark, tmp_path, rows), recall=1 - 1e-7)
    same(got, brute_near(rows), "vec_id", "n_links", "component_id", "kept")


def test_near_vectors_of_one_large_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near, "TILE", 100)
    rng = np.random.default_rng(3)
    base = rng.standard_normal(16)
    rows = [(i, (base + rng.standard_normal(16) * 0.03).tolist(), 1) for i in range(500)]
    rows += [(1000 + i, rng.standard_normal(16).tolist(), 1) for i in range(200)]
    got = near_vectors(vector_rows(spark, tmp_path, rows), recall=1 - 1e-9)
    same(got, brute_near(rows), "vec_id", "n_links", "component_id", "kept")


def test_recall_at_the_threshold(spark, tmp_path):
    """Pairs of a cosine just above the threshold, with the default recall."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(600):
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(32)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.9802
        rows += [(2 * k, a.tolist(), 0), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 0)]
    got = near_vectors(vector_rows(spark, tmp_path, rows)).collect()
    want = {r[0]: r[1] for r in brute_near(rows)}
    assert sum(want.values()) >= 1200
    found = sum(r["n_links"] for r in got)
    assert 0.95 * sum(want.values()) <= found <= sum(want.values())
    assert all(r["n_links"] <= want[r["vec_id"]] for r in got)


def test_collision_probability():
    rng = np.random.default_rng(5)
    for distance, step in ((0.2, 1.6), (1.0, 1.6), (1.4, 1.6)):
        gap = rng.standard_normal(200_000) * distance
        at = rng.uniform(0, step, 200_000)
        measured = (np.floor((at + gap) / step) == 0).mean()
        assert abs(measured - near.collision(distance, step)) < 0.005


def test_near_vectors_that_stay(spark, tmp_path):
    rows = odd_vectors(np.random.default_rng(2))
    docs = vector_rows(spark, tmp_path, rows)
    kept = drop_near_vectors(docs, recall=1 - 1e-7)
    assert kept.columns == docs.columns
    stay = {r[0] for r in brute_near(rows) if r[3]}
    assert sorted(map(repr, (r["vec_id"] for r in kept.collect()))) == sorted(repr(r[0]) for r in rows if r[0] in stay)


def brute_whiten(rows, wanted=16):
    def scaled(v):
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            return None
        return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]

    x = [(r[0], scaled(r[1])) for r in rows]
    x = [(i, v) for i, v in x if v]
    if not x:
        return [], None
    width = max(Counter(len(v) for _, v in x).items(), key=lambda e: (e[1], e[0]))[0]
    x = [(i, v) for i, v in x if len(v) == width]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n - 1_000_000 for s in sums])
    y = np.array(fit, float) - 1_000_000 - mean
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(wanted, width)
    out = []
    for i, v in x:
        z = (np.array(v, float) - 1_000_000 - mean) @ axes[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300))
        dev = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        out += [(i, c + 1, n, dev, z[c], values[c] / max(values.sum(), 1e-300)) for c in range(k)]
    return out, values


def test_whitening_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [r for r in odd_vectors(rng, 24) if r[0] != 302]  # so long that it would hide the other directions
    want, values = brute_whiten(rows)
    assert (np.diff(values[:17]) < -1e-6).all()
    got = whiten(vector_rows(spark, tmp_path, rows)).collect()

    def key(r):
        return (r[0] is None, r[0] or 0, r[1], r[3], abs(r[4]))

    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    sign = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 0.1:
            sign.setdefault(g[1], np.sign(g[4] * w[4]))
    for g, w in zip(got, want):
        assert abs(g[4] * sign[g[1]] - w[4]) < 1e-9
        assert abs(g[5] - w[5]) < 1e-14 * 100  # of the largest, which is about 1
        assert g[6] == got[0][6] < 1e-10


@pytest.mark.parametrize("dim", [1, 3, 90, 200])
def test_jacobi_davidson(dim):
    rng = np.random.default_rng(7)
    a = rng.standard_normal((dim, dim + 20))
    a = a @ a.T
    calls = []
    values, axes = jacobi_davidson(lambda q: (calls.append(q.shape[1]), a @ q)[1], dim, 16)
    k = min(16, dim)
    assert values.shape == (k,) and np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=1e-13)
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-13
    assert np.linalg.norm(a @ axes - axes * values, axis=0).max() < 1e-12 * values[0]
    assert len(calls) < 400


def test_jacobi_davidson_of_odd_matrices():
    for a in (np.zeros((5, 5)), np.eye(40), np.diag([1.0] * 20 + [0.0] * 30), np.diag([1e8, 1, 1, 1e-8])):
        values, axes = jacobi_davidson(lambda q, a=a: a @ q, len(a), 16)
        k = min(16, len(a))
        assert np.allclose(values, np.sort(np.diag(a))[::-1][:k], atol=1e-12 * max(1, a.max()))
        assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-12


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(8)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    rhs = np.column_stack((rng.standard_normal((30, 4)), np.zeros(30)))
    x = minres(lambda z: a @ z, rhs, 200, 1e-12)
    assert np.abs(a @ x - rhs).max() < 1e-8 and not x[:, 4].any()


def test_whitening_of_few_and_no_rows(spark, tmp_path):
    rows = [(1, [0.5, 1.0, 2.0], 0), (2, [0.5, 1.0, 2.0], 0), (3, None, 0), (4, [1.0], 0)]
    got = whiten(vector_rows(spark, tmp_path / "a", rows)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"]) for r in got) == [
        (i, c, 1, 0, None) for i in (1, 2) for c in (1, 2, 3)]
    rows += [(5, [1.5, 1.0, 2.0], 0)]  # one direction has variance
    got = whiten(vector_rows(spark, tmp_path / "b", rows)).collect()
    assert sorted((r["vec_id"], round(abs(r["whitened"]), 9)) for r in got if r["component"] == 1) == [
        (1, 1.0), (2, 1.0), (5, 1.0)]
    assert all(r["whitened"] is None for r in got if r["component"] > 1)
    assert whiten(vector_rows(spark, tmp_path / "c", rows).limit(0)).count() == 0
    assert whiten(vector_rows(spark, tmp_path / "d", [(1, None, 0), (2, [], 0)])).count() == 0
    assert near_vectors(vector_rows(spark, tmp_path / "e", rows).limit(0)).count() == 0


def test_deviation_beyond_a_long(spark, tmp_path):
    rows = [(1, [1e15, 0.0], 0), (2, [-1e15, 0.0], 0), (3, [1e6, 1.0], 0), (4, [1e30, 1.0], 0)]
    got = {r["vec_id"]: r["deviation"] for r in whiten(vector_rows(spark, tmp_path, rows)).collect()}
    want = {i: d for i, _, _, d, _, _ in brute_whiten(rows[:3])[0]}
    assert got == {i: d if d < 1 << 63 else None for i, d in want.items()}


def brute_search(docs, items, top=50):
    def terms(text):
        return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").translate(LOWER))

    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), c in zip(docs, counts):
            m = 50 + 50 * sum(c.values()) * n_docs // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        scores.sort()
        out += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return out


ITEMS = "item_id long, text string, doc_id long, terms string, rank int, m int"


def item_rows(corpus):
    bits = [r[1].split() for r in corpus if r[1] and len(r[1]) > 300]
    rng = random.Random(12)
    texts = [" ".join(rng.choice(bits)[k:k + 30]) for k in range(12)] + [None, "", "...", "zz9 nowhere", "an AN be",
                                                                        "漢字かな é größe", bits[0][0] * 400]
    return [(i, t, 1, "t", 2, 3) for i, t in enumerate(texts)] + [(None, texts[0], 1, "t", 2, 3), (3, texts[3], 1, "t", 2, 3)]


@pytest.mark.parametrize("block, top, slice_bytes", [(4096, 50, 8 << 20), (3, 4, 8 << 20), (5, 7, 1000)])
def test_search_matches_brute_force(spark, docs, corpus, monkeypatch, block, top, slice_bytes):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "SLICE_BYTES", slice_bytes)
    items = item_rows(corpus)
    got = ranked_search(docs, spark.createDataFrame(items, ITEMS), top)
    want = brute_search([(r[0], r[1]) for r in corpus], [i[:2] for i in items], top)
    same(got, want, "item_id", "rank", "doc_id", "score")


def test_search_of_scores_beyond_doubles(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(lexical, "EXACT", 1)
    items = item_rows(corpus)
    got = ranked_search(docs, spark.createDataFrame(items, ITEMS))
    want = brute_search([(r[0], r[1]) for r in corpus], [i[:2] for i in items])
    same(got, want, "item_id", "rank", "doc_id", "score")


def test_search_in_and_for_nothing(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "an be co", 1, "t", 2, 3)], ITEMS)
    assert ranked_search(no_docs, items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    assert ranked_search(docs, items.withColumn("text", items["text"].substr(0, 0))).count() == 0


def test_vocabulary_compares_bytes(monkeypatch):
    """Words of one hash are told apart, in the vocabulary and in texts."""
    def one_hash(prefix, start, end):
        return np.zeros(len(start), np.uint64)

    monkeypatch.setattr("reefcensus.llm.kernel.range_hashes", one_hash)
    vocabulary = lexical.Vocabulary(["ab", "cd", "abc"])
    raw = np.frombuffer(b"AB abc xy cd cde", np.uint8)
    words = lexical.Words(raw, np.array([0, len(raw)]), lexical.PUNCTUATION)
    assert vocabulary.numbers(words, raw).tolist() == [0, 2, -1, 1, -1]
