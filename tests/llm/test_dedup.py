from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reefcensus.llm import line_dedup, ngram_join, suffix_dedup
from reefcensus.llm.components import connected_components
from reefcensus.llm.line_dedup import drop_lines, duplicate_lines, near_simhashes, with_simhash
from reefcensus.llm.ngram_join import jaccard_components, keep_one
from reefcensus.llm.suffix_dedup import SuffixOrder, suffix_dedup as dedup

from . import brute
from .conftest import same


def byte_rows(corpus):
    out = []
    for r, (raw, mask) in zip(corpus, brute.repeated_bytes([r[1] for r in corpus])):
        kept = bytes(b for b, gone in zip(raw, mask) if not gone)
        spans = sum(1 for k, gone in enumerate(mask) if gone and not (k and mask[k - 1]))
        out.append((r[0], len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_bytes_match_brute_force(docs, corpus):
    same(dedup(docs), byte_rows(corpus), *COLUMNS)


def test_large_groups_match_brute_force(docs, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_SEGMENTS", 1)
    same(dedup(docs), byte_rows(corpus), *COLUMNS)


def test_passages_in_many_contexts(spark, tmp_path):
    rng = random.Random(3)
    passage = "".join(rng.choices("abc ", k=330))
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 300))) + passage[rng.choice((0, 0, 90)):]
             + "".join(rng.choices("abcdefgh ", k=rng.randint(0, 300))) for _ in range(120)]
    texts += ["x" * 450, "xy" * 300, passage * 3]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    same(dedup(spark.read.parquet(str(tmp_path / "t"))), byte_rows(rows), *COLUMNS)


def test_long_texts_in_pieces(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdefghijklmnop ", k=3_000_000))
    rows = [(1, text), (2, text[1_500_000:1_500_300]), (3, text[1_048_500:1_048_800])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["n_removed"] for r in dedup(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {1: 600, 2: 300, 3: 300}


def test_suffix_order_sorts():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    start = rng.integers(0, 3700, 700)
    limit = rng.integers(1, 200, 700)
    group = np.sort(rng.integers(0, 9, 700))
    order = SuffixOrder(data, start, limit, group)
    text = [data[a:a + n].tobytes() for a, n in zip(start, limit)]
    assert [(group[k], text[k]) for k in order.order] == sorted(zip(group.tolist(), text))
    mended = SuffixOrder.__new__(SuffixOrder)
    mended.__dict__ |= {"data": data, "start": start, "limit": limit, "group": group, "common": order.common.copy()}
    mended._sort_exactly()
    assert (mended.common[1:] == order.common[1:]).all()


def join_rows(corpus):
    sets, root = brute.jaccard([r[1] for r in corpus])
    low = {}
    for k, r in enumerate(corpus):
        low.setdefault(root[k], []).append(r[0])
    return [(r[0], len(sets[k]), min((i for i in low[root[k]] if i is not None), default=None))
            for k, r in enumerate(corpus)]


@pytest.mark.parametrize("block", [4096, 4])
def test_join_matches_brute_force(docs, corpus, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", block)
    same(jaccard_components(docs), join_rows(corpus), "doc_id", "n_shingles", "component_id")


def test_join_of_a_group_of_near_copies(spark, tmp_path):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 400)}" for _ in range(130)]
    rows = []
    for i in range(250):
        w = base.copy()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 5000)}"
        rows.append((i, " ".join(w[:rng.choice((130, 128, 60, 10, 11, 9))])))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = jaccard_components(spark.read.parquet(str(tmp_path / "t")))
    same(got, join_rows(rows), "doc_id", "n_shingles", "component_id")


def test_join_of_texts_that_chance_joins(spark, tmp_path, monkeypatch):
    """Texts of few words meet in some shingle. Such a group is taken apart,
    and a text is not sent once a tile."""
    rng = random.Random(13)
    word = lambda: f"w{rng.randint(0, 19)}"
    texts = [[word() for _ in range(rng.randint(30, 60))] for _ in range(300)]
    texts += [w[:k] + [word()] + w[k:] for w in texts[:40] for k in (0, 1, len(w))]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs, sent = spark.read.parquet(str(tmp_path / "t")), []

    def counted(df, *keys, sort=type(docs).sortWithinPartitions):
        sent.append(df.count())
        return sort(df, *keys)

    monkeypatch.setattr(type(docs), "sortWithinPartitions", counted)
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 16)
    same(jaccard_components(docs), join_rows(rows), "doc_id", "n_shingles", "component_id")
    assert 120 < sent[0] < 3 * len(rows)


@pytest.mark.parametrize("percent", [80, 90, 100])
def test_classes_of_sizes_part_no_pair(spark, percent):
    n = spark.range(1, 20_000)
    least = F.ceil(F.col("id") * percent / 100)
    apart = ngram_join.size_class("id", percent) - ngram_join.size_class(least, percent)
    assert n.filter(~apart.between(0, 1)).count() == 0


def test_equal_sets_have_equal_keys():
    rng = random.Random(13)
    texts = [" ".join(rng.choices("abcdefghijkl", k=rng.randint(0, 400))) for _ in range(300)]
    texts = texts + texts[::-1] + ["", "a"] * 3
    raw = "".join(texts).encode()
    offsets = np.cumsum([0, *[len(t) for t in texts]])
    sets = ngram_join.shingle_sets(np.frombuffer(raw, np.uint8), offsets)
    keys = list(zip(*ngram_join.set_keys(sets)))
    assert len({tuple(k) for k in keys}) == len({s.tobytes() for s in sets})
    for own, key in zip(sets, keys):  # the same alone as among others
        assert [int(k[0]) for k in ngram_join.set_keys([own])] == [int(k) for k in key]


def test_copies_in_parts_of_unequal_size(spark, tmp_path):
    """Tasks read large parts first, so the first copy that a task reads need
    not be the one with the smallest number."""
    rng = random.Random(14)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(400)]
    near = [*base[:200], "changed", *base[201:]]
    for part, (doc_id, words, more) in enumerate([(0, base, 0), (1, base, 400), (2, near, 0)]):
        filler = [(100 + 1000 * part + i, " ".join(f"f{rng.randint(0, 10 ** 9)}" for _ in range(200))) for i in range(more)]
        spark.createDataFrame([(doc_id, " ".join(words)), *filler], "doc_id long, text string").coalesce(1) \
            .write.mode("append").parquet(str(tmp_path / "t"))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.minPartitionNum",)}
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        docs = spark.read.parquet(str(tmp_path / "t"))
        got = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).filter("doc_id < 3").collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {0: 0, 1: 0, 2: 0}


def test_words_that_cancel_out_in_one_hash(spark, tmp_path):
    """A Thue-Morse word and its complement are equal modulo powers of two."""
    bits = "a"
    while len(bits) < 4096:
        bits += bits.translate(str.maketrans("ab", "ba"))
    other = bits.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"x {bits} y z"), (2, f"x {other} y z"), (3, f"x {bits} y z")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_one_of_each_group_stays(docs, corpus):
    rows = join_rows(corpus)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    root = brute.jaccard([r[1] for r in corpus])[1]
    assert len(ids) == len(set(root))
    assert {r[2] for r in rows if r[1]} <= set(ids)


def test_empty(no_docs):
    for df in (dedup(no_docs), jaccard_components(no_docs), keep_one(no_docs), duplicate_lines(no_docs)):
        assert df.count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(60, 90)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 60 for i in (*range(60, 90), 100)} | {200: 200, 201: 200}
    assert got == want


def test_near_simhashes(spark):
    rng = random.Random(8)
    sims = {rng.getrandbits(63) for _ in range(60)}
    for s in list(sims):
        for k in (1, 2, 3, 4, 5):
            t = s
            for b in rng.sample(range(63), k):
                t ^= 1 << b
            sims.add(t)
    sims |= {-1, -2, -(1 << 62)}
    got = near_simhashes(spark.createDataFrame([(s,) for s in sims], "sim long")).collect()
    mask = (1 << 64) - 1
    want = {(a, b) for a in sims for b in sims if a < b and ((a ^ b) & mask).bit_count() <= 3}
    assert sorted(map(tuple, got)) == sorted(want)


def test_lines(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(400)]
    long = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(6)]
    near = long[0].replace(long[0].split()[10], long[0].split()[10][:-1] + "z", 1)
    rows = [(1, "\n".join([long[0], "Hi.", long[1]])), (2, long[0].upper() + "!\nHi.\n" + long[2]),
            (3, f"{long[3]} 123\n{long[3]} 999\n\n"), (4, None), (5, ""), (None, long[1]), (6, near), (6, near)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    got = [(r["doc_id"], r["n_lines"], r["removed"]) for r in duplicate_lines(docs).orderBy("rid").collect()]
    assert got[:6] == [(1, 3, []), (2, 3, [0, 1]), (3, 4, [1]), (4, 0, []), (5, 1, []), (None, 1, [0])]
    assert got[7] == (6, 1, [0])  # the same line twice in any case
    left = sorted((r["doc_id"] or 0, r["text"]) for r in drop_lines(docs).filter("doc_id < 4").collect())
    assert left == [(1, rows[0][1]), (2, long[2]), (3, f"{long[3]} 123\n\n")]


def test_odd_lines(docs, corpus):
    got = duplicate_lines(docs).collect()
    assert len(got) == len(corpus)
    assert sorted(r["n_lines"] for r in got) == sorted(0 if r[1] is None else r[1].count("\n") + 1 for r in corpus)


def test_short_lines_go_too(spark, tmp_path):
    rows = [(1, "All rights reserved.\n漢字かな\n---\n\nHome"), (2, "home\nALL RIGHTS RESERVED\n***\n\n漢字かな"),
            (3, "Not the same\nhome home")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["removed"] for r in duplicate_lines(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {1: [], 2: [0, 1, 4], 3: []}


def test_long_lines_have_a_simhash(spark, tmp_path):
    text = "an be co "
    lines = spark.createDataFrame([(1, (text * 5000).strip()), (2, (text * 6000).strip())], "k long, norm string")
    sims = {r["k"]: r["sim"] for r in with_simhash(lines, ["k"]).collect()}
    assert sims[1] == sims[2] is not None
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(17_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:9000], "changed", *words[9001:]]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r["n_removed"] for r in duplicate_lines(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {1: 0, 2: 1}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_copies_of_lines_match_brute_force(spark, tmp_path, monkeypatch):
    """Lines ruled by a frequent word, whose SimHashes are alike, and a group
    of near copies: every group is found, without comparing all pairs."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 5)))
    bases = [" ".join(rng.choice((word(), "the", "the")) for _ in range(n)) for n in (30, 33, 36, 60, 14)]
    texts = bases.copy()
    for _ in range(80):
        w = bases[0].split()
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice(([word()], [w[at], word()], []))
        texts.append(" ".join(w))
    texts = [t for t in dict.fromkeys(texts)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    sims = {r["k"]: r["sim"] for r in with_simhash(spark.createDataFrame(rows, "k long, norm string"), ["k"]).collect()}
    mask, root, linked = (1 << 64) - 1, list(range(len(rows))), 0
    for i, t in rows:
        for j, u in rows[:i]:
            if ((sims[i] ^ sims[j]) & mask).bit_count() <= 3 and _edits(t, u) <= int(max(len(t), len(u)) * 0.2 + 1e-9):
                linked += 1
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    counts = {}

    def counted(df, label, *more, materialize=line_dedup.materialize):
        out = materialize(df, label, *more)
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    got = {r["doc_id"]: r["n_removed"] for r in duplicate_lines(spark.read.parquet(str(tmp_path / "t"))).collect()}
    assert got == {i: int(root[i] != i) for i, _ in rows}
    compared = sum(counts["star"]) + counts["rest"][-1]
    assert linked > 3 * compared


def test_lines_of_unlike_lengths_are_no_pair(spark):
    lines = spark.createDataFrame([(1, 5, 100), (2, 5, 125), (3, 4, 126), (4, 5, 79)], "k long, sim long, chars int")
    assert sorted(map(tuple, line_dedup.near_lines(lines).collect())) == [(1, 2), (2, 3)]


def test_edit_distance_bound(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(300):
        a = [rng.choice("abc  de") for _ in range(rng.randint(1, 60))]
        b = a.copy()
        for _ in range(rng.randint(0, 20)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", " x"])
        a, b = (" ".join("".join(s).split()) or "a" for s in (a, b))
        pairs.append((a, b, rng.randint(0, 14)))
    got = spark.createDataFrame(pairs, "a string, b string, most int").select(
        "a", "b", "most", line_dedup.within_edits(*map(F.col, ("a", "b", "most"))).alias("near")).collect()
    assert all(r["near"] == (_edits(r["a"], r["b"]) <= r["most"]) for r in got)
    assert 50 < sum(r["near"] for r in got) < 250
