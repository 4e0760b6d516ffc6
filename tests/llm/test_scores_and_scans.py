from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from reefcensus.llm import decontaminate as d
from reefcensus.llm import lattice
from reefcensus.llm.lattice import Lattice, Pieces, lattice_scores
from reefcensus.llm.secret_scan import scan_secrets

from . import brute
from .conftest import same

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def base_scores(corpus):
    count, n_train = Counter(), 0
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in corpus]
    for r, h in zip(corpus, held):
        if not h:
            count.update([*brute.words(r[1]), None])
    n_train, distinct = sum(count.values()), len(count)
    out = []
    for r, h in zip(corpus, held):
        tokens = [*brute.words(r[1]), None]
        score = sum(math.log10((count[t] + 1) / (n_train + distinct + 1)) for t in tokens)
        out.append((r[0], h, len(tokens), sum(count[t] > 0 for t in tokens), n_train, round(score, 6)))
    return out


def check_base(docs, corpus):
    rows = [r.asDict() | {"base_score": round(r["base_score"], 6)} for r in lattice_scores(docs, PIECES).collect()]
    keys = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    assert sorted((tuple(r[k] for k in keys) for r in rows), key=repr) == sorted(base_scores(corpus), key=repr)
    assert all(r["score"] < 0 for r in rows)
    return rows


def test_base_scores(docs, corpus):
    rows = check_base(docs, corpus)
    assert len({r["score"] for r in rows if r["doc_id"] == 500}) == 1  # repeated rows


def test_rare_words_are_joined(docs, corpus, monkeypatch):
    monkeypatch.setattr(lattice, "HOT_WORDS", 20)
    check_base(docs, corpus)


def test_no_documents(no_docs):
    assert lattice_scores(no_docs, PIECES).count() == 0
    assert scan_secrets(no_docs).count() == 0
    assert d.decontaminate(no_docs, no_docs.select("item_id", "text")).count() == 0


def all_segmentations(word, table):
    """Probability of a word as the sum over all segmentations."""
    if not word:
        return 1.0
    return sum(table[word[:k]] * all_segmentations(word[k:], table) for k in range(1, len(word) + 1)
               if word[:k] in table)


def test_lattice_sums_all_segmentations():
    pieces = Pieces(PIECES)
    texts = ["▁the", "▁a", "▁unbelievable", "▁größe", "▁漢", "▁" + "ab" * 6]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in raw])
    found = Lattice(pieces, data, offsets)
    logp = np.log(pieces.prior)
    table = {bytes([b]): math.exp(logp[pieces.bytes_at + b]) for b in range(256)}
    from reefcensus.llm.kernel import mix, prefix_hashes, range_hashes

    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i).encode()
        if sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i) or "▁".encode() in piece[1:]:
            continue
        h = mix(range_hashes(prefix_hashes(np.frombuffer(piece, np.uint8)), np.array([0]), np.array([len(piece)])))
        table[piece] = math.exp(logp[pieces.find(h, len(piece))[0]])
    want = [math.log(all_segmentations(r, table)) for r in raw]
    assert np.allclose(found.log_probability(logp), want)
    counts = found.expected_counts(logp, np.ones(len(raw)))
    covered = sum(c * s for c, s in zip(counts, [*pieces.size, *[1] * 257]))
    assert math.isclose(covered, len(data))  # every byte lies in one piece


ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_scan(spark):
    rng = random.Random(5)
    hexed = "".join(rng.choices("0123456789abcdef", k=40))
    keys = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40)) for _ in range(6)]
    texts = [None, "", f"é token='{hexed}' x", "Password : abcdefg", "secret=token: abcdefghij", f"😀AKIA{'B7' * 8}z",
             f"a {hexed}{hexed} AKIA12 api_key=ABCDEFGH.12345 APIKEY:\"q1w2e3r4t5\"", " token=abcdefgh12 ",
             *[f"the key is {k} here" for k in keys], "token=" * 300 + "abcdefgh1",
             "this-is-a-long-identifier-2024-01-01-of-words version_1_of_the_document_final_2",
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1 1234567890123456789012345678901234567890a", "z" * 3000]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kinds = ("assign", "access", "hex")
    for i, t in rows:
        spans = base_spans(t or "")
        r = got[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)], t
        base = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == [s for s in base.split(",") if s]
    added = [i for i, r in got.items() if r["n_random"]]
    assert set(added) <= set(range(8, 14)) and len(added) >= 5
    for i in added:
        a, b = map(int, got[i]["spans"].split(":")[1:])
        assert texts[i][a:b] == keys[i - 8]


def test_scan_odd_rows(docs, corpus):
    want = []
    for r in corpus:
        spans = base_spans(r[1] or "")
        want.append((r[0], *[sum(s[1] == k for s in spans) for k in range(3)]))
    same(scan_secrets(docs), want, "doc_id", "n_assign", "n_access", "n_hex")


def item_rows(corpus, items):
    out = []
    for r in corpus:
        best, n = (0.0, None), 0
        doc = brute.tokens(r[1])
        seeds = {tuple(doc[i:i + 5]) for i in range(len(doc) - 4)}
        for item_id, text in sorted(items):
            item = brute.tokens(text)
            if not any(tuple(item[i:i + 5]) in seeds for i in range(len(item) - 4)):
                continue
            c = brute.tile_coverage(item, doc)
            n += c >= d.COVERAGE
            best = max(best, (c, item_id), key=lambda x: x[0])
        out.append((r[0], n, best[1], round(best[0], 9), n > 0))
    return out


def leak_tables(spark, tmp_path):
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("a", "er", "on", "ist")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(3, 40))).capitalize() + ".") for i in range(12)]
    docs = []
    for i in range(40):
        doc = rng.choices(words, k=rng.randint(0, 80))
        item = items[i % 12][1].split()
        cut = len(item) // 2
        doc[len(doc) // 2:len(doc) // 2] = [item, item[cut:] + ["x"] + item[:cut], item[:cut], [w.upper() for w in item]][i % 4]
        docs.append((i, " ".join(doc)))
    docs += [(40, None), (41, ""), (3, docs[3][1]), (None, docs[0][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    bench = spark.createDataFrame([*items, (None, "a b c d e f"), (50, None)], "item_id long, text string")
    return docs, items, spark.read.parquet(str(tmp_path / "d")), bench


def test_tiles_match_brute_force(spark, tmp_path, monkeypatch):
    docs, items, table, bench = leak_tables(spark, tmp_path)
    want = item_rows(docs, items)
    for size in (d.SLICE_BYTES, 600):  # at once, and in slices
        monkeypatch.setattr(d, "SLICE_BYTES", size)
        got = d.decontaminate(table, bench).selectExpr("*", "round(coverage, 9) as c")
        same(got, want, "doc_id", "n_items", "item_id", "c", "contaminated")
    assert d.drop_contaminated(table, bench).count() == sum(not w[-1] for w in want)


def test_odd_documents(docs, corpus, spark):
    bench = spark.createDataFrame([(1, corpus[0][1]), (2, "one two")], "item_id long, text string")
    got = {(r["doc_id"], r["contaminated"]) for r in d.decontaminate(docs, bench).collect()}
    assert {(0, True), (1, True), (2, True), (3, False), (6, False), (None, True)} <= got


def test_tiles_of_repeated_words():
    rng = random.Random(15)
    for _ in range(60):
        item = np.array([rng.choice((1, 1, 1, 2, 3)) for _ in range(rng.randint(5, 40))], np.uint64)
        doc = np.array([rng.choice((1, 1, 1, 2, 3, 4)) for _ in range(rng.randint(5, 60))], np.uint64)
        covered = sum(t[2] for t in d.tile(item, doc)) / len(item)
        assert covered == brute.tile_coverage(item.tolist(), doc.tolist())
    # a million times one word: every place is passed over once
    tiles = d.tile(np.full(1200, 7, np.uint64), np.concatenate((np.full(10 ** 6, 7, np.uint64), [np.uint64(8)])))
    assert tiles == [(0, 0, 1200)]
    item = np.concatenate([[100 + k, *[7] * 6] for k in range(150)]).astype(np.uint64)
    tiles = d.tile(item, np.full(300_000, 7, np.uint64))
    assert len(tiles) == 150 and {t[2] for t in tiles} == {6}


def test_a_whole_text_sums_all_its_segmentations(spark, tmp_path):
    """score of whole texts against enumeration with the fitted weights, and
    what the fitting adds on held-out texts."""
    pieces = Pieces(PIECES)
    rows = [(i, t) for i, t in enumerate(["the cat sat", "The  mat\tsat", "a cat", "the the hat zq", "", None, "cats that sat on mats"])]
    rows += [(100 + i, "the cat sat on the mat") for i in range(6)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    got = {r["doc_id"]: r for r in lattice_scores(docs, PIECES).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, t in rows if not held[i] for w in brute.words(t))
    words = spark.createDataFrame([(w.encode(), c) for w, c in counts.items()], "word binary, c long")
    logp = lattice.fit_pieces(words, sum(not h for h in held.values()), pieces)
    table = {}

    def weight(piece):  # by hash, as bytes of one length and hash are one piece
        raw = np.frombuffer(piece, np.uint8)
        if piece not in table:
            h = lattice.mix(lattice.range_hashes(lattice.prefix_hashes(raw), np.array([0]), np.array([len(raw)])))
            k = pieces.find(h, len(raw))[0]
            table[piece] = logp[k] if k >= 0 else logp[pieces.bytes_at + int(raw[0])] if len(raw) == 1 else None
        return table[piece]

    def total(word):
        if not word:
            return 1.0
        return sum(math.exp(w) * total(word[n:]) for n in range(1, len(word) + 1)
                   if (w := weight(word[:n])) is not None)

    for i, text in rows:
        want = sum(math.log10(total(lattice.BOUNDARY + w.encode())) for w in brute.words(text)) \
            + logp[pieces.end] / math.log(10)
        assert abs(got[i]["score"] - want) < 1e-9, text


def test_fitting_raises_the_held_out_likelihood(spark):
    """One round of expected counts against the vocabulary's scores alone, on
    the texts of sf0.001 that are held out."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

    def held_out(share):
        before, lattice.PRIOR_SHARE = lattice.PRIOR_SHARE, share
        try:
            rows = lattice_scores(docs, PIECES).filter("held_out").collect()
        finally:
            lattice.PRIOR_SHARE = before
        return sum(r["score"] for r in rows) / sum(r["n_tokens"] for r in rows)

    fitted, scores_alone = held_out(lattice.PRIOR_SHARE), held_out(1.0)
    assert fitted > scores_alone + 1  # a factor of ten a word


def test_remembered_words_have_the_same_values(monkeypatch):
    pieces = Pieces(PIECES)
    logp = np.log(pieces.prior)
    rng = random.Random(17)
    for most in (1 << 20, 30):
        monkeypatch.setattr(lattice, "KNOWN_WORDS", most)
        values = lattice._Values(pieces, logp)
        for _ in range(12):
            text = " ".join("".join(rng.choices("abcé漢", k=rng.randint(1, 3))) for _ in range(80)).encode()
            _, hashes, _, raw, ends = lattice._distinct_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            want = np.zeros(len(hashes))
            for a, b, own in lattice._lattices(pieces, raw, ends):
                want[a:b] = own.log_probability(logp)
            assert np.allclose(values.of(hashes, raw, ends), want, rtol=1e-12)
