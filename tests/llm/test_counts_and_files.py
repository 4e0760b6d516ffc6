from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reefcensus.llm.pretokens import BYTE_LEVEL, LIMIT, WORD_ENDS, WordEnds, safe_pieces
from reefcensus.llm.token_counts import _Counter, count_tokens, single_tokens
from reefcensus.llm import token_files
from reefcensus.llm.token_files import (
    EliasFano,
    _Encoder,
    read_token_files,
    read_token_ids,
    token_file_index,
    write_token_files,
)

from .conftest import same

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def test_counts_match_the_library(docs, corpus):
    tok = Tokenizer.from_file(BYTES)
    want = []
    for r in corpus:
        text = r[1] or ""
        n = len(tok.encode(text, add_special_tokens=False).ids)
        want.append((r[0], len(text.encode()), n, n > 1024))
    same(count_tokens(docs, BYTES), want, "doc_id", "n_bytes", "n_tokens", "over_limit")


def test_empty_tables(no_docs):
    assert count_tokens(no_docs, BYTES).count() == 0
    assert token_file_index(no_docs, WORDS).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_patterns_match_the_library_on_every_character(path):
    tok, pattern = Tokenizer.from_file(path), BYTE_LEVEL if path == BYTES else WORD_ENDS
    rng = random.Random(1)
    chars = [chr(c) for c in range(LIMIT) if max(map(ord, chr(c).lower())) < LIMIT]
    texts = [f"a{c}b {c}{c} 1{c}2 '{c} {c}'s\n{c}" for c in chars]
    texts += ["".join(rng.choices(chars[:128] * 6 + chars + ["'s", "'ll", "  ", "\n"] * 9, k=40)) for _ in range(3000)]
    for text in texts:
        if path == WORDS:
            text = tok.normalizer.normalize_str(text)
            pieces = pattern.findall(text.lower())
        else:
            pieces = pattern.findall(text)
        ids = [i for p in pieces for i in tok.encode(p, add_special_tokens=False).ids]
        assert ids == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_shortcut_strings_are_single_tokens():
    tok = Tokenizer.from_file(BYTES)
    proven = single_tokens(BYTES)
    assert len(proven) > 40_000
    for s in random.Random(2).sample(sorted(proven), 300):
        assert len(tok.encode("x" + s if s[0] == " " else s, add_special_tokens=False).ids) <= 2


def file_order(corpus):
    tok = Tokenizer.from_file(WORDS)
    rows = sorted(((r[0], r[1] or "") for r in corpus), key=lambda r: (r[0] is not None, r[0] or 0))
    return [(i, [*tok.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows]


def test_files_round_trip(docs, corpus):
    got = token_file_index(docs, WORDS).collect()
    want = {}
    for i, ids in file_order(corpus):
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    starts = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == starts
        starts += r["n_tokens"]
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert not any(want.values())
    in_file = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert in_file == [i for i, _ in file_order(corpus)]


def test_a_hot_id_is_split_over_parts(spark, tmp_path):
    docs = spark.range(4000).selectExpr("7L as doc_id", "concat('w', id % 3) as text")
    out = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_token_files(docs, out, WORDS)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = read_token_files(spark, out).collect()
    assert sorted(r["start"] for r in got) == sorted(
        np.cumsum([0] + [r["n_tokens"] for r in sorted(got, key=lambda r: r["start"])])[:-1].tolist())
    assert spark.read.parquet(out).select("shard").distinct().count() > 1


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 5000])
def test_elias_fano(n):
    rng = np.random.default_rng(n)
    values = np.cumsum(rng.choice([0, 1, 2, 50, 100_000], n))
    code = EliasFano.encode(values)
    assert (code.all() == values).all()
    assert [code.select(k) for k in range(n)] == values.tolist()
    if n == 5000:
        size = len(code.low) + len(code.high) + len(code.samples)
        assert size * 8 < n * (3 + np.log2(values[-1] / n)) + 32 * n / 256 + 64


def odd_texts(rng, n):
    chars = [chr(c) for c in range(LIMIT)]
    bits = ["'s", "'ll", "'re", "'LL", "'v", "''t", "  ", "\n", "\u00a0", "\u0085", "<|endoftext|>", "<|START", "<|startoftext|>",
            "İ", "Σ", "σς", "é", "e\u0301", " \u0301", "漢字", "😀", "—", "“a”", "Ⱥ", "12", "½", "²", "\x1c", "\u2028", "\u3000"]
    return ["".join(rng.choices(chars[:128] * 3 + chars + bits * 25, k=rng.randint(0, 60))) for _ in range(n)]


def test_batches_of_odd_texts_match_the_library(monkeypatch):
    tok, encoder = Tokenizer.from_file(WORDS), _Encoder(WORDS)
    rng = random.Random(3)
    for cache in (400_000, 50):
        monkeypatch.setattr(token_files, "CACHE_SIZE", cache)
        for _ in range(12):
            texts = odd_texts(rng, 200)
            raw = [t.encode() for t in texts]
            ids, size = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 2)
            at = np.cumsum([0, *size])
            for text, a, b in zip(texts, at, at[1:]):
                assert ids[a:b].tolist() == [*tok.encode(text, add_special_tokens=False).ids, 2], repr(text)


def test_only_runs_with_foreign_characters_go_to_the_library():
    raw = "plain words — and “quoted” ones, 漢字x end".encode()
    tokens = WordEnds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), [])
    assert tokens.texts(np.flatnonzero(tokens.foreign)) == ["—", "“quoted”", "漢字x"]


def test_documents_are_read_by_select(spark, tmp_path, monkeypatch):
    texts = odd_texts(random.Random(5), 700) + ["word " * 3000, "", "x"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "another five")]
    monkeypatch.setattr(token_files, "BLOCK_IDS", 4000)
    out = str(tmp_path / "t")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), out, WORDS)
    wanted = spark.createDataFrame([(i,) for i in (0, 5, 5, 333, 700, 701, 702, 9999)], "doc_id long")
    got = sorted((r["doc_id"], r["ids"]) for r in read_token_ids(spark, out, wanted).collect())
    tok = Tokenizer.from_file(WORDS)
    want = sorted((i, [*tok.encode(t, add_special_tokens=False).ids, 2]) for i, t in rows if i in (0, 5, 333, 700, 701, 702))
    assert got == want


def test_counts_of_odd_texts_match_the_library():
    tok, counter = Tokenizer.from_file(BYTES), _Counter(BYTES, single_tokens(BYTES))
    texts = odd_texts(random.Random(6), 3000)
    for text, n in zip(texts, counter.count(texts)):
        assert n == len(tok.encode(text, add_special_tokens=False).ids), repr(text)


def test_only_pieces_with_foreign_characters_are_merged_by_the_library():
    proven, foreign = safe_pieces("plain words — and “quoted” ones\u3000 x", [])
    assert foreign == [" —", " “quoted”", " ones\u3000 x"] and "".join(proven) == "plain words and"
