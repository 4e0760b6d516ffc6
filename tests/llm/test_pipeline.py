from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from . import brute
from .test_quality_and_mixing import cleaned, rules
from .test_scores_and_scans import item_rows

SF_DIR = "/root/testdata/sf0.001"


def five_word_groups(texts):
    def shingles(text):
        w = brute.words(text)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()

    sets = [shingles(t) for t in texts]
    return brute.groups(len(sets), [
        (a, b) for a, b in combinations(range(len(sets)), 2) if sets[a] and sets[b]
        and 100 * (i := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - i)])


def test_pipeline_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    rows = [(i, cleaned(t or ""), s) for i, t, s in rows if rules(t)[-1]]
    rows.sort()
    root = five_word_groups([r[1] for r in rows])
    rows = [r for k, r in enumerate(rows) if root[k] == k]
    rows = [r for r, found in zip(rows, item_rows(rows, items)) if not found[-1]]
    copies = brute.mix(rows)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r, n in zip(rows, copies):
        ids = [*tok.encode(r[1], add_special_tokens=False).ids, 2]
        for _ in range(n):
            want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == want and len(want) > 50


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.dtypes == docs.dtypes


def test_stages_of_nothing(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_near_duplicate_stage_takes_five_words_and_80_percent(spark, tmp_path):
    rng = random.Random(11)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
    added = base + [f"x{i}" for i in range(60)]  # 0.83 on any shingles
    changed = base.copy()
    for i in (50, 100, 150, 200, 250):  # 0.85 on five words, 0.90 on three
        changed[i] = f"y{i}"
    far = base + [f"z{i}" for i in range(90)]  # 0.77
    short = [base[:k] for k in (3, 4, 5)]
    texts = [" ".join(w) for w in (base, added, changed, far, *short, base[:4])] + [None, "", ""]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    kept = corpus_pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "t")), SF_DIR)
    root = five_word_groups(texts)
    assert root[1] == root[2] == 0 and root[3] == 3 and root[7] == 5
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))
