"""Row ids stay with their rows when scans are split otherwise between jobs."""

from __future__ import annotations

import random

import pytest

from reefcensus.llm import components, decontaminate, line_dedup, mixing, ngram_join, store, suffix_dedup

_RNG = random.Random(12)
PROSE = [" ".join("".join(_RNG.choices("abcdefghijklmnop", k=6)) for _ in range(60)) for _ in range(4)]
#: file by file: each text but the last has a copy in another file
TEXTS = [PROSE[0], PROSE[1], PROSE[2], PROSE[0], PROSE[1], PROSE[2], PROSE[3]]


@pytest.fixture
def moving(spark, tmp_path, monkeypatch):
    """A table of seven files in one to seven scan tasks, as many as the jobs
    written so far say."""
    path = str(tmp_path / "t")
    for i, t in enumerate(TEXTS):
        spark.createDataFrame([(i, t, "ab"[i % 2])], "doc_id long, text string, source string") \
            .coalesce(1).write.mode("append").parquet(path)
    jobs = [0]
    write = store.materialize

    def materialize(df, *args):
        out = write(df, *args)
        jobs[0] += 1
        spark.conf.set("spark.sql.files.minPartitionNum", [1, 7, 3][jobs[0] % 3])
        return out

    for module in (components, decontaminate, line_dedup, mixing, ngram_join, store, suffix_dedup):
        monkeypatch.setattr(module, "materialize", materialize)
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    yield spark.read.parquet(path)
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_bytes(moving):
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(moving).collect()}
    assert got == {i: len(t) if i < 6 else 0 for i, t in enumerate(TEXTS)}


def test_join(moving):
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(moving).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 0, 4: 1, 5: 2, 6: 6}


def test_one_of_each_group(moving):
    assert sorted(r["doc_id"] for r in ngram_join.keep_one(moving).collect()) == [0, 1, 2, 6]


def test_lines(moving):
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.duplicate_lines(moving).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 0}
    left = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(moving).collect()}
    assert left == {i: t if i in (0, 1, 2, 6) else "" for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("size", [1 << 20, 700])
def test_contaminated(spark, moving, monkeypatch, size):
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", size)
    items = spark.createDataFrame([(1, PROSE[1]), (2, PROSE[3]), (3, PROSE[0][::-1])], "item_id long, text string")
    got = {r["doc_id"]: r["item_id"] for r in decontaminate.decontaminate(moving, items).collect()}
    assert got == {0: None, 1: 1, 2: None, 3: None, 4: 1, 5: None, 6: 2}
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(moving, items).collect()) == [0, 2, 3, 5]


def test_mix(moving):
    want = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(moving).collect()}
    ids = [r["doc_id"] for r in mixing.take_mix(moving).collect()]
    assert {i: ids.count(i) for i in want} == want
