from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from reefcensus.llm.mixing import mix_sources, targets, word_count
from reefcensus.llm.quality import quality_rules

from .conftest import same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


PHRASES = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use of cookies",
           "enable javascript", "lorem ipsum", "powered by", "subscribe to our newsletter", "copyright (c)", "copyright ©",
           "licensed under the")
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "next", "previous", "back to top",
        "skip to content", "read more", "click here", "share this", "search")
NO_LETTERS = "".join(chr(c) for c in range(128) if not chr(c).isalpha())


def bad_line(line):
    """The line rules without patterns: boilerplate, menus, no sentence mark."""
    low = line.lower()
    if any(p in low for p in PHRASES) or low.strip(NO_LETTERS) in MENU:
        return True
    marks = at = 0
    while at < len(line):
        if line[at] in "|»›•·":
            marks += 1
        elif line[at] in " \t" and line[at + 1: at + 2] in (">", "/") and line[at + 2: at + 3] in (" ", "\t"):
            marks += 1
            at += 2
        at += 1
    return marks >= 2 or not any(c in ".!?…。！？।؟:;" for c in line)


def cleaned(text):
    lines = text.split("\n")
    bad = [WORD.search(x) is not None and bad_line(x) for x in lines]
    return "\n".join(x for x, b in zip(lines, bad) if not b) if any(bad) else text


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    repeat = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
    lost = sum(len(WORD.findall(x)) for x in text.split("\n") if WORD.search(x) and bad_line(x))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed,
            not failed and 2 * lost <= len(w))


def test_rules_match_brute_force(docs, corpus):
    same(quality_rules(docs), [(r[0], *rules(r[1])) for r in corpus], "doc_id", "n_words", "word_chars", "n_symbols",
         "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_line_rules_match_plain_ones(spark):
    rng = random.Random(16)
    bits = ["Home", "SIGN in", "read more", " | ", "»", " > ", " / ", "/", ">", "All Rights Reserved", "the cat sat", "l'été", "漢字",
            ".", "…", "؟", "copyright ©", "Copyright (C)", "licensed under the MIT", "\t", "•", "x", "12", "- "]
    texts = ["\n".join("".join(rng.choices(bits, k=rng.randint(0, 5))) for _ in range(40)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules(df, with_text=True).collect():
        assert r["clean_text"] == cleaned(texts[r["doc_id"]])


def test_lines_are_removed_from_the_text(spark):
    text = "Home\nThis is a line of words. It stays here as it is, all of it.\nCopyright (c) someone\nthe | a | b\n\nEnd."
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = quality_rules(df, with_text=True).first()
    assert row["kept"] and row["clean_text"] == "This is a line of words. It stays here as it is, all of it.\n\nEnd."
    assert (row["n_lines"], row["n_navigation"], row["n_boilerplate"], row["n_bad_punctuation"]) == (5, 2, 1, 0)


def test_empty(no_docs):
    assert quality_rules(no_docs).count() == 0
    assert mix_sources(no_docs).count() == 0


def water_fill(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, total = {}, sum(sizes.values())
    open_ = [s for s in names]
    while True:
        level = (total - sum(out.values())) / (sum(w[s] for s in open_) or 1)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            open_.remove(s)


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 50, None: 10, "é": 900, "z": 1}, {"a": 1}, {"a": 0, "b": 5}, {"a": 0}, {"x": 3, "y": 3, "z": 1000},
    {f"s{i}": (i * 37) % 101 + 1 for i in range(30)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = water_fill(sizes)
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def check_mix(rows):
    size = {}
    by_source, taken = Counter(), Counter()
    for r in rows:
        assert r["taken"] in [k * r["size"] for k in range(4)]
        by_source[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] = max(size.get(r["source"], 0), r["size"])
    want = water_fill(dict(by_source))
    for r in rows:
        assert r["source_size"] == by_source[r["source"]]
    for s in want:
        assert abs(taken[s] - want[s]) <= size[s] / 2 + 1e-6, (s, taken[s], want[s])


def test_mix_meets_its_targets(docs, corpus):
    rows = mix_sources(docs).collect()
    same(mix_sources(docs), [(r[0], len(WORD.findall(r[1] or "")), r[2]) for r in corpus], "doc_id", "size", "source")
    assert len(rows) == len(corpus) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    again = sorted(map(tuple, mix_sources(docs).collect()), key=repr)
    assert again == sorted(map(tuple, rows), key=repr)


def test_mix_is_near_its_targets(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "repeat('w ', int(1 + (id * 7919) % 50)) as text",
        "case when id % 3 = 0 then 'big' when id % 50 = 1 then null else concat('s', id % 4) end as source")
    check_mix(mix_sources(docs).collect())


def test_mix_of_one_repeated_row(spark):
    rows = [(1, "a b c", "x")] * 900 + [(2, "a b c d", "y")] * 100 + [(3, "a", "z")] * 50
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 4 for s in target)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", "a\n\n b\x0b", " ", "\t\t"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(word_count(df["text"])).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]


def test_reruns_take_the_same_number_of_equal_rows(spark, tmp_path):
    """A third of all rows are one row, which holds the threshold; the number
    taken does not depend on how the table is split."""
    rows = [(7, "a b c d", "hot")] * 50 + [(7, "other text of seven words in all", "hot")] * 10
    rows += [(100 + i, "w " * (1 + i % 9), ("hot", "cold", None)[i % 3]) for i in range(90)]
    seen = set()
    for parts in (1, 3, 7):
        path = str(tmp_path / f"t{parts}")
        spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts).write.parquet(path)
        got = mix_sources(spark.read.parquet(path)).collect()
        assert len(got) == len(rows)
        seen.add(tuple(sorted(((r["doc_id"], r["size"], r["source"] or "", r["copies"]) for r in got))))
        for source in ("hot", "cold", None):
            own = [r for r in got if r["source"] == source]
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    assert len(seen) == 1
