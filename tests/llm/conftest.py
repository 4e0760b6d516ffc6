from __future__ import annotations

import random

import pytest

ODD_SCHEMA = ("doc_id long, text string, source string, lang string, rid long, h long, size long, shard int, "
              "word string, n int, line string, item_id long, label int")


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty and long texts, repeated rows and ids, ties and
    columns whose names operators use inside."""
    rng = random.Random(7)
    syllables = "an be co di er fo gu ha in jo la mi no or pa qu re si to un ve wo za".split()

    def words(n):
        return ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)]

    def prose(n):
        out, left = [], n
        while left > 0:
            k = min(left, rng.randint(4, 14))
            out.append(" ".join(words(k)).capitalize() + ".")
            left -= k
        return "\n".join(" ".join(out[i:i + 3]) for i in range(0, len(out), 3))

    base = prose(160)
    bits = base.split(" ")
    near = bits.copy()
    near[40] = "changed"
    far = bits.copy()
    for i in range(0, len(far), 9):
        far[i] = f"x{i}"
    passage = prose(70)
    texts = [base, base, " ".join(near), " ".join(far), prose(90) + "\n" + passage, passage + "\n" + prose(40),
             None, "", "   \n\t ", "one", "one two", "One TWO", "ab ab ab ab ab ab ab ab ab ab ab ab",
             "Größe façade ½ ² naïve — “quoted” İstanbul ΣΊΣΥΦΟΣ 漢字かな 😀 é",
             "a<|endoftext|>b <|startoftext|> don't WE'LL 12345 it's x\u0085y\x1c z   \n\n  end  ",
             "home | about | contact\nAll rights reserved.\n" + prose(12), " | ".join(words(60)),
             prose(20000), "z" * 5000, "password = abcdefgh12345", prose(50), prose(50)]
    rows = [(i, t, ["a", "b", None, "é"][i % 4]) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "b"), (3, texts[4], "b"), (None, base, "a"), (None, None, None)]
    rows += [(500, prose(30), "hot")] * 5
    rows += [(600 + i, prose(rng.randint(1, 120)), "hot") for i in range(40)]
    return [(*r, "en", 1, 2, 3, 4, "w", 5, "l", 6, 7) for r in rows]


@pytest.fixture
def docs(spark, corpus, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(corpus, ODD_SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def same(df, expected, *cols):
    """The named columns of ``df`` hold the expected rows in any order."""
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == sorted(expected, key=repr)
