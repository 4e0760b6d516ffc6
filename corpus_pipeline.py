"""Corpus pipeline: ``documents`` to a token file, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reefcensus.llm.decontaminate import drop_contaminated
from reefcensus.llm.mixing import take_mix
from reefcensus.llm.ngram_join import keep_one
from reefcensus.llm.quality import clean_documents
from reefcensus.llm.queries import tokenizer_path
from reefcensus.llm.store import materialize
from reefcensus.llm.token_files import token_file_index

#: SQL cannot express the stages after the first; tests/llm/test_pipeline.py
#: holds a brute-force version
ORACLE_SQL = None
#: the near-duplicate stage; op3 has values of its own
STAGE_SHINGLE = 5
STAGE_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return clean_documents(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the n-gram Jaccard join, on five-word
    shingles from a Jaccard of 0.8 on."""
    return keep_one(docs, size=STAGE_SHINGLE, percent=STAGE_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file, and what reading it back gives."""
    return token_file_index(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
