"""Registered queries of the corpus operators, with DuckDB SQL where it can
express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .lattice import lattice_scores
from .lexical import LOWERED, TERM, TOP, UPPER, ranked_search
from .line_dedup import duplicate_lines
from .mixing import mix_sources
from .near_vectors import near_vectors
from .ngram_join import jaccard_components
from .quality import quality_rules
from .secret_scan import scan_secrets
from .suffix_dedup import suffix_dedup
from .token_counts import count_tokens
from .token_files import token_file_index
from .whitening import whiten


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup(_documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_token_counts(spark, sf_dir):
    return count_tokens(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_benchmark_decontamination(spark, sf_dir):
    found = decontaminate(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_items", "item_id", "coverage", "n_tiles", "contaminated")


def op5_line_dedup(spark, sf_dir):
    return duplicate_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op6_token_files(spark, sf_dir):
    return token_file_index(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op7_quality_rules(spark, sf_dir):
    return quality_rules(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_mixing(spark, sf_dir):
    return mix_sources(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_lattice_scores(spark, sf_dir):
    return lattice_scores(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op10_secret_scan(spark, sf_dir):
    return scan_secrets(_documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_embedding_whitening(spark, sf_dir):
    return whiten(_embeddings(spark, sf_dir)).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_embedding_near_dedup(spark, sf_dir):
    return near_vectors(_embeddings(spark, sf_dir)).select("vec_id", "n_links", "component_id", "kept")


def op13_ranked_search(spark, sf_dir):
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        "item_id", "rank", "doc_id", "score")


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_lattice_scores": op9_lattice_scores,
    "op10_secret_scan": op10_secret_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_ranked_search": op13_ranked_search,
}
_WORDS = r"'[^\x20\x09-\x0D]+'"


#: the line rules of op7, written out for DuckDB apart from the operator's own
_BOILERPLATE = ("'(?i)all rights reserved|terms of use|terms of service|privacy policy|cookie policy|use of cookies|"
                "enable javascript|lorem ipsum|powered by|subscribe to our newsletter|copyright [(]c[)]|copyright ©|"
                "licensed under the'")
_MENU = ("'(?i)^[^a-z\\x{80}-\\x{10FFFF}]*(home|menu|login|log in|sign in|sign up|register|next|previous|back to top|"
         "skip to content|read more|click here|share this|search)[^a-z\\x{80}-\\x{10FFFF}]*$'")


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_WORDS})) AS lines
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         coalesce(list_sum(list_transform(list_filter(lines, lambda x:
             regexp_matches(x, {_BOILERPLATE}) OR regexp_matches(x, {_MENU})
             OR len(regexp_extract_all(x, '[|»›•·]|[ \\t](>|/)[ \\t]')) >= 2
             OR NOT regexp_matches(x, '[.!?…。！？।؟:;]')),
           lambda x: len(regexp_extract_all(x, {_WORDS})))), 0) AS lost
  FROM d LEFT JOIN cov ON d.doc_id = cov.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost <= n_words AS kept
FROM base"""

OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, 3 * source_size AS cap FROM s),
w AS (SELECT *, ([5, 2, 1])[(rank - 1) % 3 + 1] AS weight FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, rank) AS place, sum(source_size) OVER () AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM o),
t AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT level FROM l WHERE level * weight <= cap
                                                       ORDER BY place LIMIT 1) * weight) AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
m AS (SELECT d.doc_id, d.size, b.source_size, b.target, whole, target - whole * b.source_size AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY h) - size AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * least(3, whole + CASE WHEN budget <= 0 OR before >= budget THEN 0 WHEN before + size <= budget THEN 1
                                     WHEN (budget - before) / size >= 0.5 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWERED}'), '{TERM}')"
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS terms FROM d),
i AS (SELECT row_number() OVER () AS item, item_id, list_distinct({_TERMS}) AS w FROM benchmark),
q AS (SELECT item, item_id, unnest(w) AS term FROM i),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf
       FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
       FROM tf, c GROUP BY term),
p AS (SELECT row, doc_id, term,
             w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS part
      FROM tf JOIN wt USING (term), c),
s AS (SELECT item, item_id, row, doc_id, sum(part)::BIGINT AS score FROM q JOIN p USING (term)
      GROUP BY item, item_id, row, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {TOP}"""

ORACLE = {"op7_quality_rules": OP7_SQL, "op8_mixing": OP8_SQL, "op13_ranked_search": OP13_SQL}
