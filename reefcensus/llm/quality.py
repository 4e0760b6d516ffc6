"""Quality rules, line first: every line is judged on its own, failing lines
are removed, and a document that loses too much of its text is rejected."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernel import Words, chunks, mix, text_buffer

#: a line of words without any sentence mark reads as a list, menu or heading
SENTENCE_MARK = re.compile(r"[.!?…。！？।؟:;]")
#: separators of menus and breadcrumbs; this many in a line make it navigation
NAVIGATION_MARK = re.compile(r"[|»›•·]|[ \t][>/][ \t]")
NAVIGATION_MARKS = 2
NAVIGATION_LINE = re.compile(
    r"^[\x00-\x40\x5b-\x60\x7b-\x7f]*(?:home|menu|login|log in|sign in|sign up|register|next|previous|back to top|skip to content|"
    r"read more|click here|share this|search)[\x00-\x40\x5b-\x60\x7b-\x7f]*$", re.I)
BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|use of cookies|"
    r"enable javascript|lorem ipsum|powered by|subscribe to our newsletter|copyright (?:\(c\)|©)|"
    r"licensed under the", re.I)
SYMBOLS = "#*$%&|<>"
#: a document is rejected if more than this share of its words goes
MAX_LOST_PERCENT = 50

RULE_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
               "n_lines long, n_bad_punctuation long, n_navigation long, n_boilerplate long, n_words_kept long, "
               "base_failed boolean, kept boolean, clean_text string")

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = 1
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def line_fault(line: str) -> int:
    """0 keeps the line; 1 punctuation, 2 navigation, 3 boilerplate."""
    if BOILERPLATE.search(line):
        return 3
    if NAVIGATION_LINE.match(line) or len(NAVIGATION_MARK.findall(line)) >= NAVIGATION_MARKS:
        return 2
    return 0 if SENTENCE_MARK.search(line) else 1


def clean_lines(text: str) -> tuple[str, int, int, list[int], int]:
    """Kept text, lines with a word, repeated lines, faults by kind, words removed."""
    lines = text.split("\n")
    kept, seen, faults = [], set(), [0, 0, 0, 0]
    n = dup = lost = 0
    for line in lines:
        if not line or not _WORD.search(line):
            kept.append(line)
            continue
        n += 1
        dup += line in seen
        seen.add(line)
        fault = line_fault(line)
        faults[fault] += 1
        if fault:
            lost += len(_WORD.findall(line))
        else:
            kept.append(line)
    return (text if not lost else "\n".join(kept)), n, dup, faults, lost


def _rules(batches, with_text: bool):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        data, offsets = text_buffer(texts)
        for lo, hi in chunks(offsets):
            offs = offsets[lo: hi + 1] - offsets[lo]
            raw = data[offsets[lo]: offsets[hi]]
            n = hi - lo
            words = Words(raw, offs, lower=False)
            n_words = np.diff(words.first)
            # code points of words: bytes that are no separator and no continuation
            points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            in_word = np.concatenate(([0], np.cumsum(points[words.end] - points[words.start])))
            word_chars = in_word[words.first[1:]] - in_word[words.first[:-1]]
            symbols = np.concatenate(([0], np.cumsum(_SYMBOL[raw])))
            n_symbols = symbols[offs[1:]] - symbols[offs[:-1]]
            n_repeat = _repeated_words(words, n)
            out = [clean_lines(t or "") for t in texts.slice(lo, n).to_pylist()]
            lost = np.array([o[4] for o in out], np.int64)
            failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
            kept = ~failed & (100 * lost <= MAX_LOST_PERCENT * n_words)
            yield pa.RecordBatch.from_arrays([
                ids.slice(lo, n).cast(pa.int64()), *[pa.array(x.astype(np.int64)) for x in (
                    n_words, word_chars, n_symbols, np.array([o[2] for o in out]), n_repeat,
                    np.array([o[1] for o in out]), *[np.array([o[3][k] for o in out]) for k in (1, 2, 3)],
                    n_words - lost)],
                pa.array(failed), pa.array(kept),
                pa.array([o[0] for o in out] if with_text else [None] * n, pa.string())],
                names=[f.split()[0] for f in RULE_SCHEMA.split(", ")])


def _repeated_words(words: Words, n_docs: int) -> np.ndarray:
    """Words inside 5-word windows that occur twice or more in their text."""
    window, whole = words.shingles(5)
    doc = np.repeat(np.arange(n_docs), np.diff(words.first))
    at = np.flatnonzero(whole)
    keyed = mix(window[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1)))
    _, where, count = np.unique(keyed, return_inverse=True, return_counts=True)
    hit = at[count[where] >= 2]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, np.minimum(hit + 5, len(doc)), -1)
    covered = np.cumsum(cover)[:-1] > 0
    return np.bincount(doc[covered], minlength=n_docs).astype(np.int64)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  with_text: bool = False) -> DataFrame:
    """One row per input row with its counts, the base verdict, the method's
    verdict and, if asked for, the text without the failing lines.

    Lines: boilerplate phrases, navigation (menu words alone in a line, or two
    or more menu separators) and lines without any sentence mark are removed.
    ``kept`` is false for fewer than 10 words, for more than 20 % of words in
    repeated 5-word windows, or if more than half of the words are removed.
    A null text counts as empty and is rejected; an empty table gives no rows.
    No shuffle; memory is bounded by the longest text.
    """
    return docs.select(docs[id_col].cast("long"), text_col).mapInArrow(
        lambda it: _rules(it, with_text), RULE_SCHEMA)


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are but
    the text, which loses its failing lines."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches):
        for batch in batches:
            judged = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)],
                                                names=["doc_id", "text"])
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches(_rules([judged], True))
            columns = list(batch.columns)
            columns[at] = table.column("clean_text").combine_chunks()
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            yield whole.filter(table.column("kept").combine_chunks())

    return docs.mapInArrow(run, docs.schema)
