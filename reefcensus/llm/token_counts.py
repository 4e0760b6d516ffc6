"""Token counts by a whole-token shortcut.

Offline, the vocabulary strings that encode alone as exactly one token are
proven with the library. Pre-tokens that are such strings count 1 each; only
the rest are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernel import chunks, text_buffer
from .pretokens import BYTE_LEVEL, OTHER, load_tokenizer, safe_pieces, vocabulary_strings

COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
MAX_TOKENS = 1024
#: merged pre-tokens remembered per worker; beyond that they are merged again
CACHE_SIZE = 400_000


def single_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token.

    A pre-token is matched the same way alone as in a text (its alternatives
    look at nothing before it, and white space runs at nothing but
    non-blanks after it), so the proof holds wherever it occurs.
    """
    tok = load_tokenizer(path)
    strings = [s for s in vocabulary_strings(tok)
               if not OTHER.search(s) and (m := BYTE_LEVEL.match(s)) and m.end() == len(s)]
    encoded = tok.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1)


class _Counter:
    """Token counts of texts with one tokenizer, kept per Python worker."""

    _of: dict[str, _Counter] = {}

    def __init__(self, path: str, proven: frozenset[str]):
        self.tokenizer = load_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.proven = dict.fromkeys(proven, 1)
        self.merged: dict[str, int] = {}

    @classmethod
    def get(cls, path, proven):
        if path not in cls._of:
            cls._of[path] = cls(path, proven)
        return cls._of[path]

    def count(self, texts: list[str]) -> list[int]:
        out, merged, proven = [0] * len(texts), self.merged, self.proven
        split = {}
        for i, text in enumerate(texts):
            if OTHER.search(text) or any(s in text for s in self.special):
                # foreign pieces are merged by the library like unproven pre-tokens
                pieces, split[i] = safe_pieces(text, self.special)
                for piece in pieces:
                    split[i] += BYTE_LEVEL.findall(piece)
            else:
                split[i] = BYTE_LEVEL.findall(text)
        rest = {t for tokens in split.values() for t in tokens if t not in proven and t not in merged}
        if len(merged) + len(rest) > CACHE_SIZE:
            merged.clear()
            rest = {t for tokens in split.values() for t in tokens if t not in proven}
        rest = list(rest)
        for t, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            merged[t] = len(e.ids)
        for i, tokens in split.items():
            n = 0
            for t in tokens:
                n += 1 if t in proven else merged[t]
            out[i] = n
        return out


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row.

    ``path``: a byte-level BPE file of the tokenizers library; counts equal
    the library's without added special tokens. Of a text with characters
    from U+0250 on, or with special strings, only the pieces between white
    space that hold them are encoded by the library. A null text has 0 bytes and 0 tokens; an empty table gives no rows. No
    shuffle: the proven strings (at most the vocabulary) go to every task.
    """
    proven = docs.sparkSession.sparkContext.broadcast(single_tokens(path))

    def run(batches):
        counter = _Counter.get(path, proven.value)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for lo, hi in chunks(offsets):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                n = np.array(counter.count(texts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets[lo: hi + 1])), pa.array(n),
                     pa.array(n > max_tokens)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_col].cast("long"), text_col).mapInArrow(run, COUNT_SCHEMA)

