"""Language-model scores by a subword lattice.

A unigram model over the pieces of an existing vocabulary gives every text
the sum of the probabilities of all its segmentations (a forward recursion in
log space). The vocabulary's own scores weight the pieces at first; one round
of expected counts over the training words then fits them to the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kernel import Words, chunks, mix, prefix_hashes, range_hashes, ranges, text_buffer
from .store import materialize, with_row_id

BOUNDARY = "▁".encode()
#: words with the highest counts that go to every task: 16 bytes each
HOT_WORDS = 1 << 20
HELD_OUT_MOD, HELD_OUT = 7, 2
#: bytes of text whose words are counted or scored at once
CHUNK_BYTES = 4 << 20
#: share of a piece's weight that stays with the vocabulary's own scores
PRIOR_SHARE = 0.01
BATCH_BYTES = 1 << 18
#: words that a task remembers with their values, 16 bytes each; then it starts anew
KNOWN_WORDS = 1 << 20


class Pieces:
    """The vocabulary's pieces as hashes, with a log probability each.

    ``pieces``: byte strings, sorted by hash; ``bytes_at``: index of the
    fallback piece of each byte value; ``end``: index of the end piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, strings = [], []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i)):
                text = piece.encode()
                if BOUNDARY not in text[1:]:
                    strings.append(text)
                    scores.append(sp.get_score(i))
        scores = np.array(scores)
        # log probabilities as they are; merge ranks (0, -1, -2, ...) by Zipf's law
        weight = 1 / (2 - scores) if scores.min() < -100 else np.exp(scores)
        data, offsets = text_buffer(pa.array(strings, pa.large_binary()))
        hashes = mix(range_hashes(prefix_hashes(data), offsets[:-1], offsets[1:]))
        order = np.argsort(hashes)
        self.hashes, self.size = hashes[order], np.diff(offsets)[order]
        self.longest = int(self.size.max())
        floor = weight.min()
        self.prior = np.concatenate((weight[order], np.full(257, floor)))
        self.prior /= self.prior.sum()
        self.bytes_at = len(strings)
        self.end = len(strings) + 256
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Piece index of each hash of ``size`` bytes, -1 for none."""
        out = np.full(len(hashes), -1, np.int64)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        hit = (self.hashes[k] == hashes[at]) & (self.size[k] == size)
        out[at[hit]] = k[hit]
        return out


class Lattice:
    """All segmentations of a batch of words (byte strings, one buffer)."""

    def __init__(self, pieces: Pieces, data: np.ndarray, offsets: np.ndarray):
        self.pieces, self.offsets = pieces, offsets
        self.length = np.diff(offsets)
        n, prefix = len(data), prefix_hashes(data)
        end = np.repeat(offsets[1:], self.length)
        at = np.arange(n)
        #: piece index by length and place of its first byte, -1 for none
        self.piece = np.full((min(pieces.longest, int(self.length.max(initial=0))), n), -1, np.int64)
        for size in range(1, len(self.piece) + 1):
            fits = at[at + size <= end]
            self.piece[size - 1, fits] = pieces.find(mix(range_hashes(prefix, fits, fits + size)), size)
        single = self.piece[0] if len(self.piece) else at
        if len(self.piece):
            self.piece[0] = np.where(single < 0, pieces.bytes_at + data.astype(np.int64), single)

    def _run(self, logp: np.ndarray, backward: bool) -> np.ndarray:
        """Log sums over all segmentations before (or after) every place;
        places of word w start at offsets[w] + w."""
        weight = np.where(self.piece < 0, -np.inf, logp[self.piece])
        order = np.argsort(-self.length, kind="stable")
        length = self.length[order]
        first = (self.offsets[:-1] + np.arange(len(self.length)))[order]
        byte0 = self.offsets[:-1][order]
        out = np.full(int(self.offsets[-1]) + len(self.length), -np.inf)
        out[first + length if backward else first] = 0.0
        active = np.searchsorted(-length, -np.arange(1, int(length.max(initial=0)) + 1), "right")
        for step, n in enumerate(active, 1):
            sizes = np.arange(1, min(step, len(self.piece)) + 1)[:, None]
            if backward:  # place step bytes before the word's end
                here, piece_at = first[:n] + length[:n] - step, byte0[:n] + length[:n] - step
                terms = weight[sizes - 1, piece_at] + out[here + sizes]
            else:
                here = first[:n] + step
                terms = weight[sizes - 1, byte0[:n] + step - sizes] + out[here - sizes]
            top = terms.max(axis=0)
            top = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                out[here] = top + np.log(np.exp(terms - top).sum(axis=0))
        return out

    def log_probability(self, logp: np.ndarray) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        return self._run(logp, False)[self.offsets[1:] + np.arange(len(self.length))]

    def expected_counts(self, logp: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected uses of every piece when each word occurs so many times."""
        forward, backward = self._run(logp, False), self._run(logp, True)
        total = forward[self.offsets[1:] + np.arange(len(self.length))]
        size, at = np.nonzero(self.piece >= 0)
        word = np.repeat(np.arange(len(self.length)), self.length)[at]
        place = at + word
        index = self.piece[size, at]
        share = np.exp(forward[place] + logp[index] + backward[place + size + 1] - total[word])
        return np.bincount(index, share * times[word], minlength=len(logp))


def _lattices(pieces: Pieces, data: np.ndarray, offsets: np.ndarray):
    """Lattices of batches of words, each with the word boundary in front."""
    mark = np.frombuffer(BOUNDARY, np.uint8)
    for lo, hi in chunks(offsets, BATCH_BYTES):
        part, offs = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        marked = np.insert(part, np.repeat(offs[:-1], len(mark)), np.tile(mark, hi - lo))
        yield lo, hi, Lattice(pieces, marked, offs + len(mark) * np.arange(hi - lo + 1))


def _distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Words of some texts: all, the distinct hashes, which one each word is,
    and the bytes of the distinct words."""
    words = Words(data, offsets)
    hashes, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    size = words.end[first] - words.start[first]
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(ends[-1]) + np.repeat(words.start[first] - ends[:-1], size)
    raw = data[at]
    return words, hashes, which, raw + np.uint8(32) * ((raw >= 65) & (raw <= 90)), ends


def _count(batches):
    for batch in batches:
        data, offsets = text_buffer(batch.column(0))
        for lo, hi in chunks(offsets, CHUNK_BYTES):
            _, hashes, which, raw, ends = _distinct_words(data[offsets[lo]: offsets[hi]],
                                                          offsets[lo: hi + 1] - offsets[lo])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(hashes), [
                None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), words, pa.array(np.bincount(which, minlength=len(hashes)))],
                names=["h", "word", "c"])


def _expect(batches, pieces: Pieces, logp: np.ndarray):
    total = np.zeros(len(logp))
    for batch in batches:
        data, offsets = text_buffer(batch.column(0))
        times = batch.column(1).to_numpy().astype(float)
        for lo, hi, lattice in _lattices(pieces, data, offsets):
            total += lattice.expected_counts(logp, times[lo:hi])
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "n"])


SCORE_SCHEMA = ("rid long, doc_id long, held_out boolean, n_tokens long, known long, logs double, log_p double, "
                "rare array<long>, rare_n array<long>")


class _Values:
    """Log probabilities of the words that a task has met, by hash."""

    def __init__(self, pieces: Pieces, logp: np.ndarray):
        self.pieces, self.logp = pieces, logp
        self.known, self.value = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, hashes: np.ndarray, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Values of distinct words; only new ones get a lattice."""
        if len(self.known) > KNOWN_WORDS:
            self.known, self.value = np.zeros(0, np.uint64), np.zeros(0)
        at = np.searchsorted(self.known, hashes)
        seen = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        seen[inside] = self.known[at[inside]] == hashes[inside]
        new = np.flatnonzero(~seen)
        size = np.diff(ends)[new]
        own, value = raw[ranges(ends[:-1][new], size)], np.zeros(len(new))
        for a, b, lattice in _lattices(self.pieces, own, np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))):
            value[a:b] = lattice.log_probability(self.logp)
        self.known = np.insert(self.known, at[new], hashes[new])
        self.value = np.insert(self.value, at[new], value)
        return self.value[np.searchsorted(self.known, hashes)]


def _score(batches, pieces, logp, hot, hot_count):
    values = _Values(pieces, logp)
    for batch in batches:
        data, offsets = text_buffer(batch.column(3))
        for lo, hi in chunks(offsets, CHUNK_BYTES):
            n = hi - lo
            words, hashes, which, raw, ends = _distinct_words(data[offsets[lo]: offsets[hi]],
                                                              offsets[lo: hi + 1] - offsets[lo])
            doc = np.repeat(np.arange(n), np.diff(words.first))
            value = values.of(hashes, raw, ends)
            k = np.minimum(np.searchsorted(hot, hashes), max(0, len(hot) - 1))
            count = np.where(hot[k] == hashes, hot_count[k], 0) if len(hot) else np.zeros(len(hashes), np.int64)
            here = count[which]
            log_p = np.bincount(doc, value[which], minlength=n) + logp[pieces.end]
            rare, rare_n = [], []
            lonely = np.flatnonzero(here == 0)
            cuts = np.searchsorted(lonely, words.first)
            for d in range(n):
                h, c = np.unique(words.hashes[lonely[cuts[d]: cuts[d + 1]]], return_counts=True)
                rare.append(h.view(np.int64))
                rare_n.append(c)
            ends_ = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rare]))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), batch.column(2).slice(lo, n),
                 pa.array(np.diff(words.first).astype(np.int64) + 1),
                 pa.array(np.bincount(doc, here > 0, minlength=n).astype(np.int64)),
                 pa.array(np.bincount(doc, np.log10(here + 1), minlength=n)), pa.array(log_p / np.log(10)),
                 pa.ListArray.from_arrays(ends_, pa.array(np.concatenate(rare).astype(np.int64))),
                 pa.ListArray.from_arrays(ends_, pa.array(np.concatenate(rare_n).astype(np.int64)))],
                names=["rid", "doc_id", "held_out", "n_tokens", "known", "logs", "log_p", "rare", "rare_n"])


def fit_pieces(words: DataFrame, n_ends: int, pieces: Pieces) -> np.ndarray:
    """Natural log probabilities of the pieces from ``(word, c)``: one round
    of expected counts from the vocabulary's own weights, mixed with a small
    share of those, so that every text has a probability. The counts are
    summed by piece in Spark; at most one row per piece comes back."""
    sent = words.sparkSession.sparkContext.broadcast(pieces)
    prior = np.log(pieces.prior)
    found = words.select("word", "c").mapInArrow(lambda it: _expect(it, sent.value, prior), "piece int, n double") \
        .groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(prior))
    order = np.argsort(found.column("piece").to_numpy())
    counts[found.column("piece").to_numpy()[order]] = found.column("n").to_numpy()[order]
    counts[pieces.end] = n_ends
    total = counts.sum()
    return np.log((1 - PRIOR_SHARE) * counts / total + PRIOR_SHARE * pieces.prior) if total else prior


def lattice_scores(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)``, one row per input row.

    ``path``: a sentencepiece model whose pieces are used. Rows whose
    crc32(id as text) mod 7 is 2 are held out; a null id is not. Words lie
    between white space, A-Z lowered; each document ends with one end token.
    ``score`` is the model's log10 probability of the words in their order
    and the end; bytes outside every piece use fallback pieces. A null text
    is empty: only the end token. Word counts of the training rows are summed
    in Spark. The ``HOT_WORDS`` most frequent ones (fewer at a tie) go to all
    tasks, at most 16 MiB; documents join the other counts by hash, so all
    words count at any size of the corpus.
    """
    spark = docs.sparkSession
    crc = F.pmod(F.crc32(docs[id_col].cast("string")), F.lit(HELD_OUT_MOD))
    rows = with_row_id(docs, docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(crc == HELD_OUT, F.lit(False)).alias("held_out"), docs[text_col].alias("text"))
    train = rows.filter(~F.col("held_out"))
    words = materialize(train.select("text").mapInArrow(_count, "h long, word binary, c long")
                        .groupBy("h").agg(F.min("word").alias("word"), F.sum("c").alias("c")), "words")
    n_docs = train.count()
    tokens, vocabulary = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, vocabulary = tokens + n_docs, vocabulary + (n_docs > 0)
    pieces = Pieces(path)
    logp = fit_pieces(words, n_docs, pieces)
    # the smallest count whose words still fit
    by_count = words.groupBy("c").agg(F.count("*").alias("n")) \
        .withColumn("above", F.sum("n").over(W.orderBy(F.col("c").desc())))
    least = by_count.filter(F.col("above") <= HOT_WORDS).agg(F.min("c")).first()[0]
    hot = words.filter(F.col("c") >= (least if least is not None else 1 << 62)).select("h", "c")
    table = hot.toArrow()
    h = table.column("h").to_numpy().view(np.uint64)
    order = np.argsort(h)
    sent = spark.sparkContext.broadcast((pieces, logp, h[order], table.column("c").to_numpy()[order]))
    scored = materialize(rows.mapInArrow(lambda it: _score(it, *sent.value), SCORE_SCHEMA), "scored")
    rare = scored.select("rid", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")) \
        .select("rid", F.col("w.rare").alias("h"), F.col("w.rare_n").alias("times"))
    cold = words.filter(F.col("c") < (least if least is not None else 1 << 62)).select("h", "c")
    found = rare.join(cold, "h").groupBy("rid").agg(
        F.sum("times").alias("cold_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("cold_logs"))
    out = scored.drop("rare", "rare_n").join(found, "rid", "left")
    known = F.col("known") + F.coalesce("cold_known", F.lit(0))
    end = F.lit(float(np.log10(n_docs + 1)))
    base = F.col("logs") + F.coalesce("cold_logs", F.lit(0.0)) + end \
        - F.col("n_tokens") * F.lit(float(np.log10(tokens + vocabulary + 1)))
    return out.select("doc_id", "held_out", "n_tokens", (known + F.lit(int(n_docs > 0))).alias("n_known"),
                      F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
                      F.col("log_p").alias("score"))
