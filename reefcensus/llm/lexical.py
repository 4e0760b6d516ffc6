"""Ranked lexical search over a length-stratified index.

Documents of one normaliser ``m`` form a stratum. A stratum is cut into
blocks; a block holds its postings by term and, within a term, by falling
``tf``. In a stratum a posting's impact depends on its term and ``tf`` alone,
so impacts are computed once per run of equal ``tf``, and the first run of
each term bounds what the term can add in the block. The bounds order the
visits: a block whose bound for an item lies below that item's threshold is
not opened.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kernel import LOWER, PUNCTUATION, Words, chunks, ranges, text_buffer
from .store import discard, materialize, with_row_id

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 50
#: documents in a block; a number below 2**16, as postings are 16 bits wide
BLOCK_DOCS = 4096
#: bytes of item texts whose terms go to every task at once; more are done in slices
SLICE_BYTES = 8 << 20
#: bytes of postings opened side by side in a task
OPEN_BYTES = 16 << 20
#: scores of a block computed side by side, and postings added up at once
SCORES_AT_ONCE, POSTINGS_AT_ONCE = 1 << 19, 1 << 19
#: sums below this are exact in doubles
EXACT = 1 << 53

VECTOR_SCHEMA = "doc_id long, n long, terms array<int>, tfs array<int>"
BLOCK_SCHEMA = ("m long, doc_ids array<long>, run_terms binary, run_tfs binary, run_sizes binary, postings binary")
FOUND_SCHEMA = "item int, doc_id long, score long"
RESULT_SCHEMA = "item_id long, rank int, doc_id long, score long"


class Vocabulary:
    """Terms by number, looked up by the hash of their bytes and then compared
    byte by byte."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.size = len(raw)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        offsets = np.concatenate((np.zeros(1, np.int64), ends))
        # every term is one word of its own text
        words = Words(self.data, offsets, PUNCTUATION)
        order = np.argsort(words.hashes, kind="stable")
        self.hashes, self.number = words.hashes[order], order.astype(np.int64)
        self.start, self.length = offsets[:-1][order], np.diff(offsets)[order]
        same = np.unique(self.hashes, return_counts=True)[1]
        self.most = int(same.max()) if len(same) else 0

    def numbers(self, words: Words, data: np.ndarray) -> np.ndarray:
        """The number of each word's term, -1 for other words."""
        out = np.full(len(words.hashes), -1, np.int64)
        if not self.size:
            return out
        first = np.searchsorted(self.hashes, words.hashes)
        for k in range(self.most):  # terms of one hash are tried one after another
            at = np.minimum(first + k, self.size - 1)
            length = words.end - words.start
            maybe = np.flatnonzero((out < 0) & (self.hashes[at] == words.hashes) & (self.length[at] == length))
            at = at[maybe]
            mine = LOWER[data[ranges(words.start[maybe], length[maybe])]]
            wrong = mine != self.data[ranges(self.start[at], length[maybe])]
            if len(maybe):
                begins = np.cumsum(length[maybe]) - length[maybe]
                equal = ~np.logical_or.reduceat(wrong, begins)
                out[maybe[equal]] = self.number[at[equal]]
        return out


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))


def _vectors(batches, vocabulary: Vocabulary):
    """Number of terms, and tf of each vocabulary term, per document."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for lo, hi in chunks(offsets):
            raw = data[offsets[lo]: offsets[hi]]
            words = Words(raw, offsets[lo: hi + 1] - offsets[lo], PUNCTUATION)
            number, n_docs = vocabulary.numbers(words, raw), hi - lo
            doc = np.repeat(np.arange(n_docs), np.diff(words.first))
            known = number >= 0
            width = max(1, vocabulary.size)
            pair, tf = np.unique(doc[known] * width + number[known], return_counts=True)
            held = np.bincount(pair // width, minlength=n_docs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n_docs), pa.array(np.diff(words.first).astype(np.int64)),
                 _lists(pair % width, held), _lists(tf, held)], names=["doc_id", "n", "terms", "tfs"])


def _frequencies(batches, size: int):
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
    term = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(total[term])], names=["term", "df"])


def _block(m: int, ids: list[pa.Array], terms: np.ndarray, tfs: np.ndarray, docs: np.ndarray) -> dict:
    order = np.lexsort((docs, -tfs, terms))
    terms, tfs = terms[order], tfs[order]
    new = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])))) \
        if len(terms) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate((new, [len(terms)])))
    return {"m": m, "doc_ids": pa.chunked_array(ids).to_pylist(), "run_terms": terms[new].astype("<i4").tobytes(),
            "run_tfs": tfs[new].astype("<i4").tobytes(), "run_sizes": sizes.astype("<i4").tobytes(),
            "postings": docs[order].astype("<u2").tobytes()}


_ARROW_BLOCK = pa.schema([("m", pa.int64()), ("doc_ids", pa.list_(pa.int64())), *[
    (c, pa.binary()) for c in ("run_terms", "run_tfs", "run_sizes", "postings")]])


def _blocks(batches, block_docs: int):
    """Blocks of the documents of a task, which come sorted by ``m``."""
    held, size, last = [], 0, None

    def flush():
        ids, terms, tfs, docs, at = [], [], [], [], 0
        for batch in held:
            ids.append(batch.column(0))
            n = len(batch.column(2).value_lengths())
            terms.append(batch.column(2).flatten().to_numpy())
            tfs.append(batch.column(3).flatten().to_numpy())
            docs.append(np.repeat(np.arange(at, at + n), batch.column(2).value_lengths().to_numpy()))
            at += n
        row = _block(last, ids, np.concatenate(terms), np.concatenate(tfs), np.concatenate(docs))
        return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)

    for batch in batches:
        m = batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero(m[1:] != m[:-1]) + 1).tolist(), len(m)]
        for lo, hi in zip(cuts, cuts[1:]):
            while lo < hi:
                if held and (m[lo] != last or size >= block_docs):
                    yield flush()
                    held, size = [], 0
                to = min(hi, lo + block_docs - size)
                held.append(batch.slice(lo, to - lo))
                size, last, lo = size + to - lo, int(m[lo]), to
    if held:
        yield flush()


@dataclass
class LexicalIndex:
    """Blocks, and the statistics of the whole corpus: ``n_docs`` documents
    with a term, ``n_terms`` terms with repeats, weight of each vocabulary
    term."""

    blocks: DataFrame
    terms: list[str]
    weights: np.ndarray
    n_docs: int
    n_terms: int


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def build_index(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """Index of all documents for the (distinct, lowered) ``terms``.

    The texts are read once; their term vectors are written, counted, and
    dealt out by ``m``. Ranges of ``m`` and row go to the tasks, so a stratum
    of any size is split.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(terms)
    vectors = materialize(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        lambda it: _vectors(it, Vocabulary(sent.value)), VECTOR_SCHEMA), "vectors", "zstd")
    n_docs, n_terms = vectors.filter("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = len(terms)
    weights = np.zeros(size, np.int64)
    counted = vectors.select("terms").mapInArrow(lambda it: _frequencies(it, size), "term int, df long") \
        .groupBy("term").agg(F.sum("df").alias("df"))
    for term, df in counted.collect():  # a row a term of the vocabulary at most
        weights[term] = term_weight(n_docs, df)
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L")
    # the row number tells equal rows apart while this job deals them out
    dealt = with_row_id(vectors.filter("size(terms) > 0"), "doc_id", m.alias("m"), "terms", "tfs") \
        .repartitionByRange("m", "rid").sortWithinPartitions("m", "rid").select("doc_id", "m", "terms", "tfs")
    blocks = materialize(dealt.mapInArrow(lambda it: _blocks(it, BLOCK_DOCS), BLOCK_SCHEMA), "blocks", "zstd")
    discard(vectors)
    return LexicalIndex(blocks, terms, weights, n_docs, n_terms)


def _runs(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers start and end."""
    cut = np.flatnonzero(group[1:] != group[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(group)]))


class _Queries:
    """Term numbers of the items, one after another; every item has some."""

    def __init__(self, lists: list[list[int]], names: list[int], weights: np.ndarray):
        self.terms = np.array([t for x in lists for t in x], np.int64)
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.names, self.weights = np.array(names, np.int32), weights


class _Open:
    """One block, ready to be scored."""

    def __init__(self, row: dict, queries: _Queries):
        self.queries, self.ids, self.postings = queries, row["doc_ids"].values, row["postings"]
        self.n_docs = len(self.ids)
        terms, tfs, self.sizes = (np.frombuffer(row[c].as_buffer(), "<i4").astype(np.int64)
                                  for c in ("run_terms", "run_tfs", "run_sizes"))
        tf, kind = np.unique(tfs, return_inverse=True)
        per_tf = (1_000_000_000 * tf) // (1000 * tf + 20 * row["m"].as_py())
        self.impact = queries.weights[terms] * per_tf[kind]
        first = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1])))
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.sizes)))
        self.terms, self.best = terms[first], self.impact[first]
        self.start, self.end = ends[first], ends[np.concatenate((first[1:], [len(terms)]))]

    def bounds(self) -> np.ndarray:
        """The most that a document of the block can score, per item."""
        best = np.zeros(len(self.queries.weights), np.int64)
        best[self.terms] = self.best
        return np.add.reduceat(best[self.queries.terms], self.queries.first)

    def scores(self, items: np.ndarray, bound: int) -> np.ndarray:
        """Scores of all documents, a row an item."""
        q = self.queries
        place = np.full(len(q.weights), -1, np.int64)
        place[self.terms] = np.arange(len(self.terms))
        at = place[q.terms[ranges(q.first[items], q.sizes[items])]]
        row = np.repeat(np.arange(len(items)), q.sizes[items])[at >= 0]
        at = at[at >= 0]
        size = self.end[at] - self.start[at]
        docs = np.frombuffer(self.postings.as_buffer(), "<u2")
        impacts = np.repeat(self.impact, self.sizes)
        cells = len(items) * self.n_docs
        out = np.zeros(cells, np.float64 if bound < EXACT else np.int64)
        piece = (np.cumsum(size) - size) // POSTINGS_AT_ONCE
        for lo, hi in zip(*_runs(piece)):
            posting = ranges(self.start[at[lo:hi]], size[lo:hi])
            cell = np.repeat(row[lo:hi] * self.n_docs, size[lo:hi]) + docs[posting]
            if bound < EXACT:
                out += np.bincount(cell, impacts[posting], cells)
            else:
                np.add.at(out, cell, impacts[posting])
        return out.astype(np.int64).reshape(len(items), self.n_docs)


class _Best:
    """The ``top`` best documents of each item so far: highest score, then
    smallest id, nulls last. ``least`` is what a score must reach."""

    def __init__(self, top: int, least: np.ndarray):
        self.top, self.least = top, least.copy()
        self.held, self.size = [], 0

    def add(self, items: np.ndarray, scores: np.ndarray, ids: pa.Array) -> None:
        floor = self.least[items]
        if scores.shape[1] > self.top:
            floor = np.maximum(floor, np.partition(scores, -self.top, axis=1)[:, -self.top])
        row, doc = np.nonzero(scores >= floor[:, None])
        if len(row):
            none = ids.is_null().to_numpy(zero_copy_only=False)[doc]
            self.held.append((items[row], scores[row, doc], none, ids.fill_null(0).to_numpy()[doc]))
            self.size += len(row)
        if self.size > 8 * self.top * len(self.least):
            self.cut()

    def cut(self) -> None:
        if not self.held:
            return
        item, score, none, ids = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, none, -score, item))
        first = np.searchsorted(item[order], np.arange(len(self.least)))
        place = np.arange(len(order)) - first[item[order]]
        last = order[place == self.top - 1]
        self.least[item[last]] = np.maximum(self.least[item[last]], score[last])
        order = order[place < self.top]
        self.held, self.size = [(item[order], score[order], none[order], ids[order])], len(order)


def _visit(batches, queries: _Queries, top: int, least: np.ndarray, probe: bool):
    """The best documents of a task's blocks, per item. Blocks are visited by
    falling bound, each for the items that it can still serve. A ``probe``
    opens, of each group of blocks, only an item's most promising ones until
    they hold ``top`` documents."""
    best = _Best(top, least)
    for group in _groups(batches):
        blocks = [_Open(row, queries) for row in group]
        bounds = np.stack([b.bounds() for b in blocks])
        open_ = np.ones(bounds.shape, bool)
        if probe:
            order = np.argsort(-bounds, axis=0, kind="stable")
            held = np.array([b.n_docs for b in blocks])[order]
            np.put_along_axis(open_, order, np.cumsum(held, axis=0) - held < top, axis=0)
        for k in np.argsort(-bounds.max(axis=1), kind="stable"):
            items = np.flatnonzero(open_[k] & (bounds[k] >= best.least))
            step = max(1, SCORES_AT_ONCE // blocks[k].n_docs)
            for lo in range(0, len(items), step):
                some = items[lo: lo + step]
                best.add(some, blocks[k].scores(some, int(bounds[k, some].max())), blocks[k].ids)
    best.cut()
    for item, score, none, ids in best.held:
        yield pa.RecordBatch.from_arrays([pa.array(queries.names[item]), pa.array(ids, mask=none), pa.array(score)],
                                         names=["item", "doc_id", "score"])


def _groups(batches):
    held, size = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            held.append({c: batch.column(i)[k] for i, c in enumerate(batch.schema.names)})
            size += len(held[-1]["postings"].as_buffer())
            if size >= OPEN_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def search(index: LexicalIndex, items: list[list[str]], top: int = TOP) -> DataFrame:
    """``(item, rank, doc_id, score)``: the ``top`` best documents of each
    list of distinct terms, which the index must hold; ``item`` is the place
    in the list.

    A first pass opens each task's most promising blocks; the ``top``-th best
    score that it finds is a threshold for the second pass, which leaves out
    every block whose bound is lower.
    """
    number = {t: k for k, t in enumerate(index.terms)}
    asked = [k for k, terms in enumerate(items) if terms]  # an item without terms finds nothing
    if not asked:
        return index.blocks.sparkSession.createDataFrame([], "item int, rank int, doc_id long, score long")
    lists = [[number[t] for t in items[k]] for k in asked]
    sent = index.blocks.sparkSession.sparkContext.broadcast((lists, asked, index.weights))

    def run(least, probe):
        return index.blocks.mapInArrow(
            lambda batches: _visit(batches, _Queries(*sent.value), top, np.array(least, np.int64), probe), FOUND_SCHEMA)

    def ranked(found):
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    first = ranked(run([1] * len(lists), True)).filter(F.col("rank") == top).select("item", "score").collect()
    reached = {r["item"]: r["score"] for r in first}
    return ranked(run([reached.get(k, 1) for k in asked], False)).select("item", "rank", "doc_id", "score")


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, terms)``: each row's distinct terms, sorted."""
    found = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWERED), F.lit(TERM), 0)
    return items.select(items[item_col].cast("long").alias("item_id"),
                        F.array_sort(F.array_distinct(F.coalesce(found, F.array().cast("array<string>")))).alias("terms"))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of highest
    score above 0 for every row of ``items``, equal scores by ascending
    ``doc_id`` (nulls last).

    Every row of either table stands for itself, repeated ids and null ids
    too. Null and empty texts have no terms: such a document adds to no
    count, such an item has no row. The items are the query set; their terms
    go to the tasks in slices of bounded bytes, one index a slice.
    """
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_col, item_text).filter("size(terms) > 0"), "items")
    total = asked.agg(F.coalesce(F.sum(F.octet_length(F.array_join("terms", " ")) + 64), F.lit(0))).first()[0]
    slices = max(1, -(-2 * total // SLICE_BYTES))
    out = None
    for k in range(slices if total else 0):
        own = asked if slices == 1 else asked.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(slices)) == k)
        rows = [(r["item_id"], r["terms"]) for r in own.collect()]
        index = build_index(docs, sorted(set().union(*[r[1] for r in rows])), id_col, text_col)
        found = search(index, [r[1] for r in rows], top)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "item int, item_id long")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        if slices > 1:
            kept = materialize(found, f"found{k}")
            discard(index.blocks)
            found = kept
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], RESULT_SCHEMA)
