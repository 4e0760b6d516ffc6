"""Benchmark decontamination by greedy string tiling.

Documents and test items that share a five-word seed are compared: the
longest common run of words not yet marked is found with Karp-Rabin hashes,
marked in both, and again, until no run of five words is left. A document
whose tiles cover enough of an item holds it, in whatever order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import BASE, PUNCTUATION, Words, chunks, mix, powers, text_buffer
from .store import materialize, whole_rows, with_row_id

SEED = 5
COVERAGE = 0.8
#: bytes of test items that go to every task at once; more are done in slices
SLICE_BYTES = 16 << 20
SCHEMA = "rid long, doc_id long, n_items long, item_id long, coverage double, n_tiles long"


def _windows(tokens: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the runs of ``length`` unmarked words, and where."""
    n = len(tokens) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocked = np.concatenate(([0], np.cumsum(~free)))
    at = np.flatnonzero(blocked[length:] == blocked[:n])
    up, _ = powers(len(tokens) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * up[: len(tokens)], dtype=np.uint64)))
    return mix((prefix[at + length] - prefix[at]) * up[len(tokens) - at]), at


def tile(item: np.ndarray, doc: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles ``(item position, document position, words)`` of two word-hash
    arrays, longest first; equal lengths in order of position."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    tiles, longest = [], min(len(item), len(doc))

    def common(length):
        # one factor for both sides makes the position drop out of the hash
        h_item, at_item = _windows(np.concatenate((item, np.zeros(max(0, len(doc) - len(item)), np.uint64))),
                                   np.concatenate((free_item, np.zeros(max(0, len(doc) - len(item)), bool))), length)
        h_doc, at_doc = _windows(np.concatenate((doc, np.zeros(max(0, len(item) - len(doc)), np.uint64))),
                                 np.concatenate((free_doc, np.zeros(max(0, len(item) - len(doc)), bool))), length)
        order = np.argsort(h_doc, kind="stable")
        h_doc, at_doc = h_doc[order], at_doc[order]
        first, last = np.searchsorted(h_doc, h_item), np.searchsorted(h_doc, h_item, "right")
        hit = np.flatnonzero(first < last)
        # item places, each with the places of its hash in the document
        return list(zip(at_item[hit].tolist(), first[hit].tolist(), last[hit].tolist())), at_doc

    def equal(i, j, length):
        return bool((item[i: i + length] == doc[j: j + length]).all())

    def mark(found, at_doc, length):
        """Marks each item place with the first free equal place. Places that
        are taken stay taken, so a hash's places are passed over once."""
        open_from: dict[int, int] = {}
        for i, first, last in found:
            if not free_item[i: i + length].all():
                continue
            at = open_from.get(first, first)
            while at < last and not free_doc[at_doc[at]: at_doc[at] + length].all():
                at += 1
            open_from[first] = at
            for k in range(at, last):
                j = int(at_doc[k])
                if free_doc[j: j + length].all() and equal(i, j, length):
                    free_item[i: i + length] = free_doc[j: j + length] = False
                    tiles.append((i, j, length))
                    break

    while longest >= shortest:
        low, high, best = shortest, longest, None
        while low <= high:  # a run of s words holds one of s - 1
            middle = (low + high + 1) // 2 if best is None and high > low else (low + high) // 2
            found, at_doc = common(middle)
            if any(equal(i, int(at_doc[k]), middle) for i, first, last in found for k in range(first, last)):
                best, low = (middle, found, at_doc), middle + 1
            else:
                high = middle - 1
        if best is None:
            break
        longest = best[0]
        mark(best[1], best[2], longest)
    return tiles


class _Items:
    """Word hashes of the items, and the items of each seed."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = text_buffer(pc.utf8_lower(pa.array(texts, pa.large_string())))
        words = Words(data, offsets, PUNCTUATION)
        seeds, whole = words.shingles(SEED)
        item = np.repeat(np.arange(len(texts)), np.diff(words.first))
        pairs = np.unique(np.stack([seeds[whole], item[whole].astype(np.uint64)]), axis=1)
        self.ids, self.words = ids, [words.hashes[a:b] for a, b in zip(words.first, words.first[1:])]
        self.seeds, self.items = pairs[0], pairs[1].astype(np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.seeds >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Positions whose seed some item has."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        k = np.searchsorted(self.seeds, hashes[at])
        return at[(k < len(self.seeds)) & (self.seeds[np.minimum(k, len(self.seeds) - 1)] == hashes[at])]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.seeds, hashes), np.searchsorted(self.seeds, hashes, "right")
        return np.unique(np.concatenate([self.items[a:b] for a, b in zip(lo, hi)]))


def _search(batches, items: _Items, coverage: float):
    for batch in batches:
        data, offsets = text_buffer(pc.utf8_lower(batch.column(2)))
        for lo, hi in chunks(offsets):
            words = Words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], PUNCTUATION)
            seeds, whole = words.shingles(SEED)
            n = hi - lo
            best = [(0, None, 0.0, 0)] * n
            at = np.flatnonzero(whole)
            at = at[items.hits(seeds[at])] if len(items.seeds) else at[:0]
            cuts = np.searchsorted(at, words.first)
            for d in np.flatnonzero(np.diff(cuts)):
                hit = at[cuts[d]: cuts[d + 1]]
                best[d] = _best(items, words.hashes, seeds, hit, coverage)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array([b[0] for b in best], pa.int64()),
                 pa.array([b[1] for b in best], pa.int64()), pa.array([float(b[2]) for b in best]),
                 pa.array([b[3] for b in best], pa.int64())],
                names=["rid", "doc_id", "n_items", "item_id", "coverage", "n_tiles"])


def _best(items: _Items, hashes, seeds, hit, coverage):
    """Items that the document holds, and the one it covers best."""
    n, found = 0, (0.0, None, 0)
    for k in items.of(seeds[hit]):
        item = items.words[k]
        # words of seeds of this item; a gap between them ends every run
        own = hit[np.isin(seeds[hit], items.seeds[items.items == k])]
        word = np.unique((own[:, None] + np.arange(SEED)).ravel())
        gaps = np.flatnonzero(np.diff(word) > 1) + 1
        doc = np.insert(hashes[word], gaps, mix(gaps.astype(np.uint64) + BASE))
        tiles = tile(item, doc)
        covered = sum(t[2] for t in tiles) / len(item)
        n += covered >= coverage
        if covered > found[0] or covered == found[0] and found[1] is not None and items.ids[k] < found[1]:
            found = covered, items.ids[k], len(tiles)
    return n, found[1], found[0], found[2]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``(rid, doc_id, n_items, item_id, coverage, n_tiles, contaminated)``,
    one row per input row.

    Words are runs of letters and digits, lowered. ``item_id`` is the item
    whose words the tiles cover best (null without a tile, smallest id of
    equals), ``n_items`` counts items covered to ``coverage`` or more; one is
    enough for ``contaminated``. Null texts, items without an id and items of
    fewer than five words match nothing. The items are the query set: they
    go to the tasks in slices of bounded bytes, each against all documents,
    so documents are not shuffled for one slice.
    """
    rows = with_row_id(docs, docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return _decontaminate(rows, benchmark, item_col, item_text, coverage)


def _decontaminate(rows: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text",
                   coverage: float = COVERAGE) -> DataFrame:
    """``decontaminate`` of ``(rid, doc_id, text)``."""
    spark = rows.sparkSession
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), benchmark[item_text].alias("text")) \
        .filter("item_id is not null and text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    slices = max(1, -(-2 * total // SLICE_BYTES))
    if slices > 1:  # every slice meets the same numbers
        rows = materialize(rows, "rows", "zstd")
    found = None
    for k in range(slices):
        own = items if slices == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        table = own.toArrow()
        sent = spark.sparkContext.broadcast((table.column("item_id").to_pylist(), table.column("text").to_pylist()))
        part = rows.mapInArrow(lambda it, sent=sent: _search(it, _Items(*sent.value), coverage), SCHEMA)
        if slices > 1:
            part = materialize(part, f"slice{k}")
        found = part if found is None else found.unionByName(part)
    if slices > 1:
        order = F.struct("coverage", -F.col("item_id"))
        found = found.groupBy("rid").agg(
            F.first("doc_id").alias("doc_id"), F.sum("n_items").alias("n_items"),
            F.max_by("item_id", order).alias("item_id"), F.max("coverage").alias("coverage"),
            F.max_by("n_tiles", order).alias("n_tiles"))
    return found.withColumn("contaminated", F.col("n_items") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""
    whole = whole_rows(docs)
    rows = whole.select("rid", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"row.`{text_col}`").alias("text"))
    bad = _decontaminate(rows, benchmark, **options).filter("contaminated").select("rid")
    return whole.join(bad, "rid", "left_anti").select("row.*")
