"""Suffix-array deduplication of byte strings of a fixed length.

Every window of ``LENGTH`` bytes names an anchor, the place of its smallest
40-byte hash, so equal windows have equal anchors at equal places. The
windows of one anchor form a segment. Segments that are equal as a whole, by
their SHA-256, are settled by counting. Different segments around equal anchors are compared by
a suffix array: the suffixes at the anchors are merge-sorted (and, mirrored,
the prefixes before them); a comparison finds the common extension by binary
search over prefix hashes. A window is repeated if another segment lies in
the same interval of both arrays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernel import CHUNK, by_key, chunks, mix, powers, prefix_hashes, text_buffer
from .store import materialize, stored_rows

LENGTH = 200
GRAM = 40
#: anchors lie this far into a window at most
REACH = LENGTH - GRAM
#: different segments around one anchor that one task sorts; beyond it their
#: windows are dealt out one by one
GROUP_SEGMENTS = 20_000
#: segments sorted together
SORT_SEGMENTS = 16_384
_PLACE = np.uint64((1 << 22) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(x)
    padded = np.full(-(-n // width) * width, ~np.uint64(0))
    padded[:n] = x
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1: n])


def segments(data: np.ndarray, offsets: np.ndarray):
    """First and last window start, anchor, anchor hash and the segment's
    digest (two halves) of the segments of some texts."""
    empty = np.zeros(0, np.int64)
    none = empty, empty, empty, empty.view(np.uint64), empty, empty
    if len(data) < LENGTH:
        return none
    h = prefix_hashes(data)
    _, down = powers(len(h))
    gram = mix((h[GRAM:] - h[:-GRAM]) * down[: len(h) - GRAM])
    packed = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)  # the leftmost of equal ones
    anchor = (_sliding_min(packed, REACH + 1) & _PLACE).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    valid[offsets[long]] += 1
    np.add.at(valid, offsets[long + 1] - LENGTH + 1, -1)
    start = np.flatnonzero(np.cumsum(valid)[:-1] > 0)
    if not len(start):
        return none
    own = anchor[start]
    new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1))))
    lo, at = start[new], own[new]
    hi = start[np.concatenate((new[1:], [len(start)])) - 1]
    digest = digests(data, lo, hi + LENGTH)
    # the anchor's place is part of what must be equal
    return lo, hi, at, gram[at], digest[:, 0] ^ (at - lo), digest[:, 1]


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first 16 bytes of the SHA-256 of each byte range, as two numbers."""
    raw = data.tobytes()
    sha = hashlib.sha256
    found = b"".join([sha(raw[a:b]).digest()[:16] for a, b in zip(start.tolist(), end.tolist())])
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def _pieces(data: np.ndarray, offsets: np.ndarray):
    """Chunks of texts; a long text in pieces that share all but one byte of
    a window. Yields first text, its byte offset, data and offsets."""
    for lo, hi in chunks(offsets):
        part, offs = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        if len(part) <= 2 * CHUNK:
            yield lo, 0, part, offs
        else:
            for at in range(0, len(part) - LENGTH + 1, CHUNK):
                piece = part[at: at + CHUNK + LENGTH - 1]
                yield lo, at, piece, np.array([0, len(piece)])


def _segment_rows(batches):
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        rids = batch.column(0).to_numpy()
        for text, shift, part, offs in _pieces(data, offsets):
            lo, hi, at, anchor, first, second = segments(part, offs)
            of = np.searchsorted(offs, lo, "right") - 1
            place = (lo - offs[of] + shift) << 16 | (hi - lo) << 8 | (at - lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(first), pa.array(second), pa.array(rids[of + text]),
                 pa.array(place)], names=["ah", "sh", "sh2", "rid", "place"])


def _fetch(batches):
    """Bytes of the segments asked for, cut out of their texts."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        asked = batch.column(2)
        of = np.repeat(np.arange(batch.num_rows), asked.value_lengths().to_numpy())
        flat = asked.flatten()
        place = flat.field("place").to_numpy()
        start = offsets[of] + (place >> 16)
        size = (place >> 8 & 255) + LENGTH
        out = [data[a: a + n].tobytes() for a, n in zip(start, size)]
        yield pa.RecordBatch.from_arrays(
            [flat.field("ah"), pa.array(batch.column(0).to_numpy()[of]), flat.field("place"), flat.field("lone"),
             flat.field("hot"), pa.array(out, pa.binary())],
            names=["ah", "rid", "place", "lone", "hot", "bytes"])


class SuffixOrder:
    """Sorted order of suffixes within groups, and common lengths of
    neighbours. ``start`` and ``limit``: where each suffix begins in ``data``
    and how many bytes count; ``group`` is ascending."""

    def __init__(self, data: np.ndarray, start: np.ndarray, limit: np.ndarray, group: np.ndarray):
        self.data, self.start, self.limit, self.group = data, start, limit, group
        self.prefix = prefix_hashes(data)
        self.down = powers(len(self.prefix))[1]
        self.steps = int(limit.max(initial=0)).bit_length()
        self.order = self._merge_sort()
        self.common = np.full(len(start), -1, np.int64)
        if len(start) > 1:
            a, b = self.order[:-1], self.order[1:]
            same = group[a] == group[b]
            self.common[1:][same] = self.extension(a[same], b[same])
            if not self._verified():
                self._sort_exactly()

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common bytes of suffixes i and j, by binary search on hashes."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.limit[i], self.limit[j])
        a, b = self.start[i], self.start[j]
        h, down = self.prefix, self.down
        ha, hb, da, db = h[a], h[b], down[a], down[b]
        for _ in range(self.steps):
            middle = (low + high + 1) >> 1
            equal = (h[a + middle] - ha) * da == (h[b + middle] - hb) * db
            low = np.where(equal, middle, low)
            high = np.where(equal, high, middle - 1)
        return low

    def _less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Suffix i sorts before suffix j (equal ones: no)."""
        n = self.extension(i, j)
        inside = n < np.minimum(self.limit[i], self.limit[j])
        last = len(self.data) - 1
        left = self.data[np.minimum(self.start[i] + n, last)]
        right = self.data[np.minimum(self.start[j] + n, last)]
        return np.where(inside, left < right, self.limit[i] < self.limit[j])

    def _merge_sort(self) -> np.ndarray:
        """Bottom-up, all groups and runs of a width at once: the place of an
        element is its own index plus its rank in the neighbouring run."""
        n = len(self.start)
        order = np.arange(n)
        first = np.searchsorted(self.group, self.group)  # of the element's group
        last = np.searchsorted(self.group, self.group, "right")
        width, widest = 1, int((last - first).max(initial=0))
        while width < widest:
            at = np.arange(n)
            run = (at - first) // width
            other = first + (run ^ 1) * width
            has = np.flatnonzero(other < last)
            low, high = other[has], np.minimum(other[has] + width, last[has])
            begin, left = low.copy(), run[has] % 2 == 0
            own = order[has]
            for _ in range(int(width).bit_length()):
                open_ = low < high
                middle = (low + high) >> 1
                probe = order[np.minimum(middle, n - 1)]
                # equal elements of the left run come first
                before = np.where(left, self._less(probe, own), ~self._less(own, probe)) & open_
                low = np.where(before, middle + 1, low)
                high = np.where(open_ & ~before, middle, high)
            place = at.copy()
            pair = first[has] + (run[has] // 2) * 2 * width
            place[has] = pair + (at[has] - first[has]) % width + (low - begin)
            moved = np.empty(n, np.int64)
            moved[place] = order
            order = moved
            width *= 2
        return order

    def _verified(self) -> bool:
        """Neighbours agree in exactly their common bytes (no hash collision)."""
        k = np.flatnonzero(self.common > 0)
        a, b, n = self.start[self.order[k - 1]], self.start[self.order[k]], self.common[k]
        for lo in range(0, len(k), 4096):
            s = slice(lo, lo + 4096)
            step = np.arange(n[s].sum()) - np.repeat(np.cumsum(n[s]) - n[s], n[s])
            if (self.data[np.repeat(a[s], n[s]) + step] != self.data[np.repeat(b[s], n[s]) + step]).any():
                return False
        return True

    def _sort_exactly(self) -> None:
        text = [self.data[a: a + n].tobytes() for a, n in zip(self.start, self.limit)]
        self.order = np.array(sorted(range(len(text)), key=lambda k: (self.group[k], text[k])))
        for k in range(1, len(text)):
            i, j = self.order[k - 1], self.order[k]
            n = 0
            while self.group[i] == self.group[j] and n < min(len(text[i]), len(text[j])) and text[i][n] == text[j][n]:
                n += 1
            self.common[k] = n if self.group[i] == self.group[j] else -1

    def intervals(self, least: int) -> np.ndarray:
        """Per suffix, the number of its interval of suffixes that share
        ``least`` bytes with a neighbour."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.common < least)
        return out


def repeated_windows(data: np.ndarray, offsets: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """``[segment, distance of the window's start before the anchor]``: True
    where another segment of the group has the same window."""
    size = np.diff(offsets)
    anchor = offsets[:-1] + at
    right = SuffixOrder(data, anchor, np.minimum(size - at, LENGTH), group)
    left = SuffixOrder(data[::-1].copy(), len(data) - anchor, at, group)
    out = np.zeros((len(at), REACH + 1), bool)
    for back in range(REACH + 1):
        has = np.flatnonzero((at >= back) & (size - at >= LENGTH - back))
        if len(has) < 2:
            continue
        pair = right.intervals(LENGTH - back)[has] * (len(at) + 1) + left.intervals(back)[has]
        order = np.argsort(pair, kind="stable")
        same = np.diff(pair[order]) == 0
        out[has[order[1:][same]], back] = out[has[order[:-1][same]], back] = True
    return out


def _sorted_spans(batches):
    held, count = [], 0

    def flush():
        table = pa.concat_tables(held)
        data, offsets = text_buffer(table.column("bytes"))
        place = table.column("place").to_numpy()
        group = np.cumsum(np.concatenate(([0], np.diff(table.column("ah").to_numpy()) != 0)))
        at = place & 255
        found = repeated_windows(data, offsets, at, group) & table.column("lone").to_numpy()[:, None]
        edge = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
        row, begin = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]  # runs of distances, in the same order
        anchor = (place >> 16)[row] + at[row]
        return pa.RecordBatch.from_arrays(
            [pa.array(table.column("rid").to_numpy()[row]), pa.array(anchor - (end - 1)),
             pa.array(anchor - begin + LENGTH)], names=["rid", "start", "end"])

    for table in by_key(batches, 1):
        held.append(table)
        count += table.num_rows
        if count >= SORT_SEGMENTS:
            yield flush()
            held, count = [], 0
    if held:
        yield flush()


def _window_rows(batches):
    """The digest of every window of the segments of large groups."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("bytes"))
        place = batch.column("place").to_numpy()
        count = np.diff(offsets) - LENGTH + 1
        of = np.repeat(np.arange(len(count)), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = offsets[of] + step
        digest = digests(data, start, start + LENGTH)
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest[:, 0]), pa.array(digest[:, 1]),
             pa.array(batch.column("rid").to_numpy()[of]), pa.array((place[of] >> 16) + step),
             pa.array(batch.column("lone").to_numpy(zero_copy_only=False)[of])],
            names=["w1", "w2", "rid", "start", "lone"])


RESULT_SCHEMA = ("rid long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                 "spans array<struct<start:long,end:long>>, kept binary")


def _cut(batches, with_bytes: bool):
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        out = []
        for k, (rid, doc_id, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)))):
            own = data[offsets[k]: offsets[k + 1]]
            spans = []
            for p in sorted(packed or ()):
                start, end = p >> 32, p & 0xFFFFFFFF
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
            at, kept = 0, []
            for start, end in spans:
                kept.append(own[at:start].tobytes())
                at = end
            kept = b"".join([*kept, own[at:].tobytes()])
            out.append((rid, doc_id, len(own), len(own) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                        [{"start": a, "end": b} for a, b in spans], kept if with_bytes else None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, _RESULT_TYPES)], names=_RESULT_NAMES)


_RESULT_NAMES = ["rid", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
_RESULT_TYPES = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                                    pa.binary()]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 with_bytes: bool = False) -> DataFrame:
    """``(rid, doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans,
    kept)``, one row per input row: removed are all bytes covered by a
    200-byte string that also starts elsewhere in the table, overlaps too.

    Texts count as UTF-8 bytes (null: empty), so kept bytes need not be valid
    UTF-8. Repeated rows remove each other. Copies of a segment, by 128 bits
    of its SHA-256, are counted, combined before the shuffle; only one of each
    goes to the suffix array. A group of more than ``GROUP_SEGMENTS``
    different segments is compared by such digests of its windows, dealt out
    by those. The numbered texts are written once and read three times.
    """
    rows = stored_rows(docs, docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    found = rows.select("rid", "text").mapInArrow(_segment_rows, "ah long, sh long, sh2 long, rid long, place long")
    both = [f(c).alias(f"{name}_{c}") for c in ("sh", "sh2") for f, name in ((F.min, "low"), (F.max, "high"))]
    shared = found.groupBy("ah").agg(F.count("*").alias("n"), *both) \
        .filter("n > 1").select("ah", ((F.col("low_sh") != F.col("high_sh")) | (F.col("low_sh2") != F.col("high_sh2"))).alias("differ"))
    # written first: AQE splits a hot key only between two shuffled sides
    shared = materialize(found.join(materialize(shared, "shared").hint("merge"), "ah"), "segments")
    whole = [(F.shiftright("place", 16)).alias("start"),
             (F.shiftright("place", 16) + F.shiftright("place", 8).bitwiseAND(255) + LENGTH).alias("end")]
    equal = shared.filter("not differ").select("rid", *whole)
    differ = shared.filter("differ")
    kinds = materialize(differ.groupBy("ah", "sh", "sh2").agg(F.count("*").alias("n"),
                                                       F.min(F.struct("rid", "place")).alias("first")), "kinds")
    copied = differ.join(kinds.filter("n > 1").select("ah", "sh", "sh2"), ["ah", "sh", "sh2"]).select("rid", *whole)
    large = materialize(kinds.groupBy("ah").agg(F.count("*").alias("m"))
                        .filter(F.col("m") > GROUP_SEGMENTS).select("ah", F.lit(True).alias("hot")), "large")
    asked = kinds.join(large, "ah", "left").groupBy("first.rid").agg(F.collect_list(F.struct(
        "ah", F.col("first.place").alias("place"), (F.col("n") == 1).alias("lone"),
        F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    texts = rows.select("rid", "text").join(asked, "rid").select("rid", "text", "asked")
    cut = materialize(texts.mapInArrow(_fetch, "ah long, rid long, place long, lone boolean, hot boolean, bytes binary"),
                      "cut")
    alike = cut.filter("not hot").repartition("ah").sortWithinPartitions("ah") \
        .mapInArrow(_sorted_spans, "rid long, start long, end long")
    spans = equal.unionByName(copied).unionByName(alike)
    if large.limit(1).count():
        windows = cut.filter("hot").mapInArrow(_window_rows, "w1 long, w2 long, rid long, start long, lone boolean")
        twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
        spans = spans.unionByName(windows.filter("lone").join(twice, ["w1", "w2"]).select(
            "rid", "start", (F.col("start") + LENGTH).alias("end")))
    packed = spans.groupBy("rid").agg(F.collect_list(F.shiftleft("start", 32) + F.col("end")).alias("spans"))
    return rows.join(packed, "rid", "left").select("rid", "doc_id", "text", "spans") \
        .mapInArrow(lambda it: _cut(it, with_bytes), RESULT_SCHEMA)
