"""Vectorised text kernels on Arrow batches: words, hashes of byte ranges.

Hashes are polynomials modulo 2**64 taken from prefix sums, so any byte
range costs two lookups; ``mix`` spreads the bits afterwards.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

#: odd, so that it has an inverse modulo 2**64
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: bytes handled at once; bounds a task's memory at about 100 times this
CHUNK = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[:128] = [not chr(c).isalnum() for c in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: byte tables that say what separates words
SPACES, PUNCTUATION = _SPACE, _PUNCT
#: A-Z to a-z, other bytes as they are
LOWER = _LOWER


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    size = max(CHUNK + 4096, 1 << max(0, int(n - 1).bit_length()) if n > CHUNK + 4096 else 0)
    up, down = _powers(size)
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: a second modulus, so that no text cancels out in both hashes
PRIME, PRIME_BASE = (1 << 31) - 1, 48271


@lru_cache(maxsize=4)
def _prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(PRIME_BASE, -1, PRIME)
    out = []
    for base in (PRIME_BASE, inverse):
        powers_ = np.ones(n, np.uint64)
        done = 1
        while done < n:  # the known powers, times the next one
            more = min(done, n - done)
            powers_[done: done + more] = powers_[:more] * np.uint64(pow(base, done, PRIME)) % np.uint64(PRIME)
            done += more
        out.append(powers_)
    return out[0], out[1]


def prime_range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free polynomial hash of each byte range modulo ``PRIME``."""
    n = len(data) + 1
    size = CHUNK + 4096 if n <= CHUNK + 4096 else 1 << int(n - 1).bit_length()
    up, down = _prime_powers(size)
    prefix = np.zeros(n, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: n - 1] % np.uint64(PRIME), out=prefix[1:])
    return (prefix[end] - prefix[start]) % np.uint64(PRIME) * down[start] % np.uint64(PRIME)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[i] = sum over j < i of (data[j] + 1) * BASE**j."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free polynomial hash of each byte range."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string (or binary) column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]: offs[-1]], offs - offs[0]


class Words:
    """Words of a batch of texts, in order.

    ``hashes``: 64-bit hash per word; ``start``, ``end``: byte range in the
    batch; ``first``: index of each text's first word (one more at the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES, lower: bool = True):
        word = ~separators[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins = word & (edge[:-1] | ~np.concatenate(([False], word[:-1])))
        ends = word & (edge[1:] | ~np.concatenate((word[1:], [False])))
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hashes = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):  # whole words, about CHUNK bytes at once
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + CHUNK, "right")))
            lo, hi = self.start[at], self.end[to - 1]
            piece = _LOWER[data[lo:hi]] if lower else data[lo:hi]
            begin, stop = self.start[at:to] - lo, self.end[at:to] - lo
            second = mix(prime_range_hashes(piece, begin, stop) + np.uint64(1))
            self.hashes[at:to] = mix(range_hashes(prefix_hashes(piece), begin, stop) ^ second)
            at = to

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether they all lie in
        one text."""
        w = self.hashes
        total = np.zeros(len(w), np.uint64)
        for k, factor in enumerate(powers(n)[0]):
            total[: max(0, len(w) - k)] += w[k:] * factor
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        whole = np.zeros(len(w), bool)
        if len(w) >= n:
            whole[: len(w) - n + 1] = doc[: len(w) - n + 1] == doc[n - 1:]
        return mix(total), whole


def chunks(offsets: np.ndarray, limit: int = CHUNK):
    """Ranges of texts that hold about ``limit`` bytes; a longer text is alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), then those of start[1], ..."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def by_key(batches, n_keys: int):
    """Tables of the rows of one key each, from batches sorted by their first
    ``n_keys`` columns."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and tuple(keys[lo]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(keys[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
