"""Token files: ids of all documents one after another, with the document
boundaries as Elias-Fano code.

A token file is a folder of Parquet parts. A row is one block: whole
documents in ascending order, their ids concatenated as little-endian
unsigned integers (16 bits if the vocabulary fits, else 32), and the ends of
the documents as an Elias-Fano code: ``low`` holds the low bits packed, and
``high`` the unary-coded high parts, with a select sample every 256
documents. ``shard`` and ``block`` give the order; offsets over the whole
file are sums of ``n_ids`` of the blocks before.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kernel import chunks, ranges, text_buffer
from .pretokens import WordEnds, load_tokenizer
from .store import scratch_path

BLOCK_SCHEMA = ("shard int, block int, n_docs int, n_ids long, id_bits int, doc_ids array<long>, ids binary, "
                "low_bits int, low binary, high binary, samples binary")
READ_SCHEMA = "shard int, block int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
#: documents are added to a block until it has this many ids
BLOCK_IDS = 1 << 20
SAMPLE = 256
#: pre-tokens that a worker remembers, about 32 bytes each; then it starts anew
CACHE_SIZE = 1 << 20


class EliasFano:
    """A non-decreasing sequence of n numbers below a bound, in about
    2 + log2(bound / n) bits each, with access by position."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples
        self._high = np.frombuffer(high, np.uint8)
        self._samples = np.frombuffer(samples, np.uint32)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        bound = int(values[-1]) + 1 if n else 1
        bits = max(0, (bound // max(n, 1)).bit_length() - 1)
        low = ((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8)
        ones = (values >> bits) + np.arange(n)
        high = np.zeros((int(ones[-1]) + 1 if n else 0) + 7, np.uint8)
        high[ones] = 1
        return cls(n, bits, np.packbits(low.ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype(np.uint32).tobytes())

    def select(self, k: int) -> int:
        """Value number k: from the nearest sample on, the k-th one bit."""
        at = int(self._samples[k // SAMPLE])
        left = k % SAMPLE
        byte = at >> 3
        current = int(self._high[byte]) >> (at & 7) << (at & 7)
        while (ones := current.bit_count()) <= left:
            left -= ones
            byte += 1
            current = int(self._high[byte])
        for _ in range(left):
            current &= current - 1
        one = byte * 8 + (current & -current).bit_length() - 1
        first = k * self.low_bits
        own = int.from_bytes(self.low[first >> 3: first + self.low_bits + 7 >> 3], "little") >> (first & 7)
        return (one - k << self.low_bits) + (own & (1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """All values at once."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[: self.n]
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        low = bits[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
        return (ones - np.arange(self.n) << self.low_bits) + low @ (np.int64(1) << np.arange(self.low_bits))


class _Encoder:
    """Token ids of texts with one word-end BPE file, kept per Python worker.

    The ids of every pre-token met so far lie one after another in one array;
    a batch of texts is looked up by the hashes of its pre-tokens, and only
    new ones go to the library.
    """

    _of: dict[str, _Encoder] = {}

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self):
        self.hashes = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    @classmethod
    def get(cls, path):
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, ``end_id`` after each, and how many each has."""
        tokens = WordEnds(data, offsets, self.special)
        hashes, one, which = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE_SIZE:
            self._forget()
        self._learn(tokens, hashes, one)
        at = np.searchsorted(self.hashes, hashes)[which]
        size = self.size[at]
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))[tokens.first]
        ids = np.insert(self.ids[ranges(self.start[at], size)], ends[1:], end_id)
        return ids, np.diff(ends) + 1

    def _learn(self, tokens: WordEnds, hashes: np.ndarray, one: np.ndarray) -> None:
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        if known.all():
            return
        found = [e.ids for e in self.tokenizer.encode_batch_fast(tokens.texts(one[~known]), add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), self.dtype, int(size.sum()))))
        at, new = at[~known], hashes[~known]
        self.hashes = np.insert(self.hashes, at, new)
        self.start, self.size = np.insert(self.start, at, start), np.insert(self.size, at, size)


def _blocks(batches, path: str, end_id: int):
    encoder = _Encoder.get(path)
    width = encoder.dtype.itemsize
    shard, block, ids, parts, sizes, total = None, 0, [], [], [], 0

    def flush():
        code = EliasFano.encode(np.cumsum(np.concatenate(sizes)))
        return pa.RecordBatch.from_pylist([{
            "shard": shard, "block": block, "n_docs": code.n, "n_ids": total, "id_bits": 8 * width,
            "doc_ids": pa.chunked_array(ids).to_pylist(), "ids": b"".join(parts), "low_bits": code.low_bits,
            "low": code.low, "high": code.high, "samples": code.samples}], schema=_ARROW_BLOCK)

    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for lo, hi in chunks(offsets):
            doc_ids = batch.column("doc_id").slice(lo, hi - lo)
            shard = batch.column("shard")[lo].as_py()
            flat, size = encoder.encode(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], end_id)
            ends, at = np.cumsum(size), 0
            while at < len(size):  # whole documents, until the block has its ids
                done = int(ends[at - 1]) if at else 0
                to = min(len(size), int(np.searchsorted(ends, done + BLOCK_IDS - total)) + 1)
                parts.append(flat[done: ends[to - 1]].tobytes())
                ids.append(doc_ids.slice(at, to - at))
                sizes.append(size[at:to])
                total += int(ends[to - 1]) - done
                at = to
                if total >= BLOCK_IDS:
                    yield flush()
                    block, ids, parts, sizes, total = block + 1, [], [], [], 0
    if sizes:
        yield flush()


_ARROW_BLOCK = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
                          ("id_bits", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()),
                          ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
                          ("samples", pa.binary())])


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encodes every text with the tokenizers file ``path``, adds ``end_id``
    and writes a token file to the folder ``out`` (any file system of Spark).

    Documents are in ascending order of their id, nulls first; rows with one
    id are ordered by their text's hash, then by their place in the scan.
    Ranges of the order are dealt out to tasks, so a part starts where the one
    before ends. A null
    text has no ids but the end. An empty table gives a folder without blocks.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                       F.xxhash64(docs[text_col]).alias("h"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange("doc_id", "h", "row") \
        .sortWithinPartitions("doc_id", "h", "row") \
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    ordered.mapInArrow(lambda it: _blocks(it, path, end_id), BLOCK_SCHEMA).write.parquet(out)


def read_token_files(spark, out: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document of a token file:
    where its ids start, how many there are and their checksum as 32-bit
    little-endian integers."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(out)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['id_bits'] // 8}").astype("<u4")
                ends = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"]).all()
                starts = np.concatenate(([0], ends[:-1]))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                n = row["n_docs"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["block"], np.int32)),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts),
                     pa.array(crc, pa.int64())],
                    names=["shard", "block", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    # offsets: shards in one small window (a row each), then blocks within a shard
    heads = blocks.select("shard", "block", "n_ids")
    in_shard = W.partitionBy("shard").orderBy("block")
    heads = heads.withColumn("base", F.sum("n_ids").over(in_shard) - F.col("n_ids"))
    shards = heads.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.withColumn("shard_base", F.sum("n").over(W.orderBy("shard")) - F.col("n")).drop("n")
    bases = heads.join(shards, "shard").select("shard", "block", (F.col("base") + F.col("shard_base")).alias("base"))
    docs = blocks.mapInArrow(run, READ_SCHEMA)
    return docs.join(bases, ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_token_ids(spark, out: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids array<int>)`` of the documents named in ``wanted``, from
    a token file: their offsets by ``select``, no other document is decoded.
    An id that several documents have gives a row each."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(out)
    asked = wanted.select(wanted[id_col].cast("long").alias("doc_id")).distinct()
    # the blocks' ids meet the wanted ones; blocks without any are not opened
    places = blocks.select("shard", "block", F.posexplode("doc_ids").alias("k", "doc_id")) \
        .join(asked, "doc_id")
    places = places.groupBy("shard", "block").agg(F.collect_list("k").alias("ks"))
    opened = blocks.join(places, ["shard", "block"]).select(
        "doc_ids", "ids", "id_bits", "n_docs", "low_bits", "low", "high", "samples", "ks")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['id_bits'] // 8}")
                code = EliasFano(row["n_docs"], row["low_bits"], row["low"], row["high"], row["samples"])
                for k in row["ks"]:
                    own = ids[code.select(k - 1) if k else 0: code.select(k)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["doc_ids"][k]], pa.int64()), pa.array([own.astype(np.int32)], pa.list_(pa.int32()))],
                        names=["doc_id", "ids"])

    return opened.mapInArrow(run, "doc_id long, ids array<int>")


def token_file_index(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                     out: str | None = None) -> DataFrame:
    """Writes a token file and returns what reading it back gives."""
    spark = docs.sparkSession
    out = out or scratch_path(spark, "tokens")
    write_token_files(docs, out, path, end_id, id_col, text_col)
    return read_token_files(spark, out)
