"""N-gram Jaccard join: blocked sparse product of the document by shingle
incidence matrix.

Which documents can meet at all is found on prefixes: a document of n
shingles that reaches the threshold with another shares one of any
``n - ceil(threshold * n) + 1`` of its shingles. Shingles are ordered with a
fixed part of the hash space first, by how many documents hold them, so
documents whose first shingles are all their own need no partner. The rest
falls into blocks, and in each block the product of the incidence matrix with
its transpose gives all overlap counts. A block holds documents of two
neighbouring classes of sizes. Where chance joins many documents into one
group, it is taken apart first, by prefixes over all of its shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .kernel import Words, by_key, chunks, mix, ranges, text_buffer
from .store import discard, materialize, stored_rows, whole_rows

SHINGLE = 3
PERCENT = 90
#: share of the hash space that is counted over all documents, in thousandths:
#: well over the share of a document's shingles that its prefix has
LEAST_SAMPLE, SAMPLE_PER_PREFIX = 200, 1.6
#: documents in one block; larger groups are dealt into tiles of half this size,
#: and groups of more than ``MOST_TILES`` are taken apart before that
BLOCK_DOCS, MOST_TILES = 4096, 8

SETS_SCHEMA = ("rid long, doc_id long, n long, s1 long, s2 long, first boolean, sampled array<long>, "
               "rest array<long>")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(data, offsets)
    hashes, _ = words.shingles(size)
    out = []
    for a, b in zip(words.first, words.first[1:]):
        if b - a >= size:
            out.append(np.unique(hashes[a: b - size + 1]))
        else:  # the whole sequence is one shingle, apart from longer ones
            whole = np.uint64(b - a)
            for w in words.hashes[a:b]:
                whole = mix(np.array([whole ^ w]))[0]
            out.append(np.array([whole] if b > a else [], np.uint64))
    return out


def needed(n, percent: int = PERCENT):
    """Shingles that a document of n must share with any partner."""
    return -(-percent * n // 100)


def sample_share(percent: int = PERCENT) -> int:
    return min(1000, max(LEAST_SAMPLE, round(10 * SAMPLE_PER_PREFIX * (100 - percent))))


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, the same wherever the set stands."""
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    ends = np.cumsum([0, *map(len, sets)])
    out = []
    for k in (0x5BD1E995, 0xC2B2AE35):
        total = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(mix(flat ^ np.uint64(k)), out=total[1:])
        out.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
    return out[0], out[1]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sets(batches, size: int, percent: int):
    seen: set[tuple[int, int]] = set()  # of this task: a copy's shingles are sent once
    share = np.uint64(sample_share(percent))
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        for lo, hi in chunks(offsets):
            sets = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], size)
            s1, s2 = set_keys(sets)
            sampled, rest, first = [], [], []
            empty = np.zeros(0, np.uint64)
            for k, own in enumerate(sets):
                first.append((key := (int(s1[k]), int(s2[k]))) not in seen)
                if not first[-1]:
                    sampled.append(empty)
                    rest.append(empty)
                    continue
                seen.add(key)
                chosen = own % np.uint64(1000) < share
                sampled.append(own[chosen])
                prefix = len(own) - needed(len(own), percent) + 1 if len(own) else 0
                rest.append(own[~chosen][: max(0, prefix - len(sampled[-1]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2), pa.array(first, pa.bool_()),
                 _lists(sampled), _lists(rest)],
                names=["rid", "doc_id", "n", "s1", "s2", "first", "sampled", "rest"])


def _whole_sets(batches, size: int):
    """``(root, node, all)`` of ``(root, node, text)``: all shingles."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        for lo, hi in chunks(offsets):
            sets = shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], size)
            yield pa.RecordBatch.from_arrays([batch.column(k).slice(lo, hi - lo) for k in range(2)] + [_lists(sets)],
                                             names=["root", "node", "all"])


def _block_links(rids: np.ndarray, sets: list[np.ndarray], percent: int):
    """A spanning forest of the links of one block.

    A row of the product holds all overlaps of one document. Rows are taken
    until every document whose row has not been taken belongs to one group:
    any other pair has then been looked at from one side. So a large group of
    near copies costs a few rows, not one for each copy.
    """
    n_docs = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    ids, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n_docs), size)
    held = np.bincount(column, minlength=len(ids))
    keep = held[column] > 1  # columns of one document add to no product
    row, column = row[keep], column[keep]
    by_column = np.argsort(column, kind="stable")
    docs_of = row[by_column]
    starts = np.concatenate(([0], np.cumsum(np.bincount(column, minlength=len(ids)))))
    first = np.searchsorted(row, np.arange(n_docs + 1))
    root, open_ = np.arange(n_docs), first[1:] > first[:-1]
    while open_.any():
        own = np.bincount(root[open_], minlength=n_docs)
        outside = np.flatnonzero(open_ & (root != own.argmax()))
        if not len(outside):
            break
        i = outside[0]
        open_[i] = False
        cols = column[first[i]: first[i + 1]]
        at = ranges(starts[cols], starts[cols + 1] - starts[cols])
        overlap = np.bincount(docs_of[at], minlength=n_docs)
        # below the bound that the two sizes give, a pair is dropped
        linked = (100 + percent) * overlap >= percent * (size[i] + size)
        for other in np.unique(root[linked & (root != root[i])]):
            j = np.flatnonzero(linked & (root == other))[0]
            yield rids[i], rids[j]
            low, high = min(root[i], other), max(root[i], other)
            root[root == high] = low


def _links(batches, size: int, percent: int):
    for table in by_key(batches, 2):
        if table.num_rows < 2:
            continue
        rids = table.column("rid").to_numpy()
        data, offsets = text_buffer(table.column("text"))
        sets = []
        for lo, hi in chunks(offsets):
            sets += shingle_sets(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo], size)
        pairs = list(_block_links(rids, sets, percent))
        if pairs:
            a, b = zip(*pairs)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _representatives(sets: DataFrame) -> DataFrame:
    """``(s1, s2, rep, low)``: of each set the first row that carries its
    shingles, and the smallest id of all its rows."""
    return sets.filter("n > 0").groupBy("s1", "s2").agg(
        F.min(F.when(F.col("first"), F.col("rid"))).alias("rep"), F.min("doc_id").alias("low"))


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """``(rid, n, h)``: prefix shingles that two or more documents may share."""
    inc = sets.select("rid", F.explode("sampled").alias("h"))
    df = inc.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    shared = inc.join(df, "h").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("shared"))
    reps = _representatives(sets).select(F.col("rep").alias("rid"))
    lean = sets.select("rid", "n", F.size("sampled").alias("m"), "rest").join(reps, "rid") \
        .join(shared, "rid", "left")
    common = F.coalesce(F.size("shared"), F.lit(0))
    own = F.col("m") - F.greatest(common, F.lit(0))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    lean = lean.withColumn("take", (prefix - own).cast("int")).filter("take > 0")
    first = F.transform(F.slice(F.coalesce("shared", F.array().cast("array<struct<df:bigint,h:bigint>>")), 1,
                                F.col("take")), lambda x: x["h"])
    return lean.select("rid", "n", F.explode(F.concat(first, "rest")).alias("h"))


def size_class(n, percent: int = PERCENT):
    """Classes of sizes: those of two linked documents differ by one at most."""
    # a little wider than the least ratio of sizes, so that rounding parts no pair
    return F.floor(F.log(n) / (math.log(100 / percent) + 1e-9))


def _groups(cols: DataFrame, *key: str) -> DataFrame:
    """``(node, root, held)``: the connected groups of the nodes with one key,
    and their sizes. A node is a document (``node >> 1``) in its own class of
    sizes (even) or in the class above (odd); documents of one class meet in
    their own."""
    lead = cols.groupBy(*key).agg(F.min("node").alias("b"), F.count("*").alias("shared"),
                                  F.min(F.col("node").bitwiseAND(F.lit(1))).alias("above"))
    lead = lead.filter("shared > 1 and above = 0")
    groups = connected_components(cols.join(lead, list(key)).select(F.col("node").alias("a"), "b").filter("a <> b"))
    return materialize(groups.join(groups.groupBy("root").agg(F.count("*").alias("held")), "root")
                       .select("node", "root", "held"), "groups")


def _taken_apart(rows: DataFrame, large: DataFrame, size: int, percent: int) -> DataFrame:
    """``(node, root, held)`` of smaller groups with all linked pairs of the
    groups ``(node, root)``: all shingles of a group's documents are ordered
    by how many of these hold them, so a prefix holds the rarest."""
    texts = rows.select("rid", "text").join(large.select("root", "node", F.shiftright("node", 1).alias("rid")), "rid") \
        .select("root", "node", "text")
    sets = materialize(texts.mapInArrow(lambda it: _whole_sets(it, size), "root long, node long, all array<long>"), "whole")
    inc = sets.select("root", "node", F.explode("all").alias("h"))
    df = inc.groupBy("root", "h").agg(F.count("*").alias("df")).filter("df > 1")
    shared = inc.join(df, ["root", "h"]).groupBy("root", "node") \
        .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("shared"))
    lean = shared.join(sets.select("node", F.size("all").alias("n")), "node")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1
    lean = lean.withColumn("take", (prefix - F.col("n") + F.size("shared")).cast("int")).filter("take > 0")
    first = lean.select("root", "node", F.explode(F.slice("shared", 1, F.col("take"))).alias("x"))
    cols = materialize(first.select("root", "x.h", "node"), "columns")
    apart = _groups(cols, "root", "h")
    discard(sets, cols)
    return apart


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """``(rid, doc_id, n_shingles, component, component_id)``, one row per
    input row: documents link if ``100 * overlap >= percent * union`` of their
    distinct ``size``-word shingles (words between white space, A-Z lowered).

    ``component`` names the group (a row id), ``component_id`` is its smallest
    ``doc_id`` (nulls only if there is no other). Texts without words link
    with nothing. Equal sets are joined once, by their 128-bit sum hash.
    Groups of documents of like sizes with common prefix shingles are product
    blocks. A group over ``BLOCK_DOCS`` documents is dealt into tiles, and
    every pair of tiles is a block, so no task holds more than two tiles of
    texts and no pair is lost. As a text is sent once a tile, a group of many
    tiles is first taken apart by its rarest shingles. The numbered texts are written once and read twice.
    """
    rows = stored_rows(docs, docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return _components(rows, size, percent)


def _components(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``jaccard_components`` of stored ``(rid, doc_id, text)``."""
    sets = materialize(rows.mapInArrow(lambda it: _sets(it, size, percent), SETS_SCHEMA), "sets")
    cols = materialize(_candidates(sets, percent), "columns")
    nodes = cols.select("h", size_class("n", percent).alias("class"), "rid",
                        F.explode(F.array(F.lit(0), F.lit(1))).alias("up"))
    groups = _groups(nodes.select("h", (F.col("class") + F.col("up")).alias("class"),
                                  (F.col("rid") * 2 + F.col("up")).alias("node")), "class", "h")
    large = groups.filter(F.col("held") > MOST_TILES * BLOCK_DOCS // 2)
    members = groups.filter(F.col("held") <= MOST_TILES * BLOCK_DOCS // 2)
    if not large.isEmpty():
        members = members.unionByName(_taken_apart(rows, large, size, percent))
    members = members.select("root", F.shiftright("node", 1).alias("rid"), "held")
    # half a block's documents a tile, as a block holds two
    tiles = F.when(F.col("held") <= BLOCK_DOCS, 1).otherwise(F.ceil(F.col("held") * 2 / BLOCK_DOCS)).cast("int")
    tile = F.pmod(F.xxhash64("rid"), tiles).cast("int")
    members = members.select("root", "rid", tiles.alias("tiles"), tile.alias("tile"))
    pairs = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.least(t, "tile") * F.col("tiles") + F.greatest(t, "tile")))
    members = members.select("root", "rid", F.explode(pairs).alias("block"))
    # one plan at every size: the members grow with the documents
    blocked = rows.select("rid", "text").join(members.hint("merge"), "rid").select("root", "block", "rid", "text") \
        .repartition("root", "block").sortWithinPartitions("root", "block", "rid")
    links = blocked.mapInArrow(lambda it: _links(it, size, percent), "a long, b long")
    comps = materialize(connected_components(links), "components")
    keys = materialize(sets.select("rid", "doc_id", "n", "s1", "s2", "first"), "keys")
    discard(sets, cols)
    sets = keys
    reps = _representatives(sets)
    reps = reps.join(comps, reps["rep"] == comps["node"], "left") \
        .select("s1", "s2", "low", F.coalesce("root", "rep").alias("component"))
    low = reps.groupBy("component").agg(F.min("low").alias("component_id"))
    # written, so that AQE can split a set with many copies in the join below
    named = materialize(reps.join(low, "component").select("s1", "s2", "component", "component_id"), "named")
    discard(comps)
    some = sets.select("rid", "doc_id", F.col("n").alias("n_shingles"), "s1", "s2")
    linked = some.filter("n_shingles > 0").join(named, ["s1", "s2"])
    alone = some.filter("n_shingles = 0").select("*", F.col("rid").alias("component"),
                                                  F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("rid", "doc_id", "n_shingles", "component", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are first in their group: smallest id, then
    first row. Texts without words are groups of their own."""
    whole = whole_rows(docs)
    groups = _components(whole.select("rid", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"),
                                      F.col(f"row.`{text_col}`").alias("text")), size, percent)
    first = groups.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"))
    return whole.join(first.select("first.rid"), "rid", "left_semi").select("row.*")
