"""Embedding near-duplicates by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions, shifted and cut into
steps; the steps of several directions make a bucket of one table. Vectors of
one bucket are compared by exact cosine. The number of directions follows
from the number of vectors (few unrelated ones share a bucket), the number of
tables from the recall asked for at the threshold itself.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .kernel import by_key, mix
from .store import discard, materialize, stored_rows

COSINE = 0.98
#: share of the pairs just at the threshold that meet in a bucket; nearer ones do more often
RECALL = 0.98
#: step of the projections, in distances of the threshold
STEPS = 8.0
LEAST_DIRECTIONS = 8
#: vectors in a tile; a larger bucket is dealt into tiles, and each pair of tiles is compared
TILE = 2048
#: cosines of a tile handled at once
AT_ONCE = 1 << 18
SEED = 1

LINK_SCHEMA = "a long, b long, held long"


def collision(distance: float, step: float) -> float:
    """Probability that two vectors at a distance fall into one step of one
    Gaussian projection."""
    r = step / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[float, int, int]:
    """``(step, directions a table, tables)`` for n vectors: unrelated vectors
    (at a right angle) meet about once a table, pairs at the threshold in one
    table or more with the probability ``recall``."""
    near = math.sqrt(2 - 2 * cosine)
    step = STEPS * near
    directions = max(LEAST_DIRECTIONS, math.ceil(math.log(max(n, 2)) / -math.log(collision(math.sqrt(2), step))))
    together = collision(near, step) ** directions
    return step, directions, math.ceil(math.log(1 - recall) / math.log(1 - together))


def _family(dim: int, directions: int, tables: int, step: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dim, directions, tables))
    return rng.standard_normal((dim, directions * tables)), rng.uniform(0, step, directions * tables)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest entry is taken out first, so squares
    neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _hashed(batches, directions: int, tables: int, step: float):
    families = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy()
        flat = lists.flatten().to_numpy().astype(np.float64)
        first = np.cumsum(sizes) - sizes
        units, keys = np.empty(len(flat)), np.empty((len(sizes), tables), np.uint64)
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            at = first[own][:, None] + np.arange(dim)
            units[at] = rows = unit(flat[at])
            if dim not in families:
                families[dim] = _family(int(dim), directions, tables, step)
            steps = np.floor((rows @ families[dim][0] + families[dim][1]) / step).astype(np.int64).view(np.uint64)
            key = mix(np.broadcast_to(np.arange(tables, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(dim),
                                      (len(own), tables)).copy())
            key = mix(key ^ mix(batch.column(1).to_numpy()[own].astype(np.int64).view(np.uint64) + np.uint64(1))[:, None])
            for k in range(directions):
                key = mix(key ^ steps[:, k::directions][:, :tables] + np.uint64(0x9E3779B97F4A7C15))
            keys[own] = key
        ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(sizes, dtype=np.int32)))
        key_ends = np.arange(len(sizes) + 1, dtype=np.int32) * tables
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(units)),
             pa.ListArray.from_arrays(pa.array(key_ends), pa.array(keys.view(np.int64).ravel())), batch.column(3)],
            names=["rep", "label", "unit", "keys", "copies"])


def _compare(units: np.ndarray, keys: np.ndarray, table: int, tile: np.ndarray, cross: bool, cosine: float):
    """Index pairs at the threshold or above that no earlier table has; in a
    pair of tiles (``cross``) only those across."""
    n = len(units)
    strip = max(1, AT_ONCE // n)
    for lo in range(0, n, strip):
        close = units[lo: lo + strip] @ units[lo:].T >= cosine
        i, j = np.nonzero(close)
        i, j = i + lo, j + lo
        keep = i < j
        if cross:
            keep &= tile[i] != tile[j]
        i, j = i[keep], j[keep]
        for t in range(table):
            new = keys[i, t] != keys[j, t]
            i, j = i[new], j[new]
        if len(i):
            yield i, j


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray):
    """Hooks the larger root of each pair to the smaller one until the pairs
    agree; the hooks, which span what the pairs join."""
    while True:
        a, b = root[i], root[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        differ = low != high
        if not differ.any():
            return
        i, j, low, high = i[differ], j[differ], low[differ], high[differ]
        high, first = np.unique(high, return_index=True)
        low = low[first]
        yield high, low
        hook = np.arange(len(root))
        hook[high] = low
        while (hook[hook] != hook).any():
            hook = hook[hook]
        root[:] = hook[root]


def _links(batches, cosine: float):
    """Per bucket or pair of tiles: ``(a, null, held)`` rows, how many vectors
    (with copies) ``a`` is linked with, and ``(a, b, null)`` rows, which join
    what the links join."""
    for table in by_key(batches, 2):
        if table.num_rows < 2:
            continue
        table = table.combine_chunks()
        column = {c: table.column(c).chunk(0) for c in table.column_names}
        reps, copies, tile, labels = (column[c].to_numpy() for c in ("rep", "copies", "tile", "label"))
        sizes = column["unit"].value_lengths().to_numpy()
        flat = column["unit"].flatten().to_numpy()
        keys = column["keys"].flatten().to_numpy().reshape(len(reps), -1)
        first = np.cumsum(sizes) - sizes
        at_table, block, tiles = (int(column[c][0].as_py()) for c in ("t", "block", "tiles"))
        cross = block // tiles != block % tiles
        # one label and width each, but for equal hashes of different ones
        for label, dim in np.unique(np.stack([labels.astype(np.int64), sizes.astype(np.int64)]), axis=1).T:
            own = np.flatnonzero((labels == label) & (sizes == dim))
            units = flat[first[own][:, None] + np.arange(dim)]
            held, root = np.zeros(len(own), np.int64), np.arange(len(own))
            for i, j in _compare(units, keys[own], at_table, tile[own], cross, cosine):
                np.add.at(held, i, copies[own][j])
                np.add.at(held, j, copies[own][i])
                for high, low in _join(root, i, j):
                    yield _link_batch(reps[own][high], reps[own][low], None)
            if (at := np.flatnonzero(held)).size:
                yield _link_batch(reps[own][at], None, held[at])


def _link_batch(a, b, held):
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), none if b is None else pa.array(b, pa.int64()),
                                       none if held is None else pa.array(held, pa.int64())], names=["a", "b", "held"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``(rid, vec_id, n_links, component_id, kept)``, one row per input row.

    Rows of equal labels link if the cosine of their vectors, in doubles, is
    ``cosine`` or more; pairs below never link, and of those just at the
    threshold a share of ``recall`` is expected to be found, of nearer ones
    more. ``n_links`` counts the other rows linked directly, copies too;
    ``component_id`` is the smallest ``vec_id`` reachable (null only if all
    are). A null label, and a vector that is null, empty, zero or holds null
    or non-finite components, links with nothing; vectors of different length
    don't link. Repeated ids are rows of their own.

    Copies of one vector are one representative. Only vectors that share a
    bucket are shuffled with their components; a bucket of more than ``TILE``
    is dealt into tiles and every pair of tiles is compared, so no task holds
    a whole bucket and no pair is lost. A pair counts in the first table that
    has it.
    """
    label = vectors[label_col].cast("long")
    rows = stored_rows(vectors, vectors[id_col].cast("long").alias("vec_id"), label.alias("label"),
                       vectors[vector_col].cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) <= 1.7976931348623157e308)) & F.exists("v", lambda x: x != 0)
    # the hash is compared first, so that most comparisons are of one number
    valid = rows.filter("label is not null").filter(sound).withColumn("h", F.xxhash64("label", "v"))
    same = ["h", "label", "v"]
    reps = materialize(valid.groupBy(*same).agg(F.min("rid").alias("rep"), F.min("vec_id").alias("low"),
                                                F.count("*").alias("copies")), "reps", "zstd")
    step, directions, tables = plan(reps.count(), cosine, recall)
    hashed = materialize(reps.select("rep", "label", "v", "copies").mapInArrow(
        lambda it: _hashed(it, directions, tables, step),
        "rep long, label long, unit array<double>, keys array<long>, copies long"), "hashed", "zstd")
    keyed = hashed.select("rep", F.posexplode("keys").alias("t", "key"))
    held = materialize(keyed.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1"), "held")
    tiles = F.when(F.col("held") <= TILE, 1).otherwise(F.ceil(2 * F.col("held") / TILE)).cast("int")
    member = keyed.join(held, "key").withColumn("tiles", tiles).withColumn(
        "tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    # tile pairs; the half-size tiles make a block of TILE vectors
    block = F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda x: F.least(x, "tile") * F.col("tiles") + F.greatest(x, "tile")))
    member = member.select("rep", "t", "key", "tiles", "tile", F.explode(block).alias("block"))
    met = member.join(hashed, "rep").select("key", "block", "rep", "t", "tiles", "tile", "label", "copies", "unit", "keys") \
        .repartition("key", "block").sortWithinPartitions("key", "block", "rep")
    links = materialize(met.mapInArrow(lambda it: _links(it, cosine), LINK_SCHEMA), "links")
    degree = links.filter("held is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("held").alias("held"))
    groups = connected_components(links.filter("b is not null").select("a", "b"))
    named = reps.join(groups, reps["rep"] == groups["node"], "left").join(degree, "rep", "left").select(
        *same, "low", F.coalesce("root", "rep").alias("root"),
        (F.col("copies") - 1 + F.coalesce("held", F.lit(0))).alias("n_links"))
    named = materialize(named, "named", "zstd")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    found = materialize(named.join(lowest, "root").select(*same, "n_links", "component_id"), "found", "zstd")
    discard(reps, hashed, held, links, named)
    linked = valid.join(found, same).select("rid", "vec_id", "n_links", "component_id")
    rest = rows.filter(~F.coalesce(F.col("label").isNotNull() & sound, F.lit(False))).select(
        "rid", "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def drop_near_vectors(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """The rows of ``vectors`` that stay: those whose id is the smallest of
    their component."""
    kept = near_vectors(vectors, id_col, **options).filter("kept").select(F.col("vec_id").alias("_kept")).distinct()
    return vectors.join(kept, vectors[id_col].cast("long").eqNullSafe(F.col("_kept")), "left_semi")
