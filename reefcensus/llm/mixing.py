"""Mixing sources to target weights (native): hash-threshold histograms.

Every document has a fixed 60-bit hash. Sizes are summed by source and hash
bucket; the bucket in which a source's budget ends is found from the nested
sums, only that bucket is split by the next bits, and a document is taken if
its hash lies below the threshold. Nothing is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reefcensus.operators.clean import number_rows

from .store import materialize, whole_rows, with_row_id

#: hash bits, and the bits that each refinement looks at
HASH_BITS = 60
LEVEL_BITS = 12
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    """Number of words: pieces between separators, less the empty ones that a
    separator at either end leaves. Null and empty text: 0."""
    sep = r"[\x20\x09-\x0D]"
    pieces = F.size(F.split(text, sep + "+"))
    ends = F.substring(text, 1, 1).rlike(sep).cast("int") + F.substring(text, -1, 1).rlike(sep).cast("int")
    return F.when(F.length(text) > 0, pieces - ends).otherwise(0).cast("long")


def doc_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text (null: empty text)."""
    hexed = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15)
    return F.conv(hexed, 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Target per source from ``(source, source_size)``, one row per source.

    Shares are ``level * weight`` with the level at which the shares, each
    capped at ``max_repeat`` times its source, use up the whole size. The
    sources that hit their cap come first in the order of cap / weight, so
    running sums over the sources give the level.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*[F.lit(int(w)) for w in weights])
    s = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(ws, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.col("source_size") * max_repeat)
    order = W.orderBy((F.col("cap") / F.col("weight")), F.col("rank"))
    s = s.withColumn("place", F.row_number().over(order))
    order = W.orderBy("place")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    every = W.partitionBy()
    s = s.select("*", F.sum("source_size").over(every).alias("total"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
                 F.sum("weight").over(rest).alias("open_weight"))
    s = s.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_weight"))
    # the first source in the order whose cap is not below its share ends the capped ones
    free = F.col("level") * F.col("weight") <= F.col("cap")
    s = s.withColumn("final", F.min_by("level", F.when(free, F.col("place"))).over(every))
    target = F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight"))
    return s.select("source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(rid, doc_id, size, source, source_size, target, copies, taken)``,
    one row per input row.

    A document is taken ``floor(target / source_size)`` times, and once more
    below the source's hash threshold; the document at the threshold is taken
    if that brings the sum nearer. Rows with one hash (a repeated id) share
    the threshold: of those at the boundary, the lowest text hashes are taken,
    and of rows with one text as many as come nearest to the target. How many
    of each distinct row are taken depends on nothing else, so reruns agree. Null texts have size 0; a null source is a
    source of its own; sources are few (one row each fits a task), their rows
    are not. An empty table gives no rows.
    """
    rows = with_row_id(docs, docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                       docs[text_col].alias("text"))
    return _mix(rows, weights, max_repeat)


def _mix(texts: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``mix_sources`` of ``(rid, doc_id, source, text)``."""
    base = texts.select("rid", "doc_id", "source", word_count(texts["text"]).alias("size"),
                        doc_hash(texts["doc_id"]).alias("h"), F.xxhash64("text").alias("h2"))
    rows = materialize(base, "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, max_repeat)
    plan = plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("int"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = materialize(plan, "mix-plan")
    # (source, prefix, left): the budget ends inside the hashes that start with prefix
    open_ = plan.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").alias("left"))
    thresholds = None
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = rows if level == 0 else _null_safe(
            rows, open_, F.shiftright(rows["h"], shift + LEVEL_BITS) == open_["prefix"])
        hist = inside.select("source", F.shiftright("h", shift).alias("bucket"), "size") \
            .groupBy("source", "bucket").agg(F.sum("size").alias("tokens"))
        ordered = W.partitionBy("source").orderBy("bucket")
        hist = hist.withColumn("before", F.sum("tokens").over(ordered) - F.col("tokens"))
        at = _null_safe(hist, open_, F.lit(True)).select(
            "source", "bucket", "left", "before", "tokens")
        # the bucket in which the running sum passes the budget
        nxt = at.filter((F.col("before") <= F.col("left")) & (F.col("before") + F.col("tokens") > F.col("left"))) \
            .select("source", F.col("bucket").alias("prefix"), (F.col("left") - F.col("before")).alias("left"))
        open_ = materialize(nxt, f"mix-level{level}")
        thresholds = open_
    # a source whose budget is used up only by all of its rows has no boundary
    edge = thresholds.select("source", F.col("prefix").alias("edge"), "left")
    tie = _null_safe(rows, edge, rows["h"] == edge["edge"]).groupBy("source", "h2") \
        .agg(F.sum("size").alias("tokens"))
    tie = tie.withColumn("before", F.sum("tokens").over(W.partitionBy("source").orderBy("h2")) - F.col("tokens"))
    tie = _null_safe(tie, edge, F.lit(True)).select("source", "h2", "before", "tokens", "left")
    # what fits of the rows with one hash and text
    fits = F.greatest(F.least(F.col("left") - F.col("before"), F.col("tokens")), F.lit(0))
    tie = tie.select(F.col("source").alias("t_source"), F.col("h2").alias("t_h2"), fits.cast("double").alias("fits"))
    p = plan.select(F.col("source").alias("p_source"), "source_size", "target", "whole", "budget")
    e = edge.select(F.col("source").alias("e_source"), "edge")
    out = rows.join(p, rows["source"].eqNullSafe(p["p_source"])) \
        .join(e, rows["source"].eqNullSafe(e["e_source"]), "left") \
        .join(tie, rows["source"].eqNullSafe(tie["t_source"]) & (rows["h"] == e["edge"])
              & (rows["h2"].eqNullSafe(tie["t_h2"])), "left")
    at_edge = F.coalesce((F.col("budget") > 0) & (F.col("h") == F.col("edge")), F.lit(False))
    extra = F.when(F.col("budget") <= 0, 0).when(F.col("edge").isNull(), 1).when(F.col("h") < F.col("edge"), 1).otherwise(0)
    # rows alike are counted off: as many as come nearest, whichever they are
    tied = number_rows(out.filter(at_edge), ["source", "h2"], "rid", "place")
    nearer = (F.col("place") + 0.5) * F.col("size") <= F.col("fits")
    out = out.filter(~at_edge).withColumn("extra", extra).unionByName(
        tied.withColumn("extra", (nearer & (F.col("size") > 0)).cast("int")).drop("place"))
    copies = F.least(F.col("whole") + F.col("extra"), F.lit(int(max_repeat)))
    return out.select("rid", "doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).cast("long").alias("taken"))


def _null_safe(left: DataFrame, right: DataFrame, extra: Column) -> DataFrame:
    """Inner join on ``source``, nulls alike; keeps the left one's source."""
    r = right.withColumnRenamed("source", "r_source")
    return left.join(r, left["source"].eqNullSafe(r["r_source"]) & extra).drop("r_source")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    whole = whole_rows(docs)
    rows = whole.select("rid", *[F.col(f"row.`{c}`").alias(name) for c, name in
                                 ((id_col, "doc_id"), (source_col, "source"), (text_col, "text"))])
    mix = _mix(rows, **options).filter("copies > 0").select("rid", "copies")
    return whole.join(mix, "rid").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
