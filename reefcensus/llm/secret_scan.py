"""Secret scans (native): fixed patterns, and a battery of randomness tests
for strings that no pattern names.

A candidate's encoding is inferred from its characters. Chi-squared
uniformity over the alphabet, the number of runs and the lag-1 serial
correlation are tested and combined; then the likelihood ratio of a random
string against text of that length gives a p-value, and the false-discovery
rate over all candidates is controlled with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import materialize, with_row_id

#: fixed patterns of the base kinds: prefix and value of the first
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"(AKIA[A-Z0-9]{12,})"
HEX = r"([0-9a-f]{32,})"
ASSIGN_MIN = 8
#: a candidate has this many characters, with letters and digits among them
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
KINDS = ("assign", "access", "hex", "random")
#: a battery below this p-value is not random; false discoveries among the added
BATTERY_ALPHA = 0.001
FALSE_DISCOVERIES = 0.01
#: share of neighbours of one character class in text
TEXT_SAME_CLASS = 0.9
MARK, OTHER_MARK = "\ue000", "\ue001"


def _marked(text: Column, pattern: str, groups: int) -> Column:
    """Pieces of a text around all matches: gap, group 1, .., gap, .."""
    put = MARK + "".join(f"${g + 1}{MARK}" for g in range(groups))
    return F.split(F.regexp_replace(text, pattern, put), MARK, -1)


def _spans(text: Column, pattern: str, kind: str, groups: int = 1, least: int = 0) -> Column:
    """Array of ``(start, end, kind, value)`` of a pattern's matches, in code
    points. Matches run from left to right and do not overlap; those whose
    last group is shorter than ``least`` go."""
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")
    step = groups + 1

    def add(state: Column, k: Column) -> Column:
        """state: place after match k - 1, and the spans so far."""
        pieces = state["pieces"]
        start = state["at"] + F.length(F.element_at(pieces, k * step + 1))
        end = start
        for g in range(groups):
            end = end + F.length(F.element_at(pieces, k * step + 2 + g))
        value = F.element_at(pieces, k * step + 1 + groups)
        one = F.array(F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
                               value.alias("value")))
        return F.struct(pieces.alias("pieces"), end.alias("at"),
                        F.concat(state["out"], F.when(F.length(value) >= least, one).otherwise(empty)).alias("out"))

    pieces = _marked(text, pattern, groups)
    count = F.floor((F.size(pieces) - 1) / F.lit(step)).cast("int")
    start = F.struct(pieces.alias("pieces"), F.lit(0).alias("at"), empty.alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        start, add, lambda s: s["out"])).otherwise(empty)


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * F.exp(-z * z / 2) * 0.3989422804014327
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _battery(found: DataFrame) -> DataFrame:
    """p-values per candidate ``(value)``: ``p_random`` of the battery, and
    ``log_p_text``, the natural log of the bound for text."""
    value = F.col("value")
    size = F.when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), 16).when(value.rlike("^[A-Z2-7]+=*$"), 32) \
        .when(value.rlike("^[A-Za-z0-9]+$"), 62).otherwise(64)
    alphabets = F.when(F.col("k") == 16, F.lit("0123456789abcdef")) \
        .when(F.col("k") == 32, F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")) \
        .otherwise(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    body = F.rtrim(F.translate("value", "_-", "/+"), F.lit("="))
    df = found.withColumn("k", size)
    df = df.withColumn("body", F.when(F.col("k") == 16, F.lower(body)).otherwise(body))
    df = df.withColumn("n", F.length("body").cast("double")).filter("n > 2")
    df = df.withColumn("chars", F.filter(F.split("body", ""), lambda c: c != ""))
    df = df.withColumn("codes", F.transform("chars", lambda c: F.instr(alphabets, c).cast("double")))
    # chi-squared over the alphabet: sum of squared counts is the sum over the characters of their count
    squares = F.aggregate(F.array_distinct("chars"), F.lit(0.0), lambda s, c: s + F.pow(
        F.col("n") - F.length(F.replace("body", c, F.lit(""))), F.lit(2)))
    chi = squares * F.col("k") / F.col("n") - F.col("n")
    df = df.withColumn("z_chi", (chi - (F.col("k") - 1)) / F.sqrt(2 * (F.col("k") - 1) * (1 - 1 / F.col("n"))))
    middle = F.col("k") / 2 + 0.5
    pairs = F.arrays_zip(F.slice("codes", 1, F.size("codes") - 1).alias("a"),
                         F.slice("codes", 2, F.size("codes") - 1).alias("b"))
    df = df.withColumn("pairs", pairs)
    high = F.size(F.filter("codes", lambda c: c > middle)).cast("double")
    df = df.withColumn("n1", high).withColumn("n2", F.col("n") - high)
    runs = 1 + F.size(F.filter("pairs", lambda p: (p["a"] > middle) != (p["b"] > middle)))
    mean = 1 + 2 * F.col("n1") * F.col("n2") / F.col("n")
    var = (mean - 1) * (mean - 2) / (F.col("n") - 1)
    df = df.withColumn("z_runs", F.when(var > 0, (runs - mean) / F.sqrt(var)).otherwise(F.lit(9.0)))
    centre = (F.col("k") + 1) / F.lit(2.0)
    spread = (F.col("k") * F.col("k") - 1) / F.lit(12.0)
    serial = F.aggregate("pairs", F.lit(0.0), lambda s, p: s + (p["a"] - centre) * (p["b"] - centre))
    df = df.withColumn("z_serial", serial / spread / F.sqrt(F.col("n") - 1))
    p = [_normal_tail(F.col("z_chi"))] + [2 * _normal_tail(F.abs(F.col(z))) for z in ("z_runs", "z_serial")]
    x = sum((-F.log(F.greatest(q, F.lit(1e-300))) for q in p), F.lit(0.0))
    df = df.withColumn("x", x)  # half of Fisher's statistic, six degrees of freedom
    p_random = F.exp(-F.col("x")) * (1 + F.col("x") + F.col("x") * F.col("x") / 2)
    # neighbours of one class: rare in a random string, usual in text
    same_class = F.when(F.col("k") == 16, (10 / 16) ** 2 + (6 / 16) ** 2) \
        .when(F.col("k") == 32, (26 / 32) ** 2 + (6 / 32) ** 2) \
        .when(F.col("k") == 62, 2 * (26 / 62) ** 2 + (10 / 62) ** 2) \
        .otherwise(2 * (26 / 64) ** 2 + (10 / 64) ** 2 + (2 / 64) ** 2)
    kind = F.translate("body", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
                       "A" * 26 + "a" * 26 + "0" * 10 + "++")
    df = df.withColumn("same", same_class).withColumn("class", kind)
    switches = F.length(F.regexp_replace("class", r"(.)\1+", "$1")) - 1
    ratio = (F.col("n") - 1 - switches) * F.log(F.col("same") / TEXT_SAME_CLASS) \
        + switches * F.log((1 - F.col("same")) / (1 - TEXT_SAME_CLASS))
    return df.select("rid", "start", "end", p_random.alias("p_random"), F.least(-ratio, F.lit(0.0)).alias("log_p_text"))


def _discoveries(tested: DataFrame) -> DataFrame:
    """Candidates with a random battery whose text p-values pass the step-up
    rule over all candidates, in steps of a tenth of a decade (rounded to the
    larger p-value)."""
    step = F.floor(F.least(-F.col("log_p_text") / F.log(F.lit(10.0)), F.lit(300.0)) * 10).cast("int")
    tested = tested.withColumn("step", step)
    hist = tested.groupBy("step").agg(F.count("*").alias("n"))
    hist = hist.withColumn("at_least", F.sum("n").over(W.orderBy(F.col("step").desc()))) \
        .withColumn("all", F.sum("n").over(W.partitionBy()))
    passing = hist.filter(F.pow(F.lit(10.0), -F.col("step") / 10)
                          <= FALSE_DISCOVERIES * F.col("at_least") / F.col("all"))
    least = passing.agg(F.min("step")).first()[0]
    return tested.filter(F.lit(False) if least is None else
                         (F.col("step") >= least) & (F.col("p_random") >= BATTERY_ALPHA))


def _listed(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans)``,
    one row per input row.

    The base kinds are matched from left to right, each on its own; places
    are code points, ends exclusive. The method adds spans of kind ``random``
    for candidates that overlap no base span. A candidate (``CANDIDATE``) is a
    run of 20 or more characters of the encodings with a letter and a digit:
    shorter runs, and runs of letters alone, are not tested, as the battery
    cannot tell those from words. Null texts have no spans.
    Texts are read once and not shuffled; candidates (few) are.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, OTHER_MARK)
    rows = with_row_id(docs, docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")) \
        .withColumn("text", text)
    word = F.col("text")
    found = rows.select(
        "rid", "doc_id", _spans(word, ASSIGN, "assign", 2, ASSIGN_MIN).alias("assign"),
        _spans(word, ACCESS, "access").alias("access"), _spans(word, HEX, "hex").alias("hex"),
        F.filter(_spans(word, CANDIDATE, "random"), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
        .alias("candidates"))
    bare = "array<struct<start:int,end:int,kind:int>>"
    base = F.sort_array(F.concat(*[F.transform(k, lambda s: F.struct(s["start"], s["kind"], s["end"]))
                                   for k in ("assign", "access", "hex")]))
    base = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                s["kind"].alias("kind"))).cast(bare)
    found = found.select("rid", "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                         base.alias("base"), "candidates")
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"])
                                                      & (c["start"] < b["end"])))
    found = materialize(found.withColumn("candidates", free), "secrets")
    single = found.select("rid", F.explode("candidates").alias("c")).select("rid", "c.start", "c.end", "c.value")
    tested = materialize(_battery(single), "battery")
    added = _discoveries(tested).groupBy("rid").agg(F.collect_list(F.struct(
        "start", "end", F.lit(KINDS.index("random")).alias("kind"))).alias("added"))
    out = found.drop("candidates").join(added, "rid", "left") \
        .withColumn("added", F.coalesce(F.col("added").cast(bare), F.array().cast(bare)))
    every = F.transform(F.sort_array(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"], s["kind"], s["end"]))), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.size("added").cast("long").alias("n_random"),
                      F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _listed(every).alias("spans"))
