"""Quality rules: hard base rules, then a robust multivariate outlier test.

Base rules fail a text with fewer than 10 words, or with more than 20 % of its
words in 5-word windows that the text holds twice or more. Every text that
passes them becomes a vector of four transformed statistics: mean word length,
share of symbols, share of short words, variety of words. Per language and
source the minimum-covariance-determinant (MCD) estimate of their centre and
scatter is found by concentration steps from three starts (the medians, and
either half of the group by a seeded hash), of which the one that ends with the
least determinant counts; a text whose squared Mahalanobis distance exceeds the
cut-off is rejected.

Scatter comes from the data. To the scatter of a group is added the pooled
one, the corpus-wide median deviation from the groups' medians, which keeps
small groups and those of equal texts from rejecting what is ordinary elsewhere.

Everything is DataFrame functions: windows are hashed inside the row, the
concentration steps aggregate moments per distance bin, and the 4x4 Cholesky
factor is unrolled into column expressions. Statistics are fixed-point
integers summed as decimals, so the estimates do not depend on the
partitioning.

Defined results: a null text has no words (and fails the base rules); null
languages and sources form groups of their own; repeated rows count as often
as they occur; an empty table gives an empty result; input columns may have
any names, as helpers live beside the packed row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fenced, key_part, pack, settled, small, spaced, unpack

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Fixed-point scale of the statistics.
SCALE = 10_000
DIMS = ("x1", "x2", "x3", "x4")
#: Words of at most this many code points are short.
SHORT = 3
#: Deviation that is added where the corpus shows none, a fixed-point unit or so.
LEAST = 0.001
#: Share of a group that the MCD subset holds.
SUPPORT = 0.75
#: Rejection cut-off; of normal data one vector in 20 million is beyond it.
CUTOFF = 40.0
#: Concentration steps after each start, and the seed of the halves.
STEPS, SEED = 4, 6
#: Distance bins per factor of two.
BINS = 16
#: Pseudo-counts that damp the statistics of short texts.
PRIOR_WORDS, PRIOR_LENGTH, PRIOR_SYMBOLS, PRIOR_SHORT = 50, 5.0, 0.5, 10

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _repeat_words(keys: Column, sorted_keys: Column) -> Column:
    """Words covered by windows whose key occurs twice; ``sorted_keys`` null: none do."""
    n = F.size(sorted_keys)
    same = lambda a, b: a["k"] == b["k"]
    twice = F.filter(
        sorted_keys,
        lambda x, j: ((j > 0) & same(F.get(sorted_keys, j - 1), x))
        | ((j < n - 1) & same(F.get(sorted_keys, j + 1), x)),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return F.coalesce(covered, F.lit(0))


def with_base(packed: DataFrame) -> DataFrame:
    """Add the base statistics of column ``text`` to a packed frame."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = text
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    keys = F.when(
        F.size("w") >= WINDOW,
        F.transform(
            F.slice("w", 1, F.size("w") - WINDOW + 1),
            lambda h, i: F.xxhash64(h, *[F.get(F.col("w"), i + k) for k in range(1, WINDOW)])),
    )
    pairs = F.sort_array(F.transform(
        F.col("keys"), lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    counted = (
        packed
        .withColumn("spaced", spaced(F.col("text")))
        .withColumn("w", F.array_remove(F.split("spaced", " "), ""))
        .withColumn("word_chars", F.char_length(
            F.replace(F.col("spaced"), F.lit(" "), F.lit(""))).cast("long"))
        .drop("spaced")
        .withColumn("n_symbols", F.when(
            text.rlike(f"[{SYMBOLS}]"), F.char_length(text) - F.char_length(bare))
            .otherwise(0).cast("long"))
        .withColumn("lines", lines)
        .withColumn("n_dup_lines", (
            F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
        .drop("lines")
        .withColumn("n_words", F.size("w").cast("long"))
        .withColumn("n_short", F.size(F.filter("w", lambda x: F.char_length(x) <= SHORT)))
        .withColumn("w", F.transform("w", lambda x: F.xxhash64(x)))
        .withColumn("n_distinct", F.size(F.array_distinct("w")))
        .withColumn("keys", keys)
        .drop("w")
        .withColumn("pairs", F.when(
            F.size(F.array_distinct("keys")) < F.size("keys"), pairs))
        .withColumn("n_repeat_words", _repeat_words(F.col("keys"), F.col("pairs")).cast("long"))
        .drop("keys", "pairs")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                    | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    )
    return fenced(counted, packed.columns, (*BASE, "n_short", "n_distinct"))


def with_vector(base: DataFrame) -> DataFrame:
    """Add the transformed statistics as fixed-point integers."""
    n, c = F.col("n_words"), F.col("word_chars")
    raw = (
        F.log((c + PRIOR_WORDS * PRIOR_LENGTH) / (n + PRIOR_WORDS)),
        F.sqrt((F.col("n_symbols") + PRIOR_SYMBOLS) / (c + PRIOR_WORDS)),
        (F.col("n_short") + PRIOR_SHORT) / (n + PRIOR_WORDS),
        F.log((F.col("n_distinct") + PRIOR_WORDS) / (n + PRIOR_WORDS))
        / F.log((n + 2 * PRIOR_WORDS) / PRIOR_WORDS),
    )
    return base.withColumns(
        {d: F.round(x * SCALE).cast("long") for d, x in zip(DIMS, raw, strict=True)})


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(DIMS)) for j in range(i + 1)]


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance by forward substitution through the Cholesky factor."""
    y: list[Column] = []
    for i, d in enumerate(DIMS):
        rest = F.col(d) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _factor(frame: DataFrame, factor: float, floors: list[float]) -> DataFrame:
    """Centre and Cholesky factor from the moments ``n``, ``s{i}`` and ``p{i}{j}``."""
    n = F.col("n").cast("double")
    out = frame.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(len(DIMS))})
    cov = {}
    for i, j in _pairs():
        c = (F.col(f"p{i}{j}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")) * F.lit(factor)
        cov[f"c{i}{j}"] = F.greatest(c, F.lit(0.0)) + floors[i] ** 2 if i == j else c
    out = out.withColumns(cov)
    for i, j in _pairs():  # one column at a time, each from the ones before
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        least = floors[i] / 10  # rounding only: with the floors the matrix is positive definite
        out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(least * least)))
                             if i == j else rest / F.col(f"l{j}{j}"))
    return out.select("g_lang", "g_source", "start", *[f"m{i}" for i in range(len(DIMS))],
                      *[f"l{i}{j}" for i, j in _pairs()])


def _moments() -> list[Column]:
    wide = lambda c: c.cast("decimal(18,0)")
    return [F.count("*").alias("n"), *[F.sum(d).alias(f"s{i}") for i, d in enumerate(DIMS)],
            *[F.sum(wide(F.col(DIMS[i]) * F.col(DIMS[j]))).alias(f"p{i}{j}") for i, j in _pairs()]]


def _consistency() -> float:
    """Factor that makes the MCD scatter of normal data unbiased (4 dimensions)."""
    lo, hi = 0.0, 100.0
    for _ in range(100):
        q = (lo + hi) / 2
        lo, hi = (q, hi) if 1 - math.exp(-q / 2) * (1 + q / 2) < SUPPORT else (lo, q)
    return SUPPORT / (1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8))


GROUP = ["g_lang", "g_source"]


def _medians(rows: DataFrame, *by: str) -> DataFrame:
    """Median of ``x`` per ``by``. Values are fixed-point, so counting per value keeps it
    exact; the counts are summed before the shuffle."""
    at = Window.partitionBy(*by).orderBy("x")
    return (
        rows.groupBy(*by, "x").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(at))
        .withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
        .where(2 * F.col("upto") >= F.col("all"))
        .groupBy(*by).agg(F.min("x").alias("med"))
    )


def _starts(vectors: DataFrame, factor: float) -> tuple[DataFrame, list[float]]:
    """``(params, floors)``: per group the three starts, and the pooled deviations.

    Start 0 has the coordinates' medians and uncorrelated deviations, starts 1 and 2
    the moments of either half of the group.
    """
    long = vectors.select(*GROUP, F.posexplode(F.array(*DIMS)).alias("dim", "x"))
    centre = settled(_medians(long, *GROUP, "dim"))
    away = (long.join(small(centre), [*GROUP, "dim"])
            .select(*GROUP, "dim", F.abs(F.col("x") - F.col("med")).alias("x")))
    pooled = {r["dim"]: r["med"] for r in _medians(away, "dim").collect()}  # a number a statistic
    floors = [1.4826 * pooled.get(i, 0) + LEAST * SCALE for i in range(len(DIMS))]
    spread = _medians(away, *GROUP, "dim").withColumnRenamed("med", "mad")
    pick = lambda c, i: F.max(F.when(F.col("dim") == i, F.col(c))).cast("double")
    first = centre.join(spread, [*GROUP, "dim"]).groupBy(*GROUP).agg(
        *[pick("med", i).alias(f"m{i}") for i in range(len(DIMS))],
        *[pick("mad", i).alias(f"d{i}") for i in range(len(DIMS))],
    ).withColumn("start", F.lit(0)).withColumns({
        f"l{i}{j}": F.hypot(F.col(f"d{i}") * 1.4826, F.lit(floors[i])) if i == j else F.lit(0.0)
        for i, j in _pairs()}).drop(*[f"d{i}" for i in range(len(DIMS))])
    half = (F.pmod(F.xxhash64(F.lit(SEED), *DIMS), F.lit(2)) + 1).cast("int")
    halves = vectors.withColumn("start", half).groupBy(*GROUP, "start").agg(*_moments())
    return first.unionByName(_factor(halves, factor, floors)), floors


def _concentrate(vectors: DataFrame, params: DataFrame, factor: float,
                 floors: list[float]) -> DataFrame:
    """One C-step: moments of the closest ``SUPPORT`` of each group, for every start.

    Moments are summed per distance bin in one pass, then the bins up to the
    one that reaches the support are added up, so no group is collected or
    sorted by distance.
    """
    g = [*GROUP, "start"]
    bin_ = F.floor(F.log2(F.greatest(_distance(), F.lit(1e-6))) * BINS).cast("int")
    binned = (vectors.join(small(params), GROUP).withColumn("bin", bin_)
              .groupBy(*g, "bin").agg(*_moments()))
    by = Window.partitionBy(*g)
    inner = (
        binned
        .withColumn("before", F.sum("n").over(by.orderBy("bin")) - F.col("n"))
        .withColumn("all", F.sum("n").over(by))
        .where(F.col("before") < F.ceil(F.col("all") * SUPPORT))
    )
    names = ["n", *[f"s{i}" for i in range(len(DIMS))], *[f"p{i}{j}" for i, j in _pairs()]]
    return _factor(inner.groupBy(*g).agg(*[F.sum(c).alias(c) for c in names]), factor, floors)


def estimate(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """MCD centre and Cholesky factor per ``(g_lang, g_source)``: one small row a group."""
    factor = _consistency()
    params, floors = _starts(vectors, factor)
    params = settled(params)
    for _ in range(steps):
        params = settled(_concentrate(vectors, params, factor, floors))
    volume = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, len(DIMS))), F.log("l00"))
    rest = [c for c in params.columns if c not in GROUP]
    least = F.min_by(F.struct(*rest), F.struct(F.round(volume, 9).alias("volume"), "start"))
    return settled(params.groupBy(*GROUP).agg(least.alias("p")).select(*GROUP, "p.*").drop("start"))


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    packed = pack(docs, text=text, lang=lang, source=source)
    return with_vector(with_base(packed)).withColumns(
        {"g_lang": key_part("lang"), "g_source": key_part("source")})


def _verdict(rows: DataFrame, params: DataFrame, cutoff: float) -> DataFrame:
    out = rows.join(small(params), ["g_lang", "g_source"], "left")
    kept = ~F.col("base_failed") & (F.coalesce(_distance(), F.lit(0.0)) <= cutoff)
    return out.withColumn("distance2", _distance()).withColumn("kept", kept)


def quality_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   lang: str = "lang", source: str = "source",
                   cutoff: float = CUTOFF) -> DataFrame:
    """One row per input row: id, base statistics, Mahalanobis distance and verdict."""
    rows = settled(_rows(docs, text, lang, source).select(
        F.col("row").getField(doc_id).alias("doc_id"), *BASE, "g_lang", "g_source", *DIMS))
    params = estimate(rows.where(~F.col("base_failed")))
    return _verdict(rows, params, cutoff).select("doc_id", *BASE, "kept", "distance2")


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """The rows that pass the base rules and the outlier test, columns unchanged.

    The statistics are computed once for the estimates (kept as four integers
    a text) and once more beside the rows, which is cheaper than moving texts.
    """
    rows = _rows(docs, text, lang, source)
    vectors = settled(rows.where(~F.col("base_failed")).select("g_lang", "g_source", *DIMS))
    return unpack(_verdict(rows, estimate(vectors), cutoff).where("kept"), docs.columns)
