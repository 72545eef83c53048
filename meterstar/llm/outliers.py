"""Quality rules: text statistics, and robust multivariate outliers among them.

Everything here is built-in column functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterstar.llm.inputs import picked
from meterstar.session import materialise

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

DIMENSIONS = 5
SPARSE = (2, 3, 4)      # symbols, repeated lines, repeated phrases: most documents have none
HALF = 0.75             # share of a group that the covariance is minimised over
STARTS = 3              # first estimates that the search begins from
MOST_STEPS = 30         # concentration steps, if the determinants keep falling
FIRST_STEPS = 2         # steps of every start; then each group's best start goes on alone
LEAST_FALL = 1e-2       # a mean log determinant that falls by less has stopped: about what the bins resolve
PRIOR_ROWS = 50.0       # weight of all groups together in each group's estimate
CONFIDENCE = 0.9999     # of the chi-squared cut
_BINS = 64              # per unit, for medians of statistics and of log distances


def chi_squared(x: float, dimensions: int) -> float:
    """Distribution function for an odd number of dimensions."""
    out = math.erf(math.sqrt(x / 2))
    for k in range(1, dimensions, 2):
        out -= (x / 2) ** (k / 2) * math.exp(-x / 2) / math.gamma(k / 2 + 1)
    return out


def chi_squared_quantile(p: float, dimensions: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_squared(mid, dimensions) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float = HALF, dimensions: int = DIMENSIONS) -> float:
    """What the covariance of the inner ``share`` of normal rows must be multiplied by."""
    return share / chi_squared(chi_squared_quantile(share, dimensions), dimensions + 2)


def text_statistics(rows: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` to rows with ``text``; drops the text.

    Repeated phrases are found within each row: its 3-word windows are hashed,
    sorted and compared with their neighbours, so the work is n log n in the words.
    """
    body = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(NOT_BLANK)))
    rows = rows.withColumn("_words", F.filter(F.split(body, BLANK), lambda w: w != ""))
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("bigint"), "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOL)).cast("bigint"), "_lines": lines,
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_words", "text")
    second = F.slice("_hashes", F.lit(2), F.greatest(F.size("_hashes") - 1, F.lit(0)))
    third = F.slice("_hashes", F.lit(3), F.greatest(F.size("_hashes") - 2, F.lit(0)))
    pairs = F.zip_with("_hashes", second, lambda a, b: F.xxhash64(a, b))
    phrases = F.slice(F.zip_with(pairs, third, lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.size("_hashes") - 2, F.lit(0)))
    rows = rows.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_phrases": F.sort_array(F.transform(phrases, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    }).drop("_lines", "_hashes")
    later = F.slice("_phrases", F.lit(2), F.greatest(F.size("_phrases") - 1, F.lit(0)))
    again = F.zip_with("_phrases", later, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    rows = rows.withColumn("_at", F.sort_array(F.array_distinct(F.flatten(F.filter(again, lambda x: x.isNotNull()))))).drop("_phrases")
    after = F.slice("_at", F.lit(2), F.greatest(F.size("_at") - 1, F.lit(0)))
    steps = F.zip_with("_at", after, lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3)))
    return rows.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0), lambda s, x: s + x).cast("bigint")).drop("_at")


def transformed(prefix: str = "_x") -> dict[str, Column]:
    """The statistics on scales where documents of any length compare."""
    words = F.greatest("n_words", F.lit(1)).cast("double")
    values = [F.log1p("n_words"), F.log1p(F.col("word_chars") / words), F.log1p(100.0 * F.col("n_symbols") / words),
              F.log1p("n_dup_lines"), F.log1p(100.0 * F.col("n_repeat_words") / words)]
    return {f"{prefix}{i}": v.cast("double") for i, v in enumerate(values)}


def _same_group(left: str = "", right: str = "_g") -> Column:
    return F.col(f"{left}lang").eqNullSafe(F.col(f"{right}lang")) & F.col(f"{left}source").eqNullSafe(F.col(f"{right}source"))


def _grouped(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"lang": "_glang", "source": "_gsource"})


def _place_at(counts: DataFrame, by: list[str], share: float, name: str) -> DataFrame:
    """Per group, the least bin that holds at least ``share`` of the rows: ``counts`` has ``by``, ``bin`` and ``n``."""
    upto = F.sum("n").over(W.partitionBy(*by).orderBy("bin"))
    total = F.sum("n").over(W.partitionBy(*by))
    return counts.select(*by, "bin", (upto >= F.ceil(F.lit(share) * total)).alias("_in")).where("_in").groupBy(*by).agg(F.min("bin").alias(name))


def _inverse_root(moments: DataFrame, scale: float, least: list[float]) -> DataFrame:
    """Location ``_m*``, inverse Cholesky factor ``_l*_*`` and log determinant per group and start from ``_n``, sums ``_s*`` and ``_s*_*``.

    No variance is below the square of ``least``: raising a diagonal keeps a covariance positive.
    """
    d = range(DIMENSIONS)
    out = moments.withColumns({f"_m{i}": F.col(f"_s{i}") / F.col("_n") for i in d})
    for i in d:
        for j in range(i + 1):
            cov = (F.col(f"_s{i}_{j}") / F.col("_n") - F.col(f"_m{i}") * F.col(f"_m{j}")) * scale
            rest = reduce(lambda a, b: a + b, [F.col(f"_c{i}_{k}") * F.col(f"_c{j}_{k}") for k in range(j)], F.lit(0.0))
            if i == j:
                # Rounding may leave less than the least residual variance, never less than a thousandth of the least one.
                out = out.withColumn(f"_c{i}_{i}", F.sqrt(F.greatest(F.greatest(cov, F.lit(least[i] ** 2)) - rest, F.lit(least[i] ** 2 / 1000))))
            else:
                out = out.withColumn(f"_c{i}_{j}", (cov - rest) / F.col(f"_c{j}_{j}"))
    for j in d:
        for i in range(j, DIMENSIONS):
            if i == j:
                out = out.withColumn(f"_l{i}_{i}", 1.0 / F.col(f"_c{i}_{i}"))
            else:
                rest = reduce(lambda a, b: a + b, [F.col(f"_c{i}_{k}") * F.col(f"_l{k}_{j}") for k in range(j, i)])
                out = out.withColumn(f"_l{i}_{j}", -rest / F.col(f"_c{i}_{i}"))
    size = reduce(lambda a, b: a + b, [2 * F.log(f"_c{i}_{i}") for i in d])
    return out.select("_glang", "_gsource", "_start", "_n", size.alias("_det"), *_estimate())


def _estimate() -> list[str]:
    d = range(DIMENSIONS)
    return [f"_m{i}" for i in d] + [f"_l{i}_{j}" for i in d for j in range(i + 1)]


def _distance() -> Column:
    """Squared Mahalanobis distance of ``_x*`` under the joined estimate."""
    parts = [
        reduce(lambda a, b: a + b, [F.col(f"_l{i}_{j}") * (F.col(f"_x{j}") - F.col(f"_m{j}")) for j in range(i + 1)])
        for i in range(DIMENSIONS)
    ]
    return reduce(lambda a, b: a + b, [p * p for p in parts])


def _counted(rows: DataFrame) -> DataFrame:
    """``lang, source, dim, bin, n``: how many rows of a group have a statistic in each bin; exactly 0 is bin -1."""
    bins = [F.when(F.col(f"_x{i}") == 0, F.lit(-1)).otherwise(F.floor(F.col(f"_x{i}") * _BINS)).cast("bigint") for i in range(DIMENSIONS)]
    cells = rows.select("lang", "source", F.posexplode(F.array(*bins)).alias("dim", "bin"))
    return cells.groupBy("lang", "source", "dim", "bin").agg(F.count(F.lit(1)).alias("n"))


def _least_spreads(counts: DataFrame) -> list[float] | None:
    """The least standard deviation of each statistic, from the data; None without rows.

    It is what one more word, character, symbol, repeated line or repeated word changes in a document of the median
    length. Where most documents have none of something, the nearest rows can't show how it spreads among those that have some:
    there it is at least the median deviation, as a normal's, of all groups' non-zero values from their median.
    """
    pooled = materialise(counts.where("dim = 0 OR bin >= 0").groupBy("dim", "bin").agg(F.sum("n").alias("n")))
    middle = materialise(_place_at(pooled, ["dim"], 0.5, "mid"))
    apart = pooled.join(middle, "dim").select("dim", F.abs(F.col("bin") - F.col("mid")).alias("bin"), "n")
    spread = _place_at(apart.groupBy("dim", "bin").agg(F.sum("n").alias("n")), ["dim"], 0.5, "mad")
    found = {r["dim"]: r for r in middle.join(spread, "dim").collect()}  # a row per statistic
    if 0 not in found:
        return None
    words = math.expm1((found[0]["mid"] + 0.5) / _BINS)
    chars = math.expm1((found[1]["mid"] + 0.5) / _BINS)
    unit = [1 / (1 + words), 1 / (words * (1 + chars)), math.log1p(100 / words), math.log1p(1), math.log1p(100 / words)]
    mad = [1.4826 * found[i]["mad"] / _BINS if i in SPARSE and i in found else 0.0 for i in range(DIMENSIONS)]
    return [max(u, m, 1 / _BINS) for u, m in zip(unit, mad)]


def _starts(rows: DataFrame, counts: DataFrame, least: list[float]) -> DataFrame:
    """First estimates per group: medians with quartile ranges as independent spreads, medians with the
    least spreads, and the mean and covariance of all rows."""
    by = ["lang", "source", "dim"]
    window = W.partitionBy(*by)
    upto, total = F.sum("n").over(window.orderBy("bin")), F.sum("n").over(window)
    reached = lambda p: F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col("bin")))
    joined = counts.withColumns({"upto": upto, "total": total}).groupBy(*by).agg(
        reached(0.25).alias("low"), reached(0.5).alias("mid"), reached(0.75).alias("high"))
    d = range(DIMENSIONS)
    at = lambda name, i: F.max(F.when(F.col("dim") == i, F.col(name)))
    spread = lambda i: (at("high", i) - at("low", i)) / (_BINS * 1.349)  # noqa: E731  a normal's quartile range
    middles = [(F.greatest(at("mid", i) + 0.5, F.lit(0)) / _BINS).alias(f"_m{i}") for i in d]

    def independent(number: int, spreads: list[Column]) -> DataFrame:
        lower = [(1.0 / spreads[i] if i == j else F.lit(0.0)).alias(f"_l{i}_{j}") for i in d for j in range(i + 1)]
        size = reduce(lambda a, b: a + b, [2 * F.log(s) for s in spreads])
        found = _grouped(joined.groupBy("lang", "source").agg(*middles, *lower, size.alias("_det")))
        return found.select("_glang", "_gsource", F.lit(number).alias("_start"), F.lit(0.0).alias("_n"), "_det", *_estimate())

    whole = _grouped(_moments(rows.withColumn("_start", F.lit(2))))
    return independent(0, [F.greatest(spread(i), F.lit(least[i])) for i in d]).unionByName(
        independent(1, [F.max(F.lit(x)) for x in least])).unionByName(_inverse_root(whole, 1.0, least))


def _moments(rows: DataFrame) -> DataFrame:
    d = range(DIMENSIONS)
    return rows.groupBy("lang", "source", "_start").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), *[F.sum(f"_x{i}").alias(f"_s{i}") for i in d],
        *[F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_s{i}_{j}") for i in d for j in range(i + 1)])


def _concentrated(rows: DataFrame, fit: DataFrame, least: list[float]) -> DataFrame:
    """One step of every start: the covariance of each group's nearest rows under the last estimate."""
    near = rows.join(fit, _same_group()).withColumn("bin", F.floor(F.log1p(_distance()) * _BINS)).select(
        "lang", "source", "_start", "bin", *[f"_x{i}" for i in range(DIMENSIONS)])
    by = ["lang", "source", "_start"]
    counts = near.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"))
    edges = _grouped(materialise(_place_at(counts, by, HALF, "_edge"))).withColumnRenamed("_start", "_of")
    inner = near.join(edges, _same_group() & (F.col("_start") == F.col("_of"))).where("bin <= _edge")
    sums = materialise(_grouped(_moments(inner)))
    names = [c for c in sums.columns if c.startswith("_s") and c != "_start" or c == "_n"]
    # One prior for all starts: they come to nearly the same rows.
    pooled = sums.agg(*[(F.sum(c) * PRIOR_ROWS / F.sum("_n")).alias(c) for c in names]).first()
    return materialise(_inverse_root(sums.withColumns({c: F.col(c) + F.lit(pooled[c]) for c in names}), consistency(), least))


def _fitted(sound: DataFrame) -> DataFrame:
    """Per group the estimate with the least determinant that any start leads to.

    All starts take a few steps, and the best of each group goes on until the mean log determinant, weighed by rows, stops falling.
    """
    counts = materialise(_counted(sound))
    least = _least_spreads(counts)
    if least is None:
        names = ", ".join(f"{c} double" for c in _estimate())
        return sound.sparkSession.createDataFrame([], f"_glang string, _gsource string, {names}")
    fit = materialise(_starts(sound, counts, least))
    for _ in range(FIRST_STEPS):
        fit = _concentrated(sound, fit, least)
    best = F.min(F.struct("_det", "_start", "_n", *_estimate())).alias("_best")
    fit = materialise(fit.groupBy("_glang", "_gsource").agg(best).select("_glang", "_gsource", "_best.*"))
    size = (F.sum(F.col("_det") * F.col("_n")) / F.sum("_n")).alias("_size")  # every step has the same rows
    before = fit.agg(size).first()[0]
    for _ in range(MOST_STEPS):
        fit = _concentrated(sound, fit, least)
        now = fit.agg(size).first()[0]
        if before - now < LEAST_FALL:
            break
        before = now
    return fit.select("_glang", "_gsource", *_estimate())


def judged(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Statistics and verdict per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance, kept``.

    Rows with under 50 words, or with over half their words in repeated 3-word phrases, fail at once.
    The others' transformed statistics are compared with the robust centre of
    their language and source: the minimum-covariance-determinant estimate, found by concentration
    steps from several starts until the determinants stop falling. A spread is never below what the data can resolve (``_least_spreads``). Rows beyond the
    chi-squared cut are rejected. Every group's moments include ``PRIOR_ROWS`` rows' worth of all groups', so that
    a small group is judged by common measure without a size limit.

    Medians and the nearest three quarters come from counted bins, so groups are aggregated before they move and the
    result does not depend on partitions. A NULL or empty text fails. NULL languages and sources are groups of their
    own. Repeated rows are judged alike, an empty table gives no rows.
    """
    rows = picked(df, doc_id=key, text=text, lang=lang, source=source)
    percent = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    rows = text_statistics(rows).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | percent)
    rows = materialise(rows).withColumns(transformed())
    fit = _fitted(rows.where("NOT base_failed"))
    cut = chi_squared_quantile(CONFIDENCE, DIMENSIONS)
    joined = rows.join(fit, _same_group(), "left").withColumn("distance", F.when(~F.col("base_failed"), F.sqrt(_distance())))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance",
                         (~F.col("base_failed") & (F.col("distance") * F.col("distance") <= cut)).alias("kept"))
