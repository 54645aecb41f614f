"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules look at one text.  The others ask whether a text's statistics are
unusual for its language and source: the location and scatter of the
transformed statistics are minimum-covariance-determinant (MCD) estimates,
and a text too far from them by Mahalanobis distance is rejected.

The MCD of a group is the half of its texts whose covariance has the smallest
determinant.  It is found by concentration steps for all groups at once: with
the present location and scatter compute all distances, keep the nearer half
and estimate again; no step raises the determinant.  Two deterministic starts
are carried along and the smaller determinant wins.  Halves are cut at a
quantile of finely binned distances: counts per bin are summed before any
shuffle, so a group of any size costs one row per bin and task.

Zero is common among the statistics, so a half may have no spread at all.
The scatter is therefore regularised: the square of a smallest scale, one for
each statistic, is added on the diagonal.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, via_table

SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "
#: (name, smallest scale) of the transformed statistics.
STATISTICS = (("log_word_chars", 0.10), ("root_symbols", 0.10), ("root_dup_lines", 0.25), ("root_repeats", 0.25))
#: Texts a group needs for estimates of its own; smaller ones use their language's, then all texts'.
MIN_GROUP = 100
HALF = 0.5
C_STEPS = 6
#: A text is rejected beyond this quantile of the distance that normal statistics would have.
CUT = 0.9999
_P = len(STATISTICS)
_X = [name for name, _ in STATISTICS]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, each counted once."""
    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - v, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def starts(ordered: Column) -> Column:
        again = F.filter(ordered, lambda e, k: (e["h"] == F.get(ordered, k - 1)["h"])
                         | (e["h"] == F.get(ordered, k + 1)["h"]))
        return F.sort_array(F.transform(again, lambda e: e["i"]))

    def counted(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0))
                .otherwise(_let(ordered, lambda o: _let(starts(o), covered))))

    hashes = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                     F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return _let(hashes, counted)


def with_statistics(df: DataFrame, text_col: str = "text", out: str = "stats") -> DataFrame:
    """Add a struct of the base statistics of each whole text (a null text has no words)."""
    text = F.coalesce(col(text_col), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, WHITE[:-1], " " * 5), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    long = lambda c: c.cast("long")
    counts = _let(words, lambda w: F.struct(long(F.size(w)).alias("n_words"),
                                            long(_repeated_words(w)).alias("n_repeat_words")))
    per_line = _let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"),
                                              long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return df.withColumn(out, F.struct(
        counts.alias("words"), per_line.alias("lines"),
        long(F.length(F.translate(text, WHITE, ""))).alias("word_chars"),
        long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols")))


def base_failed(stats: str) -> Column:
    n, repeats = F.col(f"{stats}.words.n_words"), F.col(f"{stats}.words.n_repeat_words")
    return (n < 50) | (100 * repeats > 50 * n)


def _transformed(stats: str) -> list[Column]:
    n = F.greatest(F.col(f"{stats}.words.n_words"), F.lit(1))
    lines = F.greatest(F.col(f"{stats}.lines.n_lines"), F.lit(1))
    return [F.log(F.greatest(F.col(f"{stats}.word_chars"), F.lit(1)) / n), F.sqrt(F.col(f"{stats}.n_symbols") / n),
            F.sqrt(F.col(f"{stats}.lines.n_dup_lines") / lines), F.sqrt(F.col(f"{stats}.words.n_repeat_words") / n)]


# --- chi-square with an even number of degrees of freedom -------------------

def chi2_cdf(x: float, dof: int) -> float:
    term, total = 1.0, 0.0
    for i in range(dof // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < q else (low, mid)
    return high


#: Makes the covariance of the nearer half of a normal sample that of the whole.
CONSISTENCY = HALF / chi2_cdf(chi2_quantile(HALF, _P), _P + 2)


# --- estimates --------------------------------------------------------------

def _quantile(df: DataFrame, keys: list[str], bin_col: str, q: float) -> DataFrame:
    """(keys, bin_col): the bin in which the cumulative count of a group reaches q."""
    counts = df.groupBy(*keys, bin_col).agg(F.count("*").alias("_n"))
    every = Window.partitionBy(*keys)
    upto = every.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    # one row for each bin; bins are bounded by the grid
    marked = counts.withColumn("_sum", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(every))
    return marked.where(F.col("_sum") >= q * F.col("_all")).groupBy(*keys).agg(F.min(bin_col).alias(bin_col))


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(_X)]
    sums += [F.avg(F.col(_X[i]) * F.col(_X[j])).alias(f"q{i}{j}") for i in range(_P) for j in range(i + 1)]
    return rows.groupBy(*keys).agg(*sums)


def _cholesky(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Location m0.. and lower factor l00.. of the regularised scatter, and its log determinant."""
    df = moments
    for i in range(_P):
        for j in range(i + 1):
            cov = (F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) * CONSISTENCY
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + STATISTICS[i][1] ** 2
            for k in range(j):
                cov = cov - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # what is left of a diagonal entry is at least the added square
            entry = F.sqrt(F.greatest(cov, F.lit(STATISTICS[i][1] ** 2))) if i == j else cov / F.col(f"l{j}{j}")
            df = df.withColumn(f"l{i}{j}", entry)
    log_det = sum((F.log(f"l{i}{i}") for i in range(1, _P)), F.log("l00"))
    return df.select(*keys, *(f"m{i}" for i in range(_P)), *(f"l{i}{j}" for i in range(_P) for j in range(i + 1)),
                     log_det.alias("log_det"))


def _distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in range(_P):
        left = x[i] - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"l{i}{k}") * y[k]
        y.append(left / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _levels() -> Column:
    """The groups that a text counts in: language and source, language, all."""
    null = F.lit(None).cast("string")
    group = lambda n, a, b: F.struct(F.lit(n).alias("level"), a.alias("lang"), b.alias("source"))
    return F.array(group(2, F.col("_lang"), F.col("_source")), group(1, F.col("_lang"), null), group(0, null, null))


def estimates(rows: DataFrame) -> DataFrame:
    """MCD location and scatter by ``key`` from rows (_lang, _source, statistics)."""
    seen = rows.select(F.explode(_levels()).alias("key"), *_X)
    large = via_table(seen.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_GROUP)
                      .select("key"), "mcd-groups")
    grown = seen.join(large, "key")
    # starts: medians and median absolute deviations on a grid of 1/1000
    long = grown.select("key", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x"))
                                                   for i, x in enumerate(_X)])).alias("e")).select("key", "e.i", "e.x")
    grid = lambda c: F.round(c * 1000).cast("long")
    middle = via_table(_quantile(long.withColumn("b", grid(F.col("x"))), ["key", "i"], "b", 0.5)
                       .select("key", "i", (F.col("b") / 1000).alias("med")), "mcd-medians")
    off = long.join(middle, ["key", "i"]).withColumn("b", grid(F.abs(F.col("x") - F.col("med"))))
    scale = _quantile(off, ["key", "i"], "b", 0.5).join(middle, ["key", "i"])
    wide = [F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in range(_P) for c in ("med", "b")]
    start = via_table(scale.groupBy("key").agg(*wide), "mcd-starts")
    z = [(F.col(x) - F.col(f"med{i}")) / F.sqrt((F.col(f"b{i}") / 1000 * 1.4826) ** 2 + STATISTICS[i][1] ** 2)
         for i, x in enumerate(_X)]
    ball, box = sum((v * v for v in z[1:]), z[0] * z[0]), F.greatest(*[v * v for v in z])
    far = grown.join(start, "key").select(
        "key", *_X, F.explode(F.array(F.struct(F.lit(0).alias("start"), ball.alias("d")),
                                      F.struct(F.lit(1).alias("start"), box.alias("d")))).alias("e")
    ).select("key", *_X, "e.start", "e.d")

    keys, fit = ["key", "start"], None
    for _ in range(C_STEPS + 1):
        binned = far.withColumn("b", F.floor(F.log(F.col("d") + 1e-9) * 200))
        half = via_table(_quantile(binned, keys, "b", HALF).withColumnRenamed("b", "cut"), "mcd-halves")
        near = binned.join(half, keys).where("b <= cut")
        fit = via_table(_cholesky(_moments(near, keys), keys), "mcd-fit")
        far = grown.join(fit, "key").select("key", *_X, "start", _distance([F.col(x) for x in _X]).alias("d"))
    best = F.min_by(F.struct(*[c for c in fit.columns if c not in keys]), F.struct("log_det", "start"))
    return fit.groupBy("key").agg(best.alias("fit")).select("key", "fit.*")


def verdicts(df: DataFrame, stats: str, lang_col: str = "lang", source_col: str = "source",
             kept: str = "kept") -> DataFrame:
    """Add ``kept``: false for base failures and for outliers of the row's group."""
    names = df.columns
    own = df.withColumns({"_failed": base_failed(stats), "_lang": col(lang_col).cast("string"),
                          "_source": col(source_col).cast("string"), **dict(zip(_X, _transformed(stats)))})
    good = own.where(~F.col("_failed")).select("_lang", "_source", *_X)
    fit = via_table(estimates(good), "mcd-estimates")
    # the group with estimates that is nearest to the row: a few rows per language and source
    pairs = good.select("_lang", "_source").distinct().withColumn("key", F.explode(_levels()))
    chosen = pairs.join(fit, "key").groupBy("_lang", "_source").agg(
        F.max_by(F.struct(*[c for c in fit.columns if c != "key"]), "key.level").alias("fit"))
    chosen = via_table(chosen.select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), "fit.*"), "mcd-chosen")
    joined = own.join(chosen, own["_lang"].eqNullSafe(chosen["_l"]) & own["_source"].eqNullSafe(chosen["_s"]), "left")
    far = _distance([F.col(x) for x in _X]) > chi2_quantile(CUT, _P)
    return joined.select(*map(col, names), (~F.col("_failed") & ~F.coalesce(far, F.lit(False))).alias(kept))


def judge_documents(docs: DataFrame) -> DataFrame:
    """The base statistics and the verdict of every document.

    A null or empty text has no words and fails the base rules.  A null
    language or source is a value like any other.  Where not even all texts
    together are ``MIN_GROUP``, only the base rules speak.  Each row is judged
    by itself, repeated or not; an empty table gives no rows; other columns
    are not read.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    found = via_table(with_statistics(slim).drop("text"), "quality-statistics")
    return verdicts(found, "stats").select(
        "doc_id", F.col("stats.words.n_words").alias("n_words"), F.col("stats.word_chars").alias("word_chars"),
        F.col("stats.n_symbols").alias("n_symbols"), F.col("stats.lines.n_dup_lines").alias("n_dup_lines"),
        F.col("stats.words.n_repeat_words").alias("n_repeat_words"), base_failed("stats").alias("base_failed"), "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    safe = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    # the statistics are computed once: rows and statistics are written together and read by column
    both = via_table(with_statistics(safe, place["text"], "stats"), "quality-documents")
    judged = verdicts(both, "stats", place["lang"], place["source"]).where("kept")
    return judged.select(*[F.col(place[c]).alias(c) for c in docs.columns])
