"""Statistics and hypothesis tests (H*), plus the listening-behaviour
aggregates (A6, A9) built on them.

Everything reduces to grouped aggregations (partial + final) over the
rows; only per-group summary rows (a handful per group) are joined or
paired afterwards.  Medians are exact and distributed (sort-based).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import ms_to_minutes
from tessera.functions.stats import modified_z, two_sided_p
from tessera.operators.ordered import exact_quantiles
from tessera.session import cut_lineage

#: Group summaries of one bucket of the pairwise tests.
BUCKET = 512


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """H1: correlation of one pair."""
    return df.agg(F.corr(x, y).alias("corr"))


def correlation_with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """H2: corr of every column with the target after dropping rows with any
    NULL, one aggregation pass, long form sorted by |corr| desc."""
    clean = df.dropna(subset=[*cols, target])
    wide = clean.agg(*[F.corr(c, target).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (wide.selectExpr(f"stack({len(cols)}, {pairs}) as (feature, corr)")
            .orderBy(F.abs("corr").desc()))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """H2: all pairs (a < b by position) in one aggregation pass, long form."""
    clean = df.dropna(subset=cols)
    aggs, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            names.append((a, b))
            aggs.append(F.corr(a, b).alias(f"{a}__{b}"))
    wide = clean.agg(*aggs)
    pairs = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) as (col_a, col_b, corr)")


def eta_ratio(df: DataFrame, cat: str, y: str) -> DataFrame:
    """H3: correlation ratio sqrt(sum n_c (m_c - m)^2 / sum (y - m)^2).

    From per-category counts, means and population variances: all sums are
    centred, so a large common offset of y costs no digits.
    """
    g = group_moments(df, cat, y)
    mean = g.select(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    between = F.sum(F.col("n") * (F.col("mean") - mean) ** 2)
    within = F.sum(F.col("n") * F.col("var"))
    return g.agg(F.sqrt(F.try_divide(between, between + within)).alias("eta"))


def group_moments(df: DataFrame, group: str | list[str], x: str) -> DataFrame:
    """Per-group n, mean and population variance."""
    keys = [group] if isinstance(group, str) else group
    return df.where(F.col(x).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"))


def pairwise_z_tests(df: DataFrame, group: str, x: str, within: list[str] | None = None,
                     drop_zeros: bool = False) -> DataFrame:
    """H4 + H5: two-sample z test for every pair of groups (a < b), inside each
    combination of the ``within`` columns; ``drop_zeros`` leaves out x = 0.

    Only per-group summary rows (one row per group) are paired, not data rows.
    They are dealt to buckets of about ``BUCKET`` and every pair of buckets is a
    key of its own, so the pairs come from many tasks.  NULL is a group and
    comes first.  Two groups without any variance give z NULL.
    """
    within = within or []
    data = df.where(F.col(x) != 0) if drop_zeros else df
    m = cut_lineage(group_moments(data, [*within, group], x).withColumnRenamed(group, "_g")
                    .withColumn("_w", F.xxhash64(*within) if within else F.lit(0)))
    blocks = max(1, -(-m.count() // BUCKET))
    bucket = F.pmod(F.xxhash64("_g"), F.lit(blocks)).cast("int")

    def side(name: str, tile: Column) -> DataFrame:
        """Each summary once for every tile of buckets that it meets on this side."""
        one = m.withColumn("_b", bucket).select("_w", F.struct(*within, "_g", "n", "mean", "var").alias(name), tile.alias("_t"))
        return one.select("_w", name, F.inline("_t"))

    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    a = side("a", F.transform(every, lambda o: F.struct(F.col("_b").alias("i"), o.alias("j"))))
    b = side("b", F.transform(every, lambda o: F.struct(o.alias("i"), F.col("_b").alias("j"))))
    same = F.lit(True)
    for k in within:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    p = a.join(b, ["_w", "i", "j"]).where(same & F.coalesce(F.col("a._g") < F.col("b._g"), F.col("a._g").isNull() & F.col("b._g").isNotNull()))
    se = F.sqrt(F.col("a.var") / F.col("a.n") + F.col("b.var") / F.col("b.n"))
    z = F.try_divide(F.col("a.mean") - F.col("b.mean"), se)
    return p.select(*[F.col(f"a.{k}").alias(k) for k in within], F.col("a._g").alias("group_a"), F.col("b._g").alias("group_b"),
                    z.alias("z"), two_sided_p(z).alias("p_value"))


def chi_square_gof(pos: DataFrame, ref: DataFrame, cat: str, top: int = 10,
                   digits: int = 4, use_counts: bool = False) -> DataFrame:
    """H6: sum (o - e)^2 / e over the ``top`` most frequent categories of
    ``pos``; o, e are rounded shares (or counts when ``use_counts``) in the
    positive and reference populations.  Categories absent from the
    reference are skipped.  NULL is a category."""
    from tessera.operators.relational import category_distribution
    p = category_distribution(pos, cat, digits).withColumnsRenamed({"n": "n_obs", "ratio": "obs"})
    r = category_distribution(ref, cat, digits).withColumnsRenamed({"n": "n_exp", "ratio": "exp"})
    topk = p.orderBy(F.col("n_obs").desc(), F.col(cat).asc_nulls_first()).limit(top)
    j = topk.join(r, topk[cat].eqNullSafe(r[cat])).drop(r[cat])
    o = F.col("n_obs") if use_counts else F.col("obs")
    e = F.col("n_exp") if use_counts else F.col("exp")
    return j.where(e > 0).agg(F.sum((o - e) * (o - e) / e).alias("chi2"),
                              F.count(F.lit(1)).alias("n_categories"))


def median_mean_by(df: DataFrame, group: str, x: str) -> DataFrame:
    """H7: exact median and mean of x per class."""
    med = exact_quantiles(df, x, [0.5], [group]).withColumnRenamed("q_0.5", "median")
    mean = df.groupBy(group).agg(F.avg(x).alias("mean"))
    return mean.join(med, group, "left")


def mad(df: DataFrame, x: str) -> tuple[float, float]:
    """H8: (median, median absolute deviation) with NULLs dropped; driver scalars."""
    med = exact_quantiles(df, x, [0.5]).collect()[0]["q_0.5"]
    dev = df.select(F.abs(F.col(x) - F.lit(med)).alias("dev"))
    m = exact_quantiles(dev, "dev", [0.5]).collect()[0]["q_0.5"]
    return med, m


def medians(df: DataFrame, columns: list[str], bins: int = 4096) -> list[float | None]:
    """H8: exact medians of several columns side by side, without sorting or shuffling the rows.

    A scan counts the values of the interval in which a middle value lies, by bins of equal width; the bin that holds it,
    cut to its smallest and largest value, is the next interval, until they are equal.  Nulls are dropped; NaN is
    above all numbers.  Every scan reads all columns whose middle value is still open.
    """
    first = df.agg(*[f(F.when(~F.isnan(c), F.col(c).cast("double"))).alias(f"{a}{i}") for i, c in enumerate(columns)
                     for a, f in (("lo", F.min), ("hi", F.max))],
                   *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
                   *[F.count(F.when(~F.isnan(c) & F.col(c).isNotNull(), 1)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    # an even number of values has two middle ones; each is searched by itself
    goals = [(i, k) for i in range(len(columns)) if (n := first[f"n{i}"]) for k in sorted({(n - 1) // 2, n // 2})]
    found: dict[tuple[int, int], float] = {}
    found |= {(i, k): float("nan") for i, k in goals if k >= first[f"m{i}"]}
    state = {g: (first[f"lo{g[0]}"], first[f"hi{g[0]}"], g[1]) for g in goals if g not in found}
    while True:
        found |= {g: lo for g, (lo, hi, _) in state.items() if lo == hi}
        state = {g: s for g, s in state.items() if g not in found}
        if not state:
            break
        cells = []
        for j, (g, (lo, hi, _)) in enumerate(state.items()):
            x = F.col(columns[g[0]]).cast("double")
            place = F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * bins)
            cells.append(F.when(x.between(lo, hi), F.struct(F.lit(j).alias("goal"), F.least(place, F.lit(bins - 1)).alias("bin"),
                                                           x.alias("x"))))
        rows = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).groupBy("c.goal", "c.bin")
                .agg(F.count(F.lit(1)).alias("n"), F.min("c.x").alias("lo"), F.max("c.x").alias("hi"))
                .orderBy("goal", "bin").collect())
        for j, (g, (_, _, k)) in enumerate(list(state.items())):
            for r in rows:
                if r["goal"] == j:
                    if k < r["n"]:
                        state[g] = (r["lo"], r["hi"], k)
                        break
                    k -= r["n"]
    return [sum(v) / len(v) if (v := [found[g] for g in goals if g[0] == i]) else None for i in range(len(columns))]


def modified_z_report(fit_on: DataFrame, apply_to: DataFrame, x: str,
                      threshold: float = 3.5) -> DataFrame:
    """H9: fit median/MAD on ``fit_on`` (normal class) and flag rows of
    ``apply_to`` with |0.6745 (x - median) / MAD| > threshold.

    recall = flagged / non-null; nan_ratio = nulls / non-null (as in the
    original notebook).
    """
    med, m = mad(fit_on, x)
    z = modified_z(x, F.lit(med), F.lit(m))
    flagged = F.abs(z) > threshold
    return apply_to.agg(
        F.lit(med).alias("median"), F.lit(m).alias("mad"),
        F.count(x).alias("n_non_null"),
        F.sum(F.col(x).isNull().cast("bigint")).alias("n_null"),
        F.sum(F.when(F.col(x).isNotNull(), flagged.cast("bigint"))).alias("n_flagged"),
    ).withColumn("recall", F.try_divide("n_flagged", "n_non_null")).withColumn(
        "nan_ratio", F.try_divide("n_null", "n_non_null"))


def histogram(df: DataFrame, x: str, lo: float, hi: float, bins: int,
              group: str | None = None) -> DataFrame:
    """Equal-width bin counts (``width_bucket``; out-of-range values go
    to bins 0 and bins+1)."""
    keys = [group] if group else []
    b = F.width_bucket(F.col(x), F.lit(lo), F.lit(hi), F.lit(bins)).alias("bin")
    return df.where(F.col(x).isNotNull()).groupBy(*keys, b).agg(F.count(F.lit(1)).alias("n"))


def boxplot_numbers(df: DataFrame, x: str, group: str) -> DataFrame:
    """Min, quartiles, max per group (the numbers behind a box plot)."""
    q = exact_quantiles(df, x, [0.25, 0.5, 0.75], [group])
    mm = df.groupBy(group).agg(F.min(x).alias("min"), F.max(x).alias("max"))
    return mm.join(q, group).withColumnsRenamed({"q_0.25": "q1", "q_0.5": "median", "q_0.75": "q3"})


# ------------------------------------------------ listening-behaviour stats


def _sum(c, digits: int | None):
    """Sum, optionally rounded to the input's decimal precision so the result
    does not depend on the order partitions are added in."""
    s = F.sum(c)
    return s if digits is None else F.round(s, digits)


def user_listen_stats(users: DataFrame, plays: DataFrame, user: str, ms: str,
                      paid: str, sum_digits: int | None = None) -> DataFrame:
    """Per user (every user of ``users``, 0 when no plays): play count
    (zero-length plays not counted), minutes, average, paid count (zero-length
    paid plays *are* counted), paid minutes, paid average, paid share
    (NULL when total time is 0)."""
    a = plays.groupBy(user).agg(
        F.count(F.when(F.col(ms) != 0, 1)).alias("cnt"),
        ms_to_minutes(_sum(ms, sum_digits)).alias("minutes"),
        F.count(F.when(F.col(paid), 1)).alias("paid_count"),
        ms_to_minutes(F.coalesce(_sum(F.when(F.col(paid), F.col(ms)), sum_digits), F.lit(0))).alias("paid_minutes"))
    u = users.join(a, user, "left").fillna({"cnt": 0, "minutes": 0.0, "paid_count": 0, "paid_minutes": 0.0})
    return u.select(
        "*",
        F.when(F.col("cnt") == 0, F.lit(0.0)).otherwise(F.col("minutes") / F.col("cnt")).alias("avg_minutes"),
        F.when(F.col("paid_count") == 0, F.lit(0.0)).otherwise(
            F.col("paid_minutes") / F.col("paid_count")).alias("avg_paid_minutes"),
        F.when(F.col("minutes") != 0, F.col("paid_minutes") / F.col("minutes")).alias("paid_share"))


def song_stats(plays: DataFrame, users: DataFrame, song: str, user: str, ms: str,
               paid: str, sum_digits: int | None = None) -> DataFrame:
    """Per song (zero-length plays and empty names skipped): plays with
    repeats, minutes, paid minutes, paid ratio and listener profile shares
    (every column of ``users`` other than the key is averaged over plays)."""
    p = plays.where((F.col(ms) != 0) & F.col(song).isNotNull() & (F.col(song).cast("string") != ""))
    j = p.join(users, user, "left")
    prof = [c for c in users.columns if c != user]
    return j.groupBy(song).agg(
        F.count(F.lit(1)).alias("plays"),
        ms_to_minutes(_sum(ms, sum_digits)).alias("minutes"),
        ms_to_minutes(F.coalesce(_sum(F.when(F.col(paid), F.col(ms)), sum_digits), F.lit(0))).alias("paid_minutes"),
        F.avg(F.col(paid).cast("double")).alias("paid_ratio"),
        *[F.avg(F.col(c).cast("double")).alias(
            {"age_code": "mean_age_code", "male": "male_share", "us": "us_share"}.get(c, f"avg_{c}"))
          for c in prof])
