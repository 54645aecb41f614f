"""Projection, filtering, missing data, profiling, joins, aggregation and
set operators.

All are thin compositions of DataFrame operations so Catalyst keeps column
pruning and filter pushdown down to the parquet scan.  Aggregations are
plain ``groupBy().agg()`` (partial + final aggregation, map-side combine).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordered import exact_quantiles, quantiles_of_counts, value_counts
from tessera.session import cut_lineage

# ---------------------------------------------------------------- projection


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep named columns."""
    return df.select(*cols)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Delete named columns."""
    return df.drop(*cols)


def select_positions(df: DataFrame, positions: list[int]) -> DataFrame:
    """Columns by 0-based position (``iloc[:, [..]]``)."""
    return df.select(*[df.columns[i] for i in positions])


def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Label slice ``first:last`` inclusive."""
    cols = df.columns
    return df.select(*cols[cols.index(first): cols.index(last) + 1])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed(mapping)


def filter_between(df: DataFrame, col: str, lo, hi, strict: bool = False) -> DataFrame:
    """Lo <= col <= hi, or lo < col < hi when strict."""
    c = F.col(col)
    return df.where((c > lo) & (c < hi)) if strict else df.where(c.between(lo, hi))


def filter_isin(df: DataFrame, col: str, values: list, negate: bool = False) -> DataFrame:
    """Membership (or its negation)."""
    cond = F.col(col).isin(values)
    return df.where(~cond if negate else cond)


# -------------------------------------------------------------- missing data


def _missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    cond = F.col(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        cond = cond | F.isnan(c)
    return cond


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P5: missing count per column in one pass, long form (column, n_missing)."""
    cols = cols or df.columns
    wide = df.agg(*[F.sum(_missing(df, c).cast("bigint")).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, n_missing)")


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with a NULL in ``subset`` (or any column) removed."""
    return df.dropna(how="any", subset=subset)


def fill_constant(df: DataFrame, mapping: dict) -> DataFrame:
    """Per-column constant for NULL."""
    return df.fillna(mapping)


def _melt(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value): the columns as doubles in long form."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, value)")


class MedianImputer:
    """Medians learned on training rows, applied to any frame.

    Medians are exact (interpolated); the columns are counted by value
    together, so one job fits all and no column is gathered into one task.
    A column without any value stays as it is.
    """

    def __init__(self, cols: list[str]):
        self.cols = cols
        self.medians: dict[str, float] = {}

    def fit(self, df: DataFrame) -> "MedianImputer":
        rows = exact_quantiles(_melt(df, self.cols), "value", [0.5], ["column_name"]).collect()
        found = {r["column_name"]: r["q_0.5"] for r in rows}
        self.medians = {c: found.get(c) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.fillna({c: v for c, v in self.medians.items() if v is not None})


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe() in long form, one row per column: count, mean, std, min,
    exact quartiles, max and distinct count.

    Moments are one wide aggregate without a shuffle of rows.  The columns
    are melted and counted by value, which gives quartiles and distinct
    values from the counts alone.
    """
    wide = df.agg(*[F.struct(F.count(x).alias("count"), F.avg(x).alias("mean"), F.sum(x).alias("total"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(c)
                    for c, x in ((c, F.col(c).cast("double")) for c in cols)])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    moments = wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, m)").select("column_name", "m.*")
    counts = cut_lineage(value_counts(_melt(df, cols), "value", ["column_name"]))
    q = quantiles_of_counts(counts, [0.25, 0.5, 0.75], ["column_name"])
    q = q.select("column_name", F.col("`q_0.25`").alias("q25"), F.col("`q_0.5`").alias("q50"),
                 F.col("`q_0.75`").alias("q75"))
    n = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    return moments.join(n, "column_name", "left").fillna({"n_distinct": 0}).join(q, "column_name", "left")


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """P10: extremes of columns in one pass."""
    return df.agg(*[e for c in cols for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def cut_outliers(df: DataFrame, col: str, bound: float) -> DataFrame:
    """Label rows ``outlier`` (> bound) or ``kept`` (< bound).

    Rows equal to the bound belong to neither side and are left out, as in
    the two-filter original.
    """
    c = F.col(col)
    return (df.withColumn("part", F.when(c > bound, "outlier").when(c < bound, "kept"))
              .where(F.col("part").isNotNull()))


def random_sample(df: DataFrame, frac: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample.  ``frac=1`` shuffles in the original; Spark rows
    are unordered so that case is the identity."""
    return df if frac >= 1.0 else df.sample(fraction=frac, seed=seed)


# ---------------------------------------------------------------------- joins


def anti_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``left`` missing from ``right``."""
    return left.select(*keys).join(right.select(*keys), keys, "left_anti").distinct()


def semi_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple appears in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def anti_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple does not appear in ``right``."""
    return left.join(right.select(*keys), keys, "left_anti")


def left_join_default(left: DataFrame, right: DataFrame, keys: list[str],
                      defaults: dict) -> DataFrame:
    """Left join; NULLs of the listed right columns replaced by defaults."""
    j = left.join(right, keys, "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


# ---------------------------------------------------------------- aggregation


def count_by_key(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """A1: rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count_by_key(df: DataFrame, key: str, of: str, min_count: int = 0) -> DataFrame:
    """A2: distinct ``of`` per key, kept when >= min_count (HAVING)."""
    return (df.groupBy(key).agg(F.count_distinct(of).alias("n_distinct"))
            .where(F.col("n_distinct") >= min_count))


def collect_sorted(df: DataFrame, key: str, of: str, distinct: bool = True) -> DataFrame:
    """A3: sorted list (or set) of values per key."""
    agg = F.collect_set(of) if distinct else F.collect_list(of)
    return df.groupBy(key).agg(F.sort_array(agg).alias("values"))


def max_other_by_key(df: DataFrame, key: str, other: str) -> DataFrame:
    """A4: MAX(other) per key."""
    return df.groupBy(key).agg(F.max(other).alias(f"max_{other}"))


def category_distribution(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """A10: count and share of each value (NULL is a category), share rounded."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # Uncorrelated scalar subquery: the total is computed once and inlined.
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("ratio", F.round(F.col("n") / total, digits))


def share_within(df: DataFrame, segment: str, value: str) -> DataFrame:
    """Count and share of each value inside each segment."""
    counts = df.groupBy(segment, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(segment)))


def positive_rate_by(df: DataFrame, cat: str, label: str) -> DataFrame:
    """Contingency counts and P(label = 1) per category value."""
    return df.groupBy(cat).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"))


def rate_by(df: DataFrame, key: Column | str, cond: Column, name: str = "rate") -> DataFrame:
    """Share of rows meeting ``cond`` per key."""
    return df.groupBy(key).agg(F.avg(cond.cast("double")).alias(name))


def group_moments(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Mean and standard deviation per group."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"avg_{c}"), F.stddev_samp(c).alias(f"sd_{c}")]
    return df.groupBy(*group).agg(*aggs)


def baseline_mse(df: DataFrame, y: str) -> DataFrame:
    """MSE of predicting the mean = population variance."""
    return df.agg(F.avg(y).alias("mean"), F.var_pop(y).alias("mse"))


def rfm_features(df: DataFrame, customer: str, ts: str, amount: str,
                 single_value: float = -300.0) -> DataFrame:
    """Total spend, purchase count, mean days between purchases
    (``single_value`` when only one purchase)."""
    g = df.groupBy(customer).agg(
        F.sum(amount).alias("revenue"), F.count(F.lit(1)).alias("frequency"),
        F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    interval = F.when(F.col("frequency") == 1, F.lit(single_value)).otherwise(
        F.datediff(F.to_date("_last"), F.to_date("_first")) / (F.col("frequency") - 1))
    return g.withColumn("interval", interval.cast("double")).drop("_first", "_last")


# ---------------------------------------------------------------------- sets


def union_all(*dfs: DataFrame) -> DataFrame:
    """Stack by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``left`` not in ``right``."""
    return anti_keys(left, right, keys)
