"""Window and ordered operators: rolling statistics, lags, ranks, splits,
top-k, argmax, dense row index and exact quantiles.

Windows are partitioned by a series key and a chunk of its positions.
Operators that need a *global* order (row index, chronological split, exact quantiles) never use
an unpartitioned window (that would move every row into one task); they
range-partition and sort in parallel, then turn per-partition offsets
(one small row per partition) into a dense index or a running sum.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


#: Positions of a series that one window partition holds; longer series have several.
CHUNK = 1 << 16


def series_positions(df: DataFrame, keys: list[str], order: str | list) -> DataFrame:
    """Add ``_pos`` (0-based position in the series ``keys``) and ``_len``.

    One distributed index over (keys, order), so a single long series is
    sorted by all tasks.
    """
    cols = [order] if isinstance(order, str) else order
    idx = dense_index(df, [*keys, *cols], name="_i").withColumn("_k", F.struct(*keys))
    first = idx.groupBy("_k").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_len"))
    return idx.join(first, "_k").withColumn("_pos", F.col("_i") - F.col("_first")).drop("_i", "_k", "_first")


def with_context(df: DataFrame, keys: list[str], order: str, back: int, chunk: int = CHUNK):
    """(frame, window, own rows): windows that look at most ``back`` rows back.

    A series is cut into chunks of ``chunk`` positions.  The last rows of a
    chunk also go to the next one as context, so a window over (keys, chunk)
    sees what a window over the whole series would; the condition ``own``
    drops the context rows afterwards.
    """
    s = series_positions(df, keys, order)
    own = F.floor(F.col("_pos") / chunk)
    late = F.col("_pos") % chunk >= chunk - back
    s = s.withColumn("_chunk", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    return s, Window.partitionBy(*keys, "_chunk").orderBy("_pos"), F.col("_chunk") == own


def rolling_stats(df: DataFrame, key: str | list[str], order: str, value: str,
                  window: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Trailing mean and sample std over ``window`` rows, NULL until full."""
    keys = [key] if isinstance(key, str) else key
    s, w, own = with_context(df, keys, order, window - 1, chunk)
    w = w.rowsBetween(-(window - 1), 0)
    full = F.count(value).over(w) == window
    return (s.withColumn("rolling_mean", F.when(full, F.avg(value).over(w)))
             .withColumn("rolling_std", F.when(full, F.stddev_samp(value).over(w)))
             .where(own).select(*df.columns, "rolling_mean", "rolling_std"))


def rolling_detrend(df: DataFrame, key, order: str, value: str, window: int = 4) -> DataFrame:
    """Value minus its trailing mean; rows before the window is full dropped."""
    r = rolling_stats(df, key, order, value, window)
    return (r.where(F.col("rolling_mean").isNotNull())
             .withColumn("detrended", F.col(value) - F.col("rolling_mean")))


def lags_and_diffs(df: DataFrame, key, order: str, value: str, lags: int = 1,
                   d: int = 1, chunk: int = CHUNK) -> DataFrame:
    """lag_1..lag_k columns and the d-th order difference."""
    keys = [key] if isinstance(key, str) else key
    s, w, own = with_context(df, keys, order, max(lags, d), chunk)
    for k in range(1, lags + 1):
        s = s.withColumn(f"lag_{k}", F.lag(value, k).over(w))
    # d-th difference = sum_j (-1)^j C(d, j) x_{t-j}
    diff = None
    for j in range(d + 1):
        term = F.lit(float((-1) ** j * comb(d, j))) * (F.col(value) if j == 0 else F.lag(value, j).over(w))
        diff = term if diff is None else diff + term
    names = [f"lag_{k}" for k in range(1, lags + 1)]
    return s.withColumn(f"diff_{d}", diff).where(own).select(*df.columns, *names, f"diff_{d}")


def percentile_rank(df: DataFrame, user: str, score: str, tie: str) -> DataFrame:
    """Rank within user by score desc mapped to 0..100: 100*i/(n-1), n=1 -> 0.

    The ranks are positions in one distributed order, so a user with very
    many rows is no single task."""
    s = series_positions(df, [user], [F.col(score).desc(), F.col(tie).asc()])
    pct = F.when(F.col("_len") > 1, 100.0 * F.col("_pos") / (F.col("_len") - 1)).otherwise(0.0)
    return s.withColumn("rank_pct", pct).drop("_pos", "_len")


def regular_date_index(df: DataFrame, key, order: str, start: str, step_days: int = 7) -> DataFrame:
    """Start date + step_days x position within each series."""
    keys = [key] if isinstance(key, str) else key
    s = series_positions(df, keys, order).withColumnRenamed("_pos", "position").drop("_len")
    return s.withColumn("period_date", F.date_add(F.to_date(F.lit(start)), (F.col("position") * step_days).cast("int")))


def _with_offsets(tagged: DataFrame, sums: dict) -> DataFrame:
    """Join to each row what all earlier partitions add up to.

    ``sums``: {output column: aggregate}.  The totals are one row per
    partition, so their running sum is small, and the join (not a literal
    lookup) stays cheap for any number of partitions.
    """
    totals = tagged.groupBy("_pid").agg(*[agg.alias(c) for c, agg in sums.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums])
    return tagged.join(offsets, "_pid")


def dense_index(df: DataFrame, order_cols: list, n_partitions: int | None = None,
                name: str = "row_idx") -> DataFrame:
    """0-based position of each row in the total order ``order_cols``.

    Range partitioning sorts in parallel; each partition's rows get
    ``monotonically_increasing_id`` (partition id << 33 | row).  The tagged
    rows are materialised once with a reliable checkpoint (range bounds are
    re-sampled by every job, so offsets and ids must come from the same
    copy); the per-partition row counts (one row per partition) then give
    the offsets.  Pass a full tie-breaker in ``order_cols`` when positions
    must be reproducible and a frequent value must not fill one partition.
    """
    n = n_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id()))
    s = _with_offsets(cut_lineage(s), {"_off": F.count(F.lit(1))})
    # _mid - (pid << 33) is the row number inside the partition.
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.withColumn(name, (F.col("_off") + local).cast("bigint")).drop("_pid", "_mid", "_off")


def running_sums(df: DataFrame, order_cols: list, cols: list[str]) -> DataFrame:
    """Inclusive prefix sums ``cum_<col>`` in the total order ``order_cols``.

    Distributed: range-partitioned sort, a local running sum inside each
    partition, and the per-partition totals (one row per partition) as
    offsets - no single-partition window.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id()))
    out = _with_offsets(s, {f"_off_{c}": F.sum(c) for c in cols})
    w = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_off_{c}") + F.sum(c).over(w))
    return out.drop("_pid", *[f"_off_{c}" for c in cols])


def value_counts(df: DataFrame, value: str, group: list[str]) -> DataFrame:
    """(group, _v, _n): distinct non-NULL values as doubles with their row counts."""
    return (df.select(*group, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
            .groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n")))


def quantiles_of_counts(counts: DataFrame, probs: list[float], group: list[str]) -> DataFrame:
    """Exact interpolated quantiles from (group, _v, _n), see ``exact_quantiles``.

    Running sums over the distinct values place each value at an interval of
    positions; the order statistics around q*(n-1) are the values whose
    interval holds them.
    """
    c = running_sums(counts, [*group, "_v"], ["_n"])
    key = F.struct(*group) if group else F.lit(0)
    c = c.withColumn("_g", key)
    stats = c.groupBy("_g").agg((F.min(F.col("cum__n") - F.col("_n"))).alias("_start"), F.sum("_n").alias("_tot"))
    pos = [F.lit(p) * (F.col("_tot") - 1) for p in probs]
    targets = stats.select("_g", F.struct(*[(F.col("_start") + F.floor(x)).alias(f"lo{i}") for i, x in enumerate(pos)],
                                          *[(F.col("_start") + F.ceil(x)).alias(f"hi{i}") for i, x in enumerate(pos)],
                                          *[(x - F.floor(x)).alias(f"fr{i}") for i, x in enumerate(pos)]).alias("_t"))
    if group:
        j = c.join(targets, "_g")
    else:  # one row of totals: its numbers travel as literals
        row = targets.first()
        if row is None:
            return df_empty(c, probs)
        j = c.withColumn("_t", F.struct(*[F.lit(v).alias(k) for k, v in row["_t"].asDict().items()]))

    def at(which: str):
        place = F.col(f"_t.{which}")
        return F.max(F.when((place >= F.col("cum__n") - F.col("_n")) & (place < F.col("cum__n")), F.col("_v")))

    aggs = []
    for i, p in enumerate(probs):
        lo, hi = at(f"lo{i}"), at(f"hi{i}")
        aggs.append((lo + F.max(f"_t.fr{i}") * (hi - lo)).alias(f"q_{p}"))
    out = j.groupBy("_g").agg(*aggs)
    names = [f"`q_{p}`" for p in probs]
    return out.select(*[F.col("_g")[g].alias(g) for g in group], *names)


def df_empty(like: DataFrame, probs: list[float]) -> DataFrame:
    return like.sparkSession.createDataFrame([], ", ".join(f"`q_{p}` double" for p in probs))


def exact_quantiles(df: DataFrame, value: str, probs: list[float],
                    group: list[str] | None = None) -> DataFrame:
    """Exact interpolated quantiles (same rule as DuckDB ``quantile_cont``).

    Rows with NULL value are dropped.  Rows are counted by (group, value)
    first (partial aggregation), so neither a hot group nor a hot value is
    gathered in one task; only distinct values are sorted.  Output: group
    cols + one column per prob named ``q_<prob>``.
    """
    group = group or []
    return quantiles_of_counts(value_counts(df, value, group), probs, group)


def chronological_split(df: DataFrame, order_cols: list, frac: float = 0.8,
                        n_rows: int | None = None) -> DataFrame:
    """First floor(frac*n) rows of the total order are train (flag column)."""
    idx = dense_index(df, order_cols, name="_pos")
    n = n_rows if n_rows is not None else df.count()
    cut = int(frac * n)
    return idx.withColumn("is_train", F.col("_pos") < cut).drop("_pos")


def reverse_order(df: DataFrame, order_cols: list, name: str = "position") -> DataFrame:
    """0-based position of each row counted from the last one of the order."""
    idx = dense_index(df, order_cols, name=name)
    return idx.withColumn(name, F.lit(df.count() - 1) - F.col(name))


def first_n_split(df: DataFrame, order_cols: list, n: int) -> DataFrame:
    """The first ``n`` rows of the order are train (flag ``is_train``)."""
    return dense_index(df, order_cols, name="_pos").withColumn("is_train", F.col("_pos") < n).drop("_pos")


def positional_split(train: DataFrame, score: DataFrame) -> DataFrame:
    """Stack train and scoring rows with an explicit is_train flag."""
    return (train.withColumn("is_train", F.lit(True))
            .unionByName(score.withColumn("is_train", F.lit(False)), allowMissingColumns=True))


def top_k(df: DataFrame, order_cols: list, k: int) -> DataFrame:
    """First k rows of an ordering (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order_cols).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order_cols: list, k: int,
                    name: str = "rank") -> DataFrame:
    """Top-k inside each group by row_number over a full ordering."""
    w = Window.partitionBy(*group).orderBy(*order_cols)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def argmax_first(df: DataFrame, group: list[str], value: str, tie: str) -> DataFrame:
    """The row with the largest value per group; lowest ``tie`` wins ties.

    Uses ``max_by`` on a (value, -tie) struct: a partial aggregate, so a hot
    group is reduced map-side instead of being sorted in one task.
    """
    cols = [c for c in df.columns if c not in group]
    key = F.struct(F.col(value).alias("v"), (-F.col(tie)).alias("t"))
    best = df.groupBy(*group).agg(F.max_by(F.struct(*cols), key).alias("_best"))
    return best.select(*group, "_best.*")
