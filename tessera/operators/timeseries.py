"""Time-series operators over many series at once: ``(series_id, t, value)``.

No operator needs a series in one task.  Rows get their position in the
series from a distributed index; a series is cut into chunks of ``CHUNK``
positions, each with the few rows before it that its lags need.  Least-squares
fits (PACF, ADF, ARIMA by two regressions) use Gram matrices of lag columns:
every chunk gives the sums over its own rows, Spark adds the chunks of a
series up, and the small normal equations are solved per series.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ordered import CHUNK, series_positions, with_context

#: MacKinnon (2010) response-surface coefficients for the ADF
#: test with a constant: 1%, 5%, 10% critical values.
ADF_CV_CONST = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
#: MacKinnon (1994) p-values of the same test: Phi of a
#: polynomial in the statistic, constant term first, up to and beyond -1.61.
ADF_P_SPLIT, ADF_P_MIN, ADF_P_MAX = -1.61, -18.83, 2.74
ADF_P_SMALL = (2.1659, 1.4412, 0.038269)
ADF_P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def daily_series(df: DataFrame, key: str, ts: str, value: str, digits: int | None = None) -> DataFrame:
    """Sum of ``value`` per (key, calendar day) as (series_id, day, value)."""
    s = F.sum(value)
    if digits is not None:
        s = F.round(s, digits)
    return df.groupBy(F.col(key).alias("series_id"), F.to_date(ts).alias("day")).agg(s.alias("value"))


def acf(series: DataFrame, key: str, order: str, value: str, nlags: int = 5) -> DataFrame:
    """M1: biased autocorrelation sum (x_t - m)(x_{t-k} - m) / sum (x_t - m)^2
    for k = 1..nlags with the +-1.96/sqrt(n) bound.  The series mean comes
    from a grouped aggregate joined back, lags from windows over chunks."""
    m = series.groupBy(key).agg(F.avg(value).alias("_m"), F.count(F.lit(1)).alias("n"))
    c = series.join(m, key).withColumn("_x", F.col(value) - F.col("_m"))
    c, w, own = with_context(c, [key], order, nlags)
    for k in range(1, nlags + 1):
        c = c.withColumn(f"_x{k}", F.lag("_x", k).over(w))
    a = c.where(own).groupBy(key).agg(
        F.first("n").alias("n"), F.sum(F.col("_x") * F.col("_x")).alias("c0"),
        *[F.sum(F.col("_x") * F.col(f"_x{k}")).alias(f"c{k}") for k in range(1, nlags + 1)])
    stacked = ", ".join(f"{k}, c{k}" for k in range(1, nlags + 1))
    return a.selectExpr(key, "n", "c0", f"stack({nlags}, {stacked}) as (k, ck)").select(
        F.col(key).alias("series_id"), F.col("k").cast("int").alias("k"),
        F.try_divide("ck", "c0").alias("acf"), (F.lit(1.96) / F.sqrt("n")).alias("bound"))


# --- chunks and Gram matrices -------------------------------------------------


def chunk_arrays(series: DataFrame, key: str, order: str, value: str, back: int, chunk: int = CHUNK) -> DataFrame:
    """(series_id, n, first, own, mean, scale, x): a chunk's values in order.

    ``first`` is the position of x[0] and ``own`` of the first row that is
    this chunk's own (earlier ones are context); x is (value - mean) / scale
    of the whole series, so Gram matrices don't cancel.
    """
    stats = series.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("scale"))
    s = series_positions(series.select(key, order, value), [key], order)
    s = s.join(stats, key).withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0))
    own = F.floor(F.col("_pos") / chunk)
    late = F.col("_pos") % chunk >= chunk - back
    s = s.withColumn("_c", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    s = s.where(F.col("_c") * chunk < F.col("_len"))
    x = ((F.col(value) - F.col("mean")) / F.col("scale")).cast("double").alias("x")
    g = s.groupBy(key, "_c").agg(F.first("_len").alias("n"), F.first("mean").alias("mean"), F.first("scale").alias("scale"),
                                 F.sort_array(F.collect_list(F.struct(F.col("_pos").alias("p"), x))).alias("r"))
    return g.select(F.col(key).alias("series_id"), "n", F.col("r")[0]["p"].alias("first"), (F.col("_c") * chunk).alias("own"),
                    "mean", "scale", F.transform("r", lambda e: e["x"]).alias("x"))


def gram_sums(chunks: DataFrame, design: Callable[[pd.Series], np.ndarray], head: int = 0, tail: int = 0) -> DataFrame:
    """(series_id, n, mean, scale, gram, head, tail): Z'Z summed over a series.

    ``design`` maps a chunk row to Z, one row for each own position that
    counts.  ``head`` and ``tail`` carry the series' first and last values.
    """
    kind = chunks.schema["series_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                z, x = design(r), np.asarray(r.x, float)
                last = r.first + len(x) == r.n
                out.append((r.series_id, r.n, r.mean, r.scale, (z.T @ z).ravel(), x[:head] if r.first == 0 else np.zeros(0),
                            x[max(0, len(x) - tail):] if last else np.zeros(0)))
            yield pd.DataFrame(out, columns=["series_id", "n", "mean", "scale", "gram", "head", "tail"])

    parts = chunks.mapInPandas(run, f"series_id {kind}, n long, mean double, scale double, gram array<double>, "
                                    "head array<double>, tail array<double>")
    cells = parts.select("series_id", F.posexplode("gram").alias("at", "v")).groupBy("series_id", "at").agg(F.sum("v").alias("v"))
    grams = cells.groupBy("series_id").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("g")).select(
        "series_id", F.transform("g", lambda e: e["v"]).alias("gram"))
    ends = parts.groupBy("series_id").agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("scale").alias("scale"),
        F.max_by("head", F.size("head")).alias("head"), F.max_by("tail", F.size("tail")).alias("tail"))
    return ends.join(grams, "series_id")


def per_series(sums: DataFrame, solve: Callable[[pd.Series], list[tuple]], columns: str) -> DataFrame:
    """Rows that ``solve`` gives for each series' sums (one small row per series)."""
    kind = sums.schema["series_id"].dataType.simpleString()
    names = ["series_id"] + [c.split()[0] for c in columns.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(r.series_id, *out) for r in pdf.itertuples(index=False) for out in solve(r)]
            yield pd.DataFrame(rows, columns=names)

    return sums.mapInPandas(run, f"series_id {kind}, {columns}")


def lag_columns(r, lags: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, [x_t, x_{t-1}, .., x_{t-lags}]) for own positions from ``start`` on."""
    x = np.asarray(r.x, float)
    t = np.arange(max(r.own, start, r.first + lags), r.first + len(x))
    return t, np.column_stack([x[t - r.first - j] for j in range(lags + 1)]) if len(t) else np.zeros((0, lags + 1))


def least_squares(gram: np.ndarray, ys: int, xs: list[int]) -> tuple[np.ndarray, float]:
    """Coefficients of column ``ys`` on ``xs`` and the residual sum of squares, from Z'Z."""
    beta = np.linalg.lstsq(gram[np.ix_(xs, xs)], gram[xs, ys], rcond=None)[0]
    return beta, max(float(gram[ys, ys] - beta @ gram[xs, ys]), 0.0)


def _square(r) -> np.ndarray:
    g = np.asarray(r.gram, float)
    return g.reshape(int(math.isqrt(len(g))), -1)


# --- partial autocorrelation and unit root --------------------------------------


def pacf(series: DataFrame, key: str, order: str, value: str, nlags: int = 5, chunk: int = CHUNK) -> DataFrame:
    """M2: (series_id, k, pacf): coefficient of lag k in the regression of x_t on
    1 and x_{t-1..t-k} over all rows that have these lags; NULL if there are
    too few."""

    def design(r) -> np.ndarray:
        _, z = lag_columns(r, nlags, nlags)
        return np.column_stack([np.ones(len(z)), z])

    def solve(r) -> list[tuple]:
        common, head, out = _square(r), np.asarray(r.head, float), []
        for k in range(1, nlags + 1):
            g, cols = common, [0, *range(2, k + 2)]
            # rows k .. nlags - 1 have k lags, but not all of them
            early = np.arange(k, min(nlags, len(head)))
            z = np.zeros((len(early), nlags + 2))
            z[:, 0] = 1
            for j in range(k + 1):
                z[:, 1 + j] = head[early - j]
            g = g + z.T @ z
            out.append((k, float(least_squares(g, 1, cols)[0][-1]) if r.n > 2 * k + 1 else float("nan")))
        return out

    sums = gram_sums(chunk_arrays(series, key, order, value, nlags, chunk), design, head=nlags + 1)
    return per_series(sums, solve, "k int, pacf double")


def adf_p_value(stat: float) -> float:
    """MacKinnon's approximate p-value of the test with a constant."""
    if stat <= ADF_P_MIN or stat >= ADF_P_MAX:
        return 0.0 if stat <= ADF_P_MIN else 1.0
    poly = ADF_P_SMALL if stat <= ADF_P_SPLIT else ADF_P_LARGE
    return 0.5 * math.erfc(-sum(c * stat ** i for i, c in enumerate(poly)) / math.sqrt(2))


def adf_max_lag(n: int) -> int:
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def _adf_design(r) -> np.ndarray:
    """[1, x_{t-1}, dx_{t-1} .. dx_{t-L}, dx_t] for the rows that have all L lags."""
    L = adf_max_lag(r.n)
    _, z = lag_columns(r, L + 1, L + 1)
    d = z[:, :-1] - z[:, 1:]
    return np.column_stack([np.ones(len(z)), z[:, 1], d[:, 1:], d[:, 0]])


def _adf_solve(r) -> list[tuple]:
    n, L, common, head = r.n, adf_max_lag(r.n), _square(r), np.asarray(r.head, float)
    if n < 6:
        return [(float("nan"), float("nan"), 0, 0, *[float("nan")] * 3)]
    y, rows, best = L + 2, n - L - 1, (math.inf, 0)
    for k in range(L + 1):
        rss = least_squares(common, y, list(range(k + 2)))[1]
        best = min(best, (rows * math.log(max(rss, 1e-300) / rows) + 2 * (k + 2), k))
    k = best[1]
    d = np.diff(head)
    extra = [[1, head[t - 1], *(d[t - 1 - j] for j in range(1, k + 1)), *[0.0] * (L - k), d[t - 1]] for t in range(k + 1, L + 1)]
    g, nobs, xs = common, rows + len(extra), list(range(k + 2))
    if extra:
        g = g + np.array(extra).T @ np.array(extra)
    beta, rss = least_squares(g, y, xs)
    cov = rss / (nobs - len(xs)) * np.linalg.pinv(g[np.ix_(xs, xs)])
    stat = float(beta[1] / math.sqrt(cov[1, 1])) if cov[1, 1] > 0 else float("nan")
    levels = [c[0] + c[1] / nobs + c[2] / nobs ** 2 + c[3] / nobs ** 3 for c in ADF_CV_CONST.values()]
    return [(stat, adf_p_value(stat) if stat == stat else float("nan"), k, nobs, *levels)]


def adf_test(series: DataFrame, key: str, order: str, value: str, chunk: int = CHUNK) -> DataFrame:
    """M3: augmented Dickey-Fuller test with a constant per series; the number of
    lags by AIC on a common sample, then all usable rows.  NULL below 6 rows."""
    longest = series.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    back = adf_max_lag(longest) + 1
    sums = gram_sums(chunk_arrays(series, key, order, value, back, chunk), _adf_design, head=back + 1)
    return per_series(sums, _adf_solve, "adf_stat double, p_value double, used_lag int, nobs int, "
                                        "cv_1 double, cv_5 double, cv_10 double")


# --- ARIMA by two regressions -----------------------------------------------------


def differences(z: np.ndarray, d: int) -> np.ndarray:
    """d-th differences along the lag columns (newest first)."""
    for _ in range(d):
        z = z[:, :-1] - z[:, 1:]
    return z


def long_ar_order(n: int, max_pq: int) -> int:
    """Lags of the first regression, which estimates the shocks."""
    return max(1, min(max(2 * max_pq, math.ceil(math.log(max(n, 2)) ** 2) // 2), n // 4))


def _shocks(series: DataFrame, key: str, order: str, value: str, d: int, max_pq: int, chunk: int) -> tuple[DataFrame, int]:
    """Chunks with the coefficients of the long autoregression of the d-th difference."""
    longest = series.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    back = long_ar_order(longest, max_pq) + max_pq + d
    chunks = chunk_arrays(series, key, order, value, back, chunk)

    def design(r) -> np.ndarray:
        m = long_ar_order(r.n - d, max_pq)
        y = differences(lag_columns(r, m + d, m + d)[1], d)
        return np.column_stack([np.ones(len(y)), y])

    def solve(r) -> list[tuple]:
        g = _square(r)
        return [(least_squares(g, 1, [0, *range(2, len(g))])[0].tolist(),)]

    ar = per_series(gram_sums(chunks, design), solve, "ar array<double>")
    return chunks.join(ar, "series_id"), back


def shocks_of(z: np.ndarray, ar: np.ndarray, count: int) -> np.ndarray:
    """Shocks e_{t-1} .. e_{t-count} from lag columns y_t, y_{t-1}, .. of a row."""
    m = len(ar) - 1
    return np.column_stack([z[:, j] - ar[0] - z[:, j + 1:j + 1 + m] @ ar[1:] for j in range(1, count + 1)]) if count else np.zeros((len(z), 0))


def _arma_sums(series: DataFrame, key: str, order: str, value: str, d: int, max_pq: int, chunk: int) -> DataFrame:
    """Gram sums of [1, y_{t-1}.., e_{t-1}.., y_t]: every (p, q) up to max_pq is a part of them."""
    chunks, back = _shocks(series, key, order, value, d, max_pq, chunk)

    def design(r) -> np.ndarray:
        m = long_ar_order(r.n - d, max_pq)
        y = differences(lag_columns(r, m + max_pq + d, m + max_pq + d)[1], d)
        return np.column_stack([np.ones(len(y)), y[:, 1:max_pq + 1], shocks_of(y, np.asarray(r.ar, float), max_pq), y[:, 0]])

    sums = gram_sums(chunks, design, tail=back + d + 1)
    return sums.join(chunks.groupBy("series_id").agg(F.first("ar").alias("ar")), "series_id")


def _arma_fit(r, d: int, p: int, q: int, max_pq: int) -> tuple[np.ndarray, float, int] | None:
    g = _square(r)
    xs, nobs = [0, *range(1, p + 1), *range(1 + max_pq, 1 + max_pq + q)], int(round(g[0, 0]))
    if nobs <= p + q + 2:
        return None
    beta, rss = least_squares(g, len(g) - 1, xs)
    return beta, rss, nobs


def arima_order_search(series: DataFrame, key: str, order: str, value: str, max_order: int = 3,
                       chunk: int = CHUNK) -> DataFrame:
    """M4 + M5: every (p, d, q) in 0..max_order with AIC and residual sum of
    squares; fits with too few rows are left out.  Rows are the same for every
    (p, q) of one d, and AIC is comparable only there: ``best_in_d`` marks the
    lowest of each (series, d)."""
    out = None
    for d in range(max_order + 1):
        def solve(r, d=d) -> list[tuple]:
            rows = []
            for p in range(max_order + 1):
                for q in range(max_order + 1):
                    if (fit := _arma_fit(r, d, p, q, max_order)) and fit[1] > 0:
                        rss, nobs = fit[1] * r.scale ** 2, fit[2]
                        rows.append((p, d, q, nobs * math.log(rss / nobs) + 2 * (p + q + 2), rss, nobs))
            return rows

        fits = per_series(_arma_sums(series, key, order, value, d, max_order, chunk), solve,
                          "p int, d int, q int, aic double, rss double, nobs int")
        out = fits if out is None else out.unionByName(fits)
    w = Window.partitionBy("series_id", "d").orderBy("aic", "p", "q")
    return out.withColumn("best_in_d", F.row_number().over(w) == 1)


def forecast(series: DataFrame, key: str, order: str, value: str, p: int, d: int, q: int, horizon: int,
             log_transform: bool = False, chunk: int = CHUNK) -> DataFrame:
    """M6: (series_id, step, forecast): ``horizon`` steps ahead with future shocks
    0, integrated d times; with ``log_transform`` fitted on log values and
    returned with exp().  Series with too few rows give no forecast."""
    max_pq = max(p, q, 1)
    data = series.withColumn(value, F.log(value)) if log_transform else series

    def solve(r) -> list[tuple]:
        fit, x, ar = _arma_fit(r, d, p, q, max_pq), np.asarray(r.tail, float), np.asarray(r.ar, float)
        if fit is None:
            return []
        levels = [x]
        for _ in range(d):
            levels.append(np.diff(levels[-1]))
        y, m = levels[-1].tolist(), len(ar) - 1
        e = [y[i] - ar[0] - sum(ar[1 + j] * y[i - 1 - j] for j in range(m)) if i >= m else 0.0 for i in range(len(y))]
        for _ in range(horizon):
            y.append(fit[0] @ np.array([1.0, *(y[-1 - j] for j in range(p)), *(e[-1 - j] for j in range(q))]))
            e.append(0.0)
        out = np.array(y[-horizon:])
        for level in reversed(levels[:-1]):
            out = level[-1] + np.cumsum(out)
        out = out * r.scale + r.mean
        return [(i + 1, float(math.exp(v) if log_transform else v)) for i, v in enumerate(out)]

    return per_series(_arma_sums(data, key, order, value, d, max_pq, chunk), solve, "step int, forecast double")


def add_back(detrended: DataFrame, trend: DataFrame, keys: list[str], value: str, mean: str) -> DataFrame:
    """M6: forecasts or fitted values of a detrended series plus its moving average."""
    return detrended.join(trend, keys).withColumn("restored", F.col(value) + F.col(mean))


def in_sample(series: DataFrame, key: str, order: str, value: str, p: int, d: int, q: int,
              chunk: int = CHUNK) -> DataFrame:
    """M6: (series_id, position, fitted): one-step predictions of the level for
    every row that has the lags the model needs."""
    max_pq = max(p, q, 1)
    coefs = per_series(_arma_sums(series, key, order, value, d, max_pq, chunk),
                       lambda r: [(f[0].tolist(),) if (f := _arma_fit(r, d, p, q, max_pq)) else ([],)], "beta array<double>")
    chunks, _ = _shocks(series, key, order, value, d, max_pq, chunk)
    kind = chunks.schema["series_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                beta, m = np.asarray(r.beta, float), long_ar_order(r.n - d, max_pq)
                t, z = lag_columns(r, m + max_pq + d, m + max_pq + d)
                if not len(beta) or not len(t):
                    continue
                y = differences(z, d)
                e = shocks_of(y, np.asarray(r.ar, float), max_pq)
                guess = np.column_stack([np.ones(len(y)), y[:, 1:p + 1], e[:, :q]]) @ beta
                # the guessed difference plus the known rest of the level: x_t - d-th difference of x_t
                yield pd.DataFrame({"series_id": r.series_id, "position": t,
                                    "fitted": (guess + z[:, 0] - y[:, 0]) * r.scale + r.mean})

    return chunks.join(coefs, "series_id").mapInPandas(run, f"series_id {kind}, position long, fitted double")
