"""Time series by sums over chunks: the same numbers as direct numpy fits."""

import math

import numpy as np
import pytest

from tessera.operators import ordered as O
from tessera.operators import timeseries as TS


@pytest.fixture(scope="module")
def walks():
    rng = np.random.default_rng(4)
    ar = [0.0, 0.0]
    for e in rng.normal(size=400):
        ar.append(0.6 * ar[-1] - 0.3 * ar[-2] + e)
    return {"ar": 1e6 + np.array(ar[2:]), "walk": np.cumsum(rng.normal(size=250)), "short": np.arange(5.0)}


@pytest.fixture(scope="module")
def frame(spark, walks):
    rows = [(k, i, float(x)) for k, v in walks.items() for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "s string, t int, x double").repartition(5)


def fit(y, *cols):
    z = np.column_stack([np.ones(len(y)), *cols])
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    return beta, y - z @ beta, z


@pytest.mark.parametrize("chunk", [32, 1 << 16])
def test_pacf(frame, walks, chunk):
    got = {(r["series_id"], r["k"]): r["pacf"] for r in TS.pacf(frame, "s", "t", "x", 4, chunk).collect()}
    for s in ("ar", "walk"):
        x = walks[s] - walks[s].mean()
        for k in range(1, 5):
            beta, _, _ = fit(x[k:], *[x[k - j:len(x) - j] for j in range(1, k + 1)])
            assert got[s, k] == pytest.approx(beta[-1], abs=1e-8)
    assert got["short", 4] is None


@pytest.mark.parametrize("chunk", [32, 1 << 16])
def test_adf(frame, walks, chunk):
    got = {r["series_id"]: r for r in TS.adf_test(frame, "s", "t", "x", chunk).collect()}
    for s in ("ar", "walk"):
        x = walks[s] - walks[s].mean()
        d, n, L = np.diff(x), len(x), TS.adf_max_lag(len(x))

        def design(k, start):
            return d[start:], x[start:-1], *[d[start - j:len(d) - j] for j in range(1, k + 1)]

        def aic(k):
            r = fit(*design(k, L))[1]
            return len(r) * math.log(r @ r / len(r)) + 2 * (k + 2)

        k = min(range(L + 1), key=aic)
        beta, r, z = fit(*design(k, k))
        se = math.sqrt(r @ r / (len(r) - k - 2) * np.linalg.inv(z.T @ z)[1, 1])
        assert got[s]["used_lag"] == k and got[s]["nobs"] == len(r)
        assert got[s]["adf_stat"] == pytest.approx(beta[1] / se, rel=1e-6)
    assert got["ar"]["p_value"] < 0.01 and got["walk"]["p_value"] > 0.05


def test_adf_p_values():
    # published: the critical values of large samples have p = 1, 5 and 10 %
    for stat, p in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (-1.70, 0.43)):
        assert TS.adf_p_value(stat) == pytest.approx(p, abs=0.003)
    assert TS.adf_p_value(-20) == 0 and TS.adf_p_value(3) == 1


@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_arima(frame, walks, chunk):
    rows = TS.arima_order_search(frame, "s", "t", "x", 3, chunk).collect()
    got = {(r["series_id"], r["p"], r["d"], r["q"]): r for r in rows}
    assert sum(r["series_id"] == "ar" for r in rows) == 64
    x = walks["ar"]
    for d in (0, 1):
        y = np.diff(x, d) if d else x - x.mean()
        m = TS.long_ar_order(len(y), 3)
        e = np.zeros(len(y))
        e[m:] = fit(y[m:], *[y[m - j:len(y) - j] for j in range(1, m + 1)])[1]
        s = m + 3
        for p, q in ((0, 0), (2, 0), (1, 1), (3, 3)):
            r = fit(y[s:], *[y[s - j:len(y) - j] for j in range(1, p + 1)], *[e[s - j:len(y) - j] for j in range(1, q + 1)])[1]
            assert got["ar", p, d, q]["rss"] == pytest.approx(r @ r, rel=1e-6)
            assert got["ar", p, d, q]["nobs"] == len(r)
    best = [r for r in rows if r["series_id"] == "ar" and r["best_in_d"]]
    assert len(best) == 4 and min(best, key=lambda r: r["d"])["p"] >= 1


def test_forecast_and_in_sample(spark, frame, walks):
    t = np.arange(300)
    line = spark.createDataFrame([("l", int(i), float(5 + 2 * i)) for i in t], "s string, t int, x double")
    ahead = [r["forecast"] for r in TS.forecast(line, "s", "t", "x", 0, 1, 0, 4).orderBy("step").collect()]
    assert ahead == pytest.approx([5 + 2 * i for i in range(300, 304)], rel=1e-9)
    grown = spark.createDataFrame([("g", int(i), float(np.exp(0.01 * i))) for i in t], "s string, t int, x double")
    ahead = [r["forecast"] for r in TS.forecast(grown, "s", "t", "x", 0, 1, 0, 2, log_transform=True).orderBy("step").collect()]
    assert ahead == pytest.approx([math.exp(3.0), math.exp(3.01)], rel=1e-9)
    x = walks["ar"]
    fitted = {r["position"]: r["fitted"] for r in TS.in_sample(frame.where("s = 'ar'"), "s", "t", "x", 2, 0, 0, 64).collect()}
    err = np.array([x[p] - f for p, f in fitted.items()])
    assert len(fitted) > 350 and err.std() == pytest.approx(1.0, abs=0.15) and abs(err.mean()) < 0.05


@pytest.mark.parametrize("chunk", [4, 50])
def test_windows_over_chunks(frame, walks, chunk):
    r = {(v["s"], v["t"]): v for v in O.rolling_stats(frame, "s", "t", "x", 4, chunk).collect()}
    lag = {(v["s"], v["t"]): v for v in O.lags_and_diffs(frame, "s", "t", "x", 2, 2, chunk).collect()}
    assert len(r) == len(lag) == sum(map(len, walks.values()))
    for s, x in walks.items():
        for t in range(len(x)):
            if t < 3:
                assert r[s, t]["rolling_mean"] is None
            else:
                assert r[s, t]["rolling_mean"] == pytest.approx(x[t - 3:t + 1].mean())
                assert r[s, t]["rolling_std"] == pytest.approx(x[t - 3:t + 1].std(ddof=1), rel=1e-6)
            assert lag[s, t]["lag_2"] == (x[t - 2] if t > 1 else None)
            if t > 1:
                assert lag[s, t]["diff_2"] == pytest.approx(x[t] - 2 * x[t - 1] + x[t - 2], abs=1e-6)


def test_hot_value_uses_all_tasks(spark):
    """Quantiles of a column with three values: sorted rows are distinct values, not rows."""
    df = spark.range(200_000, numPartitions=8).selectExpr("cast(id % 3 as double) as v", "id % 2 as g")
    counts = O.value_counts(df, "v", ["g"])
    assert counts.count() == 6
    q = O.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()
    assert {(r["g"], r["q_0.5"]) for r in q} == {(0, 1.0), (1, 1.0)}
