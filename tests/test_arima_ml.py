"""ARIMA by likelihood: the chunked recursion against a plain one, known coefficients, one order over all 64."""

import numpy as np
import pytest

from tessera.operators import arima_ml as A


def plain_shocks(x, p, d, q, constant, ar, ma, skip):
    """Shocks after the first ``skip`` values, one by one."""
    y = np.array(x, float)
    for _ in range(d):
        y = np.concatenate([[0.0], np.diff(y)])
    e = np.zeros(len(y))
    for t in range(skip, len(y)):
        e[t] = y[t] - constant - sum(ar[j] * y[t - 1 - j] for j in range(p)) - sum(ma[j] * e[t - 1 - j] for j in range(q))
    return e[skip:]


def made(seed, n, ar=(), ma=(), constant=0.0, d=0):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(3, n + 50):
        y[t] = constant + sum(a * y[t - 1 - j] for j, a in enumerate(ar)) + e[t] + sum(b * e[t - 1 - j] for j, b in enumerate(ma))
    y = y[50:]
    for _ in range(d):
        y = np.cumsum(y)
    return y


@pytest.fixture(scope="module")
def fitted(spark):
    series = {"arma": made(1, 1500, [0.6], [0.4], 2.0), "walk": made(2, 1500, [0.5], [], 0.0, 1), "ma2": made(3, 1500, [], [0.5, 0.3]),
              "short": made(4, 10), "same": np.full(60, 5.0)}
    rows = [(s, i, float(v)) for s, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "s string, t long, x double").repartition(5)
    return series, df, A.arima_ml(df, "s", "t", "x", 2, chunk=400).collect()


def test_recursion_over_chunks_is_the_plain_one(fitted):
    series, _, rows = fitted
    for r in rows:
        if r["aic"] is None:
            continue
        e = plain_shocks(series[r["series_id"]], r["p"], r["d"], r["q"], r["constant"], r["ar"], r["ma"], 4)
        assert r["nobs"] == len(e) and r["rss"] == pytest.approx((e ** 2).sum(), rel=1e-6)
        assert r["aic"] == pytest.approx(len(e) * (np.log(2 * np.pi * r["rss"] / len(e)) + 1) + 2 * (r["p"] + r["q"] + 2))


def test_fits_are_at_a_minimum(fitted):
    series, _, rows = fitted
    rng = np.random.default_rng(0)
    for r in rows:
        # a walk without differences pushes the shocks' part to its bound, slowly; a difference too many as well
        if r["aic"] is None or r["d"] != (r["series_id"] == "walk") or r["p"] + r["q"] > 2:
            continue
        x = series[r["series_id"]]
        for _ in range(6):
            ar, ma = (np.array(r[c]) + rng.normal(0, 0.03, len(r[c])) for c in ("ar", "ma"))
            shift = r["constant"] + rng.normal(0, 0.03)
            if r["ar"] or r["ma"]:
                assert (plain_shocks(x, r["p"], r["d"], r["q"], shift, ar, ma, 4) ** 2).sum() >= r["rss"] * (1 - 1e-4)


def test_known_coefficients_and_one_best_order(fitted):
    _, _, rows = fitted
    best = {r["series_id"]: r for r in rows if r["best"]}
    assert set(best) == {"arma", "walk", "ma2"} and {r["series_id"] for r in rows} == {"arma", "walk", "ma2", "same"}
    at = {(r["series_id"], r["p"], r["d"], r["q"]): r for r in rows}
    one = at["arma", 1, 0, 1]
    assert one["ar"] == pytest.approx([0.6], abs=0.07) and one["ma"] == pytest.approx([0.4], abs=0.08)
    assert one["constant"] == pytest.approx(2.0, abs=0.4) and one["rss"] / one["nobs"] == pytest.approx(1, abs=0.1)
    assert at["walk", 1, 1, 0]["ar"] == pytest.approx([0.5], abs=0.07)
    assert at["ma2", 0, 0, 2]["ma"] == pytest.approx([0.5, 0.3], abs=0.08)
    for s, order in (("arma", (1, 0, 1)), ("walk", (1, 1, 0)), ("ma2", (0, 0, 2))):
        assert best[s]["aic"] <= at[s, *order]["aic"] <= best[s]["aic"] + 8
    assert best["walk"]["d"] >= 1 or sum(best["walk"]["ar"]) > 0.95


def test_chunk_length_changes_nothing(fitted):
    _, df, rows = fitted
    whole = {(r["series_id"], r["p"], r["d"], r["q"]): r["rss"] for r in A.arima_ml(df, "s", "t", "x", 2, chunk=5000).collect()}
    for r in rows:
        assert r["rss"] == pytest.approx(whole[r["series_id"], r["p"], r["d"], r["q"]], rel=1e-4, abs=1e-9)


def test_empty(spark):
    assert A.arima_ml(spark.createDataFrame([], "s string, t long, x double"), "s", "t", "x", 1, 2).collect() == []
