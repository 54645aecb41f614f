"""ARIMA by conditional maximum likelihood, all orders of all series at once (M4, M5).

The shocks of an ARMA model follow from the values by a linear recursion, and so
do their derivatives.  Over a chunk of a series that recursion is an affine map
of the state it starts with (the last shocks and their derivatives), and affine
maps compose: a first scan gives each chunk's map, the maps of a series in order
give every chunk its starting state, and a second scan sums the normal equations.
So a long series is worked on by many tasks, and only maps, one a chunk, are
composed in order.

All orders (p, d, q) of all series take a damped Gauss-Newton step per pair of
scans.  Every fit speaks of the same observations (those after the first
``2 * max_order``, given them, earlier shocks zero), so likelihoods and AIC are
comparable over d as well.  Coefficients whose shocks explode give no finite sum
and are never accepted.  Orders that don't suit a series (a walk without
differences, a difference too many) may end before their minimum, with a larger
sum than they could have; they lose to suitable ones either way.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.timeseries import CHUNK, chunk_arrays
from tessera.session import scratch_dir


class Orders:
    """All orders up to m; parameters are (constant, m AR, m MA), absent ones masked."""

    def __init__(self, m: int):
        self.m = m
        self.list = [(p, d, q) for p in range(m + 1) for d in range(m + 1) for q in range(m + 1)]
        self.d = np.array([d for _, d, _ in self.list])
        self.mask = np.array([[1] + [i < p for i in range(m)] + [i < q for i in range(m)] for p, _, q in self.list], float)

    def __len__(self) -> int:
        return len(self.list)


def _inputs(x: np.ndarray, first: int, own: int, orders: Orders) -> np.ndarray:
    """(t, order, 1 + m): the d-th differences y_t, y_{t-1}, .. for the chunk's own positions that count."""
    m = orders.m
    t = np.arange(max(own, 2 * m), first + len(x)) - first
    by_d, y = [], x
    for _ in range(m + 1):
        by_d.append(np.stack([y[t - j] for j in range(m + 1)], 1) if len(t) else np.zeros((0, m + 1)))
        y = np.concatenate([[0.0], np.diff(y)])
    return np.stack(by_d, 1)[:, orders.d]


def _recursion(u: np.ndarray, params: np.ndarray, orders: Orders, e: np.ndarray, de: np.ndarray, flow: np.ndarray,
               keep: bool = False):
    """Run shocks and derivatives over a chunk from the states e (batch, order, lag) and de (.., lag, parameter).

    ``flow`` is 1 for a batch that takes the inputs and 0 for one that only passes its state on.
    """
    m = orders.m
    c, ar, ma = params[:, 0], params[:, 1:1 + m], params[:, 1 + m:]
    known = u[:, :, 0] - c - (u[:, :, 1:] * ar).sum(-1)
    base = np.concatenate([-np.ones((*u.shape[:2], 1)), -u[:, :, 1:]], -1)
    rows = []
    with np.errstate(all="ignore"):
        for t in range(len(u)):
            now = flow[:, None] * known[t] - (ma * e).sum(-1)
            change = np.concatenate([flow[:, None, None] * base[t], -e], -1) * orders.mask - np.einsum("ki,bkij->bkj", ma, de)
            if keep:
                rows.append(np.concatenate([change[0], now[0][:, None]], -1))
            e = np.concatenate([now[..., None], e[..., :-1]], -1)
            de = np.concatenate([change[:, :, None], de[:, :, :-1]], 2)
    return e, de, np.array(rows) if keep else None


def _chunk_map(u: np.ndarray, params: np.ndarray, orders: Orders) -> np.ndarray:
    """The affine map of a chunk: batch 0 from the zero state with inputs, the others from a unit shock without."""
    k, m = len(orders), orders.m
    e = np.zeros((1 + m, k, m))
    for j in range(m):
        e[1 + j, :, j] = 1
    flow = np.zeros(1 + m)
    flow[0] = 1
    e, de, _ = _recursion(u, params, orders, e, np.zeros((1 + m, k, m, 1 + 2 * m)), flow)
    return np.concatenate([e.ravel(), de.ravel()])


def _apply(chunk_map: np.ndarray, state: np.ndarray, orders: Orders) -> np.ndarray:
    k, m = len(orders), orders.m
    cut = (1 + m) * k * m
    e, de = chunk_map[:cut].reshape(1 + m, k, m), chunk_map[cut:].reshape(1 + m, k, m, 1 + 2 * m)
    se, sd = state[:k * m].reshape(k, m), state[k * m:].reshape(k, m, 1 + 2 * m)
    with np.errstate(all="ignore"):
        out_e = e[0] + np.einsum("kj,jki->ki", se, e[1:])
        # a derivative's own past decays like a shock's; past shocks also enter those of the MA part
        out_d = de[0] + np.einsum("kj,jkip->kip", se, de[1:]) + np.einsum("kjp,jki->kip", sd, e[1:])
    return np.concatenate([out_e.ravel(), out_d.ravel()])


def _step(gram: np.ndarray, mask: np.ndarray, damping: float) -> np.ndarray:
    """Damped Gauss-Newton step of one order from sums of [derivatives, shock] products."""
    own = mask > 0
    a, b = gram[:-1, :-1][np.ix_(own, own)], gram[:-1, -1][own]
    out = np.zeros(len(mask))
    out[own] = -np.linalg.lstsq(a + damping * np.diag(np.maximum(np.diag(a), 1e-12)), b, rcond=None)[0]
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arima_ml(series: DataFrame, key: str, order: str, value: str, max_order: int = 3, iterations: int = 12,
             chunk: int = CHUNK) -> DataFrame:
    """(series_id, p, d, q, constant, ar, ma, rss, nobs, aic, best): all orders of every series, the lowest AIC
    of a series marked (ties to the smaller p, d, q).

    AIC = nobs * (log(2 pi rss / nobs) + 1) + 2 * (p + q + 2).  Series with fewer than 2 * max_order + 12 values
    are left out; a constant series, whose shocks are zero, has no AIC and no best order.
    """
    orders = Orders(max_order)
    k, m, width = len(orders), max_order, 2 + 2 * max_order
    spark = series.sparkSession
    chunks = chunk_arrays(series, key, order, value, 2 * m, chunk).where(F.col("n") >= 2 * m + 12)
    chunks = _stored(chunks, "arima-chunks")
    kind = chunks.schema["series_id"].dataType.simpleString()
    size = k * (1 + 2 * m)
    # per series: trial coefficients, the best so far with their sums, and the damping of each order
    fits = _stored(chunks.select("series_id").distinct().select(
        "series_id", F.array_repeat(F.lit(0.0), size).alias("trial"), F.array_repeat(F.lit(0.0), size).alias("params"),
        F.array_repeat(F.lit(float("inf")), k * width * width).alias("sums"), F.array_repeat(F.lit(1e-3), k).alias("damping")),
        "arima-fits")

    def maps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"series_id": pdf["series_id"], "own": pdf["own"], "map": [
                _chunk_map(_inputs(np.asarray(r.x, float), r.first, r.own, orders), np.asarray(r.trial).reshape(k, -1), orders).tobytes()
                for r in pdf.itertuples(index=False)]})

    def states(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("own")
        state, out = np.zeros(k * m * (2 + 2 * m)), []
        for raw in pdf["map"]:
            out.append(state.tobytes())
            state = _apply(np.frombuffer(raw), state, orders)
        return pd.DataFrame({"series_id": pdf["series_id"], "own": pdf["own"], "state": out})

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict = {}
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                state = np.frombuffer(r.state)
                u = _inputs(np.asarray(r.x, float), r.first, r.own, orders)
                _, _, rows = _recursion(u, np.asarray(r.trial).reshape(k, -1), orders, state[:k * m].reshape(1, k, m),
                                        state[k * m:].reshape(1, k, m, 1 + 2 * m), np.ones(1), keep=True)
                with np.errstate(all="ignore"):
                    own = np.einsum("tki,tkj->kij", rows, rows) if len(rows) else np.zeros((k, width, width))
                found[r.series_id] = found.get(r.series_id, 0) + own
        yield pd.DataFrame([(s, g.tobytes()) for s, g in found.items()], columns=["series_id", "part"])

    def update(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        new = sum(np.frombuffer(p) for p in pdf["part"]).reshape(k, width, width)
        trial, params = (np.array(r[c], float).reshape(k, -1) for c in ("trial", "params"))
        best, damping = np.array(r["sums"], float).reshape(k, width, width), np.array(r["damping"], float)
        for i in range(k):
            if np.isfinite(new[i]).all() and not new[i, -1, -1] >= best[i, -1, -1]:
                best[i], params[i], damping[i] = new[i], trial[i], max(damping[i] / 10, 1e-9)
            else:
                damping[i] = min(damping[i] * 10, 1e9)
            trial[i] = params[i] + (_step(best[i], orders.mask[i], damping[i]) if np.isfinite(best[i]).all() else 0.0)
        return pd.DataFrame({"series_id": [r["series_id"]], "trial": [trial.ravel()], "params": [params.ravel()],
                             "sums": [best.ravel()], "damping": [damping]})

    for _ in range(iterations + 1):
        told = chunks.join(fits.select("series_id", "trial"), "series_id")
        mapped = told.select("series_id", "own", "first", "x", "trial").mapInPandas(maps, f"series_id {kind}, own long, map binary")
        starts = mapped.groupBy("series_id").applyInPandas(states, f"series_id {kind}, own long, state binary")
        parts = (told.join(_stored(starts, "arima-states"), ["series_id", "own"])
                 .select("series_id", "own", "first", "x", "trial", "state").mapInPandas(sums, f"series_id {kind}, part binary"))
        fits = _stored(fits.join(parts, "series_id").groupBy("series_id").applyInPandas(update, fits.schema), "arima-fits")

    scales = chunks.groupBy("series_id").agg(F.first("n").alias("n"), F.first("mean").alias("mean"), F.first("scale").alias("scale"))
    columns = ("p int, d int, q int, constant double, ar array<double>, ma array<double>, rss double, nobs long, aic double, "
               "best boolean")

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for r in pdf.itertuples(index=False):
                params, gram = np.asarray(r.params).reshape(k, -1), np.asarray(r.sums).reshape(k, width, width)
                nobs, rows = int(r.n - 2 * m), []
                for (p, d, q), w, g in zip(orders.list, params, gram):
                    rss = float(g[-1, -1]) * r.scale ** 2
                    aic = nobs * (math.log(2 * math.pi * rss / nobs) + 1) + 2 * (p + q + 2) if 0 < rss < math.inf else None
                    constant = float(w[0] * r.scale + (r.mean * (1 - w[1:1 + p].sum()) if d == 0 else 0.0))
                    rows.append([r.series_id, p, d, q, constant, w[1:1 + p].tolist(), w[1 + m:1 + m + q].tolist(), rss, nobs, aic, False])
                able = [x for x in rows if x[9] is not None]
                if able:
                    min(able, key=lambda x: (x[9], x[1:4]))[10] = True
                out += rows
            yield pd.DataFrame(out, columns=["series_id", *(c.split()[0] for c in columns.split(", "))])

    return fits.join(scales, "series_id").mapInPandas(report, f"series_id {kind}, {columns}")
