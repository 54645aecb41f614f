"""A dense net with relu units and one sigmoid output for two classes.

Every round is one Spark job: each task adds up the gradient of its training
rows and a histogram of the scores of its holdout rows, Spark sums both, and
the driver, which holds the weights only, takes an Adam step.  Training ends
when the holdout AUC has not grown for some rounds; the best weights count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Bins of the holdout scores; pairs within a bin count half in the AUC.
BINS = 4096


def initial_weights(layers: list[int], seed: int) -> np.ndarray:
    """Flat weights, normal with variance 2 / inputs (relu), biases 0."""
    rng = np.random.default_rng(seed)
    return np.concatenate([np.concatenate([rng.normal(0, np.sqrt(2 / a), a * b), np.zeros(b)])
                           for a, b in zip(layers, layers[1:])])


def _unpack(w: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(layers, layers[1:]):
        out.append((w[at:at + a * b].reshape(a, b), w[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def _forward(w: np.ndarray, layers: list[int], x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """What enters every layer, and the output before the sigmoid."""
    entering = []
    for m, b in _unpack(w, layers):
        entering.append(x)
        z = x @ m + b
        x = np.maximum(z, 0)
    return entering, z[:, 0]


def probability(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def loss_and_gradient(w: np.ndarray, layers: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum over rows of the cross entropy, and its gradient."""
    entering, z = _forward(w, layers, x)
    back = (probability(z) - y)[:, None]
    parts: list[np.ndarray] = []
    for (m, _), h in zip(reversed(_unpack(w, layers)), reversed(entering)):
        parts[:0] = [(h.T @ back).ravel(), back.sum(0)]
        back = (back @ m.T) * (h > 0)  # relu passes on what it let through
    return float((np.logaddexp(0, z) - y * z).sum()), np.concatenate(parts)


def binned_auc(pos: np.ndarray, neg: np.ndarray) -> tuple[float, float]:
    """AUC of score histograms, and how far it can be from that of the scores."""
    pairs = pos.sum() * neg.sum()
    if not pairs:
        return 0.5, 0.5
    below = neg.cumsum() - neg
    return float((pos * (below + neg / 2)).sum() / pairs), float((pos * neg).sum() / 2 / pairs)


class ReluNet:
    """Fitted net: weights, scaling, and (round, loss, auc, auc_error) of every round."""

    def __init__(self, layers, weights, mean, scale, history):
        self.layers, self.weights, self.mean, self.scale, self.history = layers, weights, mean, scale, history

    def score(self, x: np.ndarray) -> np.ndarray:
        return probability(_forward(self.weights, self.layers, (x - self.mean) / self.scale)[1])

    def transform(self, df: DataFrame, vec: str, out: str = "probability") -> DataFrame:
        """Adds the probability of class 1; null where a feature is null or no number."""
        net, dim = self, self.layers[0]

        @F.pandas_udf("double")
        def predict(col: pd.Series) -> pd.Series:
            ok = np.array([v is not None and len(v) == dim for v in col], bool)
            p = np.full(len(col), np.nan)
            if ok.any():
                p[ok] = net.score(np.stack([np.asarray(v, float) for v in col[ok]]))
            return pd.Series(pd.arrays.FloatingArray(p, np.isnan(p)))
        return df.withColumn(out, predict(F.col(vec).cast("array<double>")))


def _sums(w: np.ndarray, layers: list[int], mean: np.ndarray, scale: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pos, neg = np.zeros(len(w) + 1), np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, layers[0])
            x, y, held = (x - mean) / scale, b.column("y").to_numpy(), b.column("held").to_numpy(zero_copy_only=False)
            loss, grad = loss_and_gradient(w, layers, x[~held], y[~held])
            total += np.append(grad, loss)
            at = np.minimum(probability(_forward(w, layers, x[held])[1]) * BINS, BINS - 1).astype(int)
            pos += np.bincount(at, y[held], BINS)
            neg += np.bincount(at, 1 - y[held], BINS)
        cells = np.concatenate([total, pos, neg])
        key = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(cells[key])], names=["key", "value"])
    return step


def fit_relu_net(df: DataFrame, vec: str, label: str, held, hidden: list[int] = [10, 10], rounds: int = 60,
                 rate: float = 0.03, patience: int = 8, least_gain: float = 1e-4, seed: int = 1) -> ReluNet:
    """Fit on the rows where the condition ``held`` is false, stop by the AUC of the others.

    ``label`` is 0 or 1.  Rows with a null or non-finite feature or a null
    label take no part; without training rows it is an error.  Without both
    classes among the held rows the AUC is 0.5 and training ends after
    ``patience`` rounds.  Features are centred and scaled by the training rows;
    a constant one is only centred.
    """
    v = F.col(vec).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = cut_lineage(df.where(F.coalesce(finite, F.lit(False)) & F.col(label).isNotNull())
                       .select(v.alias("x"), F.col(label).cast("double").alias("y"), F.coalesce(held, F.lit(False)).alias("held")))
    train = rows.where(~F.col("held"))
    dim = (train.select(F.size("x").alias("n")).first() or [0])[0]
    if not dim:
        raise ValueError("no training rows")
    slot = [F.get("x", F.lit(i)) for i in range(dim)]
    stat = train.agg(F.count(F.lit(1)), *[F.avg(s) for s in slot], *[F.stddev_pop(s) for s in slot]).first()
    n, mean, scale = stat[0], np.array(stat[1:dim + 1]), np.array(stat[dim + 1:])
    scale[scale == 0] = 1.0
    layers = [dim, *hidden, 1]
    w = initial_weights(layers, seed)
    best, best_auc, since, history = w, -1.0, 0, []
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(rounds):
        cells = np.zeros(len(w) + 1 + 2 * BINS)
        sums = rows.mapInArrow(_sums(w, layers, mean, scale), "key long, value double")
        for r in sums.groupBy("key").agg(F.sum("value").alias("value")).collect():  # weights and bins, no more
            cells[r["key"]] = r["value"]
        grad, loss = cells[:len(w)] / n, cells[len(w)] / n
        auc, error = binned_auc(cells[len(w) + 1:len(w) + 1 + BINS], cells[len(w) + 1 + BINS:])
        history.append((t, loss, auc, error))
        since += 1
        if auc > best_auc + least_gain:
            best, best_auc, since = w, auc, 0
        if since >= patience:
            break
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad ** 2
        w = w - rate * (m1 / (1 - 0.9 ** (t + 1))) / (np.sqrt(m2 / (1 - 0.999 ** (t + 1))) + 1e-8)
    return ReluNet(layers, best, mean, scale, history)
