"""Relu net and kernel margin: gradients, known functions, measured errors."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from tessera.operators import kernel_margin as K
from tessera.operators import relu_net as N


def ring(n=1200, seed=4):
    """Class 1 inside a ring: no line parts the classes."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 2))
    return x, (np.hypot(*x.T) < 0.75).astype(float)


@pytest.fixture(scope="module")
def table(spark):
    x, y = ring()
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    rows += [(5000, None, 1.0), (5001, [1.0, float("nan")], 0.0), (5002, [0.1, None], 0.0), (5003, [0.1, 0.2], None)]
    return spark.createDataFrame(rows, "id long, vec array<double>, label double").repartition(4)


def test_gradient_equals_differences():
    rng = np.random.default_rng(0)
    layers = [3, 5, 4, 1]
    w, x, y = N.initial_weights(layers, 1) + 0.01, rng.normal(size=(20, 3)), rng.integers(0, 2, 20)
    _, grad = N.loss_and_gradient(w, layers, x, y)
    for i in range(len(w)):
        e = np.zeros_like(w)
        e[i] = 1e-6
        slope = (N.loss_and_gradient(w + e, layers, x, y)[0] - N.loss_and_gradient(w - e, layers, x, y)[0]) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-4)


def test_binned_auc():
    rng = np.random.default_rng(1)
    p, y = np.round(rng.random(300), 2), rng.integers(0, 2, 300)
    at = np.minimum(p * N.BINS, N.BINS - 1).astype(int)
    auc, error = N.binned_auc(np.bincount(at, y, N.BINS), np.bincount(at, 1 - y, N.BINS))
    d = p[y == 1][:, None] - p[y == 0][None]
    assert auc == pytest.approx(((d > 0) + 0.5 * (d == 0)).mean()) and error < 0.01
    assert N.binned_auc(np.zeros(4), np.ones(4)) == (0.5, 0.5)


def test_net_learns_a_ring_and_stops(spark, table):
    held = F.col("id") % 4 == 0
    net = N.fit_relu_net(table, "vec", "label", held, rounds=50, rate=0.05)
    assert net.layers == [2, 10, 10, 1] and max(h[2] for h in net.history) > 0.97 and net.history[0][2] < 0.9
    assert net.history[-1][1] < net.history[0][1] / 2
    got = {r["id"]: r["probability"] for r in net.transform(table, "vec").collect()}
    x, y = ring()
    assert [got[i] for i in range(1200)] == pytest.approx(list(net.score(x)))
    assert got[5000] is None and got[5001] is None and got[5002] is None and got[5003] is not None
    assert np.mean((np.array([got[i] for i in range(0, 1200, 4)]) > 0.5) == y[::4]) > 0.9


def test_net_stops_without_two_classes(spark, table):
    net = N.fit_relu_net(table, "vec", "label", (F.col("id") % 4 == 0) & (F.col("label") == 1), rounds=30, patience=3)
    assert len(net.history) == 4
    with pytest.raises(ValueError, match="no training rows"):
        N.fit_relu_net(table.limit(0), "vec", "label", F.lit(False))


def test_kernel_features(spark, table):
    good = table.where("id < 5000")
    errors = []
    for m in (8, 64):
        fitted = K.fit_kernel_features(table, "id", "vec", m, 0.7)
        x, _ = ring()
        z, s = fitted.of(x), (x - fitted.mean) / fitted.scale
        errors.append(fitted.kernel_error(table, "vec"))
        rest = K.gaussian(s, s, 0.7) - z @ z.T
        assert np.linalg.eigvalsh(rest).min() > -1e-6
        # one finite row (5003) has no label but is measured too
        assert errors[-1] == pytest.approx(np.trace(rest) / 1200, abs=2e-3)
    assert errors[1] < errors[0] / 5 and errors[1] < 0.01
    svm = lambda col: LinearSVC(featuresCol=col, regParam=1e-4, maxIter=50)
    z = fitted.transform(good, "vec").withColumn("plain", K.array_to_vector("vec"))
    right = lambda m: m.transform(z).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right(svm("kernel").fit(z)) > 0.95 and right(svm("plain").fit(z)) < 0.7


def test_kernel_edges(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id long, vec array<double>")
    fitted = K.fit_kernel_features(same, "id", "vec", 10)
    assert fitted.map.shape == (5, 1) and fitted.kernel_error(same, "vec") == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError, match="no rows"):
        K.fit_kernel_features(same.limit(0), "id", "vec")
