"""Histogram trees, forests, grids and boosting against plain numpy growth on the same bins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import hist_trees as H

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 700
    x = np.stack([rng.integers(0, 12, n).astype(float), rng.normal(size=n), rng.integers(0, 3, n).astype(float)], 1)
    y = 3 * (x[:, 0] > 5) + np.sin(2 * x[:, 1]) + x[:, 2] * (x[:, 1] > 0) + rng.normal(0, 0.2, n)
    rows = [(i, *map(float, r), float(t), int(i % 5), ["u", "v", None][i % 3]) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, fold int, seg string").repartition(5).cache()
    return df, x, y


def plain(x, w, y, depth, min_leaf, n_bins):
    """One tree by direct search: {node: (feature, cut) or value} in heap order."""
    tree = {}

    def go(node, rows, d):
        wr, yr = w[rows], y[rows]
        tree[node] = (None, (wr[:, None] * yr).sum(0) / wr.sum())
        best = None
        for f in range(x.shape[1]):
            for cut in range(n_bins - 1):
                left = x[rows, f] <= cut
                nl, nr = wr[left].sum(), wr[~left].sum()
                if min(nl, nr) < max(min_leaf, 1):
                    continue
                gain = (((wr[left, None] * yr[left]).sum(0) ** 2).sum() / nl + ((wr[~left, None] * yr[~left]).sum(0) ** 2).sum() / nr
                        - ((wr[:, None] * yr).sum(0) ** 2).sum() / wr.sum())
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, cut)
        if d and best and best[0] > 1e-9:
            tree[node] = (best[1:], tree[node][1])
            left = x[rows, best[1]] <= best[2]
            go(2 * node + 1, rows[left], d - 1)
            go(2 * node + 2, rows[~left], d - 1)

    go(0, np.flatnonzero(w > 0), depth)
    return tree


def guess(tree, x):
    out = []
    for r in x:
        node = 0
        while tree[node][0]:
            f, cut = tree[node][0]
            node = 2 * node + 1 + (r[f] > cut)
        out.append(tree[node][1])
    return np.array(out)


def bins_of(binning, x):
    return np.stack([1 + np.searchsorted(c, x[:, i]) for i, c in enumerate(binning.cuts)], 1)


def by_id(df, *cols):
    rows = sorted(df.select("id", *cols).collect())
    return [np.array([r[i + 1] for r in rows], object) for i in range(len(cols))]


def test_bins(spark, data):
    df, x, _ = data
    b = H.fit_bins(df, COLS, 16)
    assert b.cuts[0].tolist() == list(range(11)) and b.cuts[2].tolist() == [0.0, 1.0] and len(b.cuts[1]) == 15
    assert b.cuts[1] == pytest.approx(np.quantile(x[:, 1], np.round(np.arange(1, 16) / 16, 6)))
    odd = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (2.0, None)], "p double, q double")
    b = H.fit_bins(odd, ["p", "q"], 16)
    assert b.cuts[0].tolist() == [1.0] and b.cuts[1].tolist() == [] and b.size == 3


@pytest.mark.parametrize("depth,min_leaf", [(0, 1), (1, 1), (4, 1), (5, 25)])
def test_one_tree(data, depth, min_leaf):
    df, x, y = data
    f = H.fit_forest(df, COLS, "y", "id", 1, depth, min_leaf, bootstrap=False, bins=16)
    xb = bins_of(f.binning, x)
    tree = plain(xb, np.ones(len(x)), y[:, None], depth, min_leaf, f.binning.size)
    got, = by_id(f.transform(df), "prediction")
    assert got.astype(float) == pytest.approx(guess(tree, xb)[:, 0])
    assert depth == 0 or sum(f.importances()) == pytest.approx(1)


def test_forest_and_three_classes(data):
    df, x, y = data
    kind = np.digitize(y, [0.5, 2.5])
    df = df.withColumn("k", F.when(F.col("y") < 0.5, "low").when(F.col("y") < 2.5, "mid").otherwise("top"))
    f = H.fit_forest(df, COLS, "k", "id", 6, 4, 3, classes=["low", "mid", "top"], bins=16)
    xb, total = bins_of(f.binning, x), 0
    for s in f.specs:
        w = H._bootstrap(np.arange(len(x)), s.seed)
        total = total + guess(plain(xb, w, np.eye(3)[kind], 4, 3, f.binning.size), xb)
    got, share = by_id(f.transform(df), "prediction", "share")
    assert share.astype(float) == pytest.approx(total.max(1) / 6)
    near = np.sort(total, 1)[:, -1] - np.sort(total, 1)[:, -2] < 1e-9
    assert ((got == np.array(["low", "mid", "top"])[total.argmax(1)]) | near).all()
    assert (got == np.array(["low", "mid", "top"])[kind]).mean() > 0.8


def test_waves_of_few_nodes_give_the_same_trees(data, monkeypatch):
    df, _, _ = data
    one = H.fit_forest(df, COLS, "y", "id", 3, 6, 4, bins=16)
    monkeypatch.setattr(H, "MAX_CELLS", 18 * 3 * 2 * 4)
    two = H.fit_forest(df, COLS, "y", "id", 3, 6, 4, bins=16)
    a, b = (by_id(f.transform(df), "prediction")[0].astype(float) for f in (one, two))
    assert a == pytest.approx(b)
    monkeypatch.setattr(H, "MAX_NODES", 5)
    with pytest.raises(ValueError):
        H.fit_forest(df, COLS, "y", "id", 3, 6, 4, bins=16)


def test_bootstrap_is_poisson():
    w = H._bootstrap(np.arange(200_000), 3)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(w, H._bootstrap(np.arange(200_000), 4))[0, 1]) < 0.01


def test_features_per_node(data):
    df, _, _ = data
    f = H.fit_forest(df, COLS, "y", "id", 8, 3, max_features=1, bins=16)
    assert {int(v[0]) for v in f.trees.feature} == {0, 1, 2}


def test_segments_in_the_scans_of_one_tree(data):
    df, x, y = data
    f = H.fit_segments(df, COLS, "y", "id", "seg", 3, 4, bins=16)
    assert f.segments == {"u": 0, "v": 1}
    xb = bins_of(f.binning, x)
    expected = np.full(len(x), np.nan)
    for name, i in f.segments.items():
        own = np.arange(len(x)) % 3 == i
        total = 0
        for s in f.specs[3 * i:3 * i + 3]:
            total = total + guess(plain(xb, np.where(own, H._bootstrap(np.arange(len(x)), s.seed), 0), y[:, None], 4, 1, f.binning.size), xb)[:, 0]
        expected[own] = total[own] / 3
    got, = by_id(f.transform(df), "prediction")
    assert [g is None for g in got] == np.isnan(expected).tolist()
    assert got[~np.isnan(expected)].astype(float) == pytest.approx(expected[~np.isnan(expected)])


def test_grid_equals_separate_fits(data):
    df, x, y = data
    grid = H.forest_grid(df, COLS, "y", "id", F.col("fold"), 5, [1, 3], [1, 40], bins=16)
    got = {(r["max_depth"], r["min_leaf"]): r for r in grid.collect()}
    xb, fold = bins_of(H.fit_bins(df, COLS, 16), x), np.arange(len(x)) % 5
    for (depth, leaf), r in got.items():
        error = 0.0
        for f in range(5):
            tree = plain(xb, (fold != f).astype(float), y[:, None], depth, leaf, 18)
            error += ((y[fold == f] - guess(tree, xb[fold == f])[:, 0]) ** 2).sum()
        assert r["n"] == len(x) and r["mse"] == pytest.approx(error / len(x)) and r["r2"] == pytest.approx(1 - error / len(x) / y.var())
    sized = H.forest_grid(df, COLS, "y", "id", F.col("fold"), 5, [3], [1], [2, 5], bins=16).collect()
    one = H.forest_grid(df, COLS, "y", "id", F.col("fold"), 5, [3], [1], [2], bins=16).first()
    assert {r["n_trees"]: r["mse"] for r in sized}[2] == pytest.approx(one["mse"])


def test_boosting_by_hand(data):
    df, x, y = data
    settings = [H.BoostSetting(2, 1.0, 0.3), H.BoostSetting(1, 2.5, 0.1)]
    model = H.boost(df, COLS, "y", settings, n_trees=12, holdout=F.col("fold") == 0, bins=16)
    train = np.arange(len(x)) % 5 != 0
    xb = bins_of(model.binning, x)
    history = {(h[0], h[3]): h for h in model.history}
    for m, s in enumerate(settings):
        f = np.full(len(x), y[train].mean())
        for n in range(13):
            r = y - f
            h = history[m, n]
            assert h[4:8] == pytest.approx((np.abs(r[train]).mean(), np.sqrt((r[train] ** 2).mean()), np.abs(r[~train]).mean(),
                                            np.sqrt((r[~train] ** 2).mean())))
            assert h[8] == pytest.approx(r[~train & (r >= 0)].mean()) and h[9] == pytest.approx(-r[~train & (r < 0)].mean())
            tree = plain(xb, train.astype(float), np.where(r > 0, s.eta * r, r)[:, None], s.max_depth, 1, model.binning.size)
            if n < 12:
                f = f + s.learning_rate * guess(tree, xb)[:, 0]
        got, = by_id(model.transform(df), f"prediction_{m}")
        assert got.astype(float) == pytest.approx(f)


def test_early_stop_keeps_the_best_round(data):
    df, _, _ = data
    model = H.boost(df, COLS, "y", [H.BoostSetting(4, 1.0, 0.5), H.BoostSetting(1, 1.0, 0.5), H.BoostSetting(3, 2.0, 0.3)],
                    n_trees=40, holdout=F.col("fold") == 0, patience=4, bins=16)
    errors = {}
    for h in model.history:
        errors.setdefault(h[0], []).append(h[7])
    for m in (0, 1):
        assert len(model.rounds[m]) == int(np.argmin(errors[m])) or len(errors[m]) == 41
    assert len(errors[0]) < 41 and len(errors[2]) > 5


def test_edges(spark):
    schema = "id long, a double, b double, y double"
    empty = spark.createDataFrame([], schema)
    assert H.fit_forest(empty, ["a", "b"], "y", "id", 2, 2).transform(empty).collect() == []
    assert H.boost(empty, ["a"], "y", [H.BoostSetting()], 3).history == []
    rows = [(1, None, float("nan"), 1.0), (2, 1.0, 1.0, None), (3, None, 2.0, 3.0), (3, None, 2.0, 3.0), (None, 5.0, 5.0, 9.0)]
    df = spark.createDataFrame(rows, schema)
    got = H.fit_forest(df.where("id IS NOT NULL"), ["a", "b"], "y", "id", 1, 3, bootstrap=False).transform(df)
    assert [r["prediction"] for r in got.orderBy("id", "y").collect() if r["id"] in (1, 3)] == [1.0, 3.0, 3.0]
    same = spark.createDataFrame([(i, 1.0, 1.0, 2.0) for i in range(5)], schema)
    assert {r["prediction"] for r in H.fit_forest(same, ["a", "b"], "y", "id", 1, 3, bootstrap=False).transform(same).collect()} == {2.0}


@pytest.mark.parametrize("tried", [None, 2])
def test_small_nodes_take_one_scan_and_the_same_splits(spark, data, monkeypatch, tried):
    df, _, _ = data
    scans = []
    partials = H._partials
    monkeypatch.setattr(H, "_partials", lambda *a, **k: scans.append(1) or partials(*a, **k))
    rows = []
    for small in (H.SMALL, 100, 0):
        monkeypatch.setattr(H, "SMALL", small)
        scans.clear()
        grid = H.forest_grid(df, COLS, "y", "id", F.col("fold"), 5, [2, 9], [3], max_features=[tried], folds=[0, 1], bins=16)
        rows.append([tuple(r) for r in grid.drop("max_features").orderBy("max_depth").collect()])
        assert len(scans) == (1 if small > 700 else len(scans))
    assert len(scans) > 5
    for other in rows[1:]:
        for a, b in zip(rows[0], other):
            assert a == pytest.approx(b, rel=1e-9)


def test_equal_splits_go_to_the_first_feature(spark):
    # both features part the rows alike; sums of these targets depend on their order
    rng = np.random.default_rng(2)
    x = rng.permutation(40).reshape(-1, 1).repeat(2, 1).astype(np.int16)
    y = rng.normal(1e5, 3e4, (40, 1))
    t = H._subtree(x, np.ones(40), y, 20, H.Spec(1), 64)
    assert set(t.feature[0].tolist()) == {-1, 0} and (t.feature[0] == -1).sum() == 40
    assert sorted(t.value[0][t.low[0] == 0][:, 0]) == pytest.approx(sorted(y[:, 0]))
