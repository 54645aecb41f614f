"""Trees on sums by cell against the trees that hist_trees grows on the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cell_trees as C
from tessera.operators import hist_trees as H

COLS = ["a", "b"]


@pytest.fixture(scope="module")
def data(spark):
    """3,000 rows in at most 14 x 10 cells; a null feature, a null target, a null fold and rows of one id among them."""
    rng = np.random.default_rng(8)
    n = 3000
    a, b = rng.integers(0, 12, n).astype(float), rng.normal(size=n)
    y = 40 + 3 * (a > 5) + np.sin(2 * b) + rng.normal(0, 0.5, n)
    rows = [(i // 2, None if i % 50 == 0 else float(a[i]), float(b[i]), None if i % 70 == 0 else float(y[i]),
             None if i % 90 == 0 else int(i % 4)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, fold int").repartition(5).cache()


def both(monkeypatch, run):
    """What the rows and what the cells give; the second must not touch the scans by level."""
    with monkeypatch.context() as m:
        m.setattr(C, "MAX_CODES", 0)
        rows = run()
    with monkeypatch.context() as m:
        m.setattr(H, "_partials", None)
        m.setattr(H, "_pieces", None)
        return rows, run()


def test_radix():
    binning = H.Binning(["p", "q", "r"], [np.arange(3.0), np.zeros(0), np.arange(5.0)])
    radix = C.radix_of(binning, 1000)
    assert len(radix) == 5 * 2 * 7 and C.radix_of(binning, 69) is None and C.radix_of(binning, 70, C.MAX_CODES) is None
    codes = np.arange(70, dtype=np.int32)
    x = radix.bins(codes)
    assert (radix.of(x) == codes).all() and x.max(0).tolist() == [4, 1, 6]


@pytest.mark.parametrize("sizes,cells", [(None, None), ([1, 3, 5], None), ([2, 5], 400)])
def test_grid(data, monkeypatch, sizes, cells):
    if cells:  # two samples at a time
        monkeypatch.setattr(H, "MAX_CELLS", 400)
    run = lambda: sorted(tuple(r) for r in H.forest_grid(
        data, COLS, "y", "id", F.col("fold"), 4, [0, 2, 9], [3, 40], sizes, bins=8, folds=[0, 2]).drop("max_features").collect())
    rows, cells = both(monkeypatch, run)
    assert len(rows) == 6 * len(sizes or [1]) == len(cells)
    for a, b in zip(rows, cells):
        assert a == pytest.approx(b, rel=1e-7)


def test_boosting(data, monkeypatch):
    settings = [H.BoostSetting(4, 1.0, 0.5), H.BoostSetting(2, 2.5, 0.3), H.BoostSetting(0, 1.0, 0.1, 5)]

    def run():
        model = H.boost(data, COLS, "y", settings, 30, F.col("fold") == 1, patience=4, bins=8)
        told = model.transform(data).orderBy("id", "b").select(*[f"prediction_{m}" for m in range(3)]).collect()
        return sorted(model.history), [len(r) for r in model.rounds], np.array(told, float)

    (a, rounds, x), (b, same, z) = both(monkeypatch, run)
    assert rounds == same and len(a) == len(b) and max(rounds) > 3
    for p, q in zip(a, b):
        assert p == pytest.approx(q, rel=1e-7)
    assert x == pytest.approx(z, rel=1e-9)


def test_no_rows_of_a_kind(data, monkeypatch):
    """Without held-out rows the training loss is followed; with nothing else the base is 0."""
    none = lambda: sorted(H.boost(data, COLS, "y", [H.BoostSetting(2)], 3, bins=8).history)
    a, b = both(monkeypatch, none)
    assert [h[6] for h in b] == [None] * 4 and [h[:6] for h in b] == [pytest.approx(h[:6]) for h in a]
    only = lambda: sorted(H.boost(data, COLS, "y", [H.BoostSetting(2)], 2, F.lit(True), bins=2).history)
    a, b = both(monkeypatch, only)
    assert len(a) == 3 and [h[:9] for h in b] == [pytest.approx(h[:9]) for h in a]
