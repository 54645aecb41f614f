"""Strassen products against Python integers, mined negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest

from tessera.llm import strassen_negatives as module
from tessera.llm.strassen_negatives import Heaps, mine_embeddings, strassen

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    usable = {}
    for vec_id, v, label in rows:
        if None in (vec_id, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        usable[vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = []
    for a in usable:
        if a[0] % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], r[2])), r[0], r[1]) for r in usable)
        for ps, pid, _ in [s for s in scored if s[2] == a[1] and s[1] != a[0]][:5]:
            near = [s for s in scored if s[2] != a[1] and -50 * ps <= -100 * s[0] <= -95 * ps][:3]
            out += [(a[0], pid, k + 1, nid, -ps, -ns) for k, (ns, nid, _) in enumerate(near)]
    return sorted(out)


def check(spark, rows):
    got = sorted(tuple(r) for r in mine_embeddings(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)
    return got


def vectors(n, dim=8, seed=1, labels=4):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i, [rng.gauss(c, 1) + 0.8 for c in centre[i % labels]], i % labels) for i in range(n)]


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (17, 33, 18), (64, 64, 64), (101, 40, 77)])
def test_strassen_is_exact(shape):
    m, k, n = shape
    rng = np.random.default_rng(m)
    a, b = rng.integers(-10**8, 10**8, (m, k)), rng.integers(-10**8, 10**8, (k, n))
    assert (strassen(a, b, 4) == np.array(a.astype(object) @ b.astype(object), np.int64)).all()


def test_strassen_wraps_inside_and_is_still_exact():
    big = np.full((20, 20), 3 * 2**29)
    assert (strassen(big, big.T, 2) == 20 * 9 * 2**58 % 2**64 - (2**64 if 20 * 9 * 2**58 % 2**64 >= 2**63 else 0)).all()
    with pytest.raises(OverflowError):
        module._product(big, big)


def test_heaps_merge_in_any_grouping():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(-3, 3, (6, 40)), np.arange(40)
    allowed = rng.random((6, 40)) < 0.3
    whole = Heaps(6, 4)
    whole.push(slice(0, 6), scores, allowed, ids)
    halves = [Heaps(6, 4) for _ in range(2)]
    for h, cut in zip(halves, (slice(0, 13), slice(13, 40))):
        h.push(slice(0, 6), scores[:, cut], allowed[:, cut], ids[cut])
    halves[1].merge(slice(0, 6), halves[0].scores, halves[0].ids, halves[0].full)
    assert (halves[1].full == whole.full).all()
    for name in ("scores", "ids"):
        assert (getattr(halves[1], name)[whole.full] == getattr(whole, name)[whole.full]).all()
    expected = sorted((-s, i) for i, (s, ok) in enumerate(zip(scores[0], allowed[0])) if ok)[:4]
    assert list(zip(whole.scores[0][whole.full[0]], whole.ids[0][whole.full[0]])) == [(-s, i) for s, i in expected]


def test_against_all_pairs(spark):
    assert len(check(spark, vectors(320))) > 20


def test_cells_and_tiles_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(module, "ANCHORS", 2)
    monkeypatch.setattr(module, "ROWS", 64)
    monkeypatch.setattr(module, "_TILE", (3, 10))
    assert check(spark, vectors(260, dim=5, seed=2, labels=3))


def test_ties_copies_and_a_hot_vector(spark):
    rows = [(i, [1.0, 0.5], i % 3) for i in range(150)] + [(i, [0.8, 0.3], 5) for i in range(150, 260)]
    got = check(spark, rows + rows[:60])
    assert got and all(r[3] < 260 for r in got)


def test_edges(spark):
    rows = vectors(120, dim=4)
    rows += [(200, None, 1), (250, [1.0, None, 0.0, 0.0], 1), (300, [float("nan")] * 4, 2), (350, [float("inf")] * 4, 2),
             (400, [1.0, 1.0, 1.0, 1.0], None), (None, [1.0] * 4, 0), (500, [], 1), (550, [2.0, 1.0], 0),
             (601, [1.0] * 6, 3), (603, [2.0] * 4, 3), (603, [2.1] * 4, 3), (650, [1.0] * 4, 3), (100, [0.5] * 4, 2), (700, [1.0] * 4, 9)]
    check(spark, rows)
    check(spark, [])
    check(spark, [(50, [1.0], 3)])
    check(spark, [(50, [-1.0], 3), (51, [1.0], 3), (52, [0.0], 3), (53, [0.0], 4), (54, [-0.6], 4)])


def test_clashing_columns(spark):
    rows = vectors(120)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", anchor int, `cell` string")
    assert sorted(tuple(r) for r in mine_embeddings(df).collect()) == brute(rows)
