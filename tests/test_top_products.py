"""Best products by inner product against scoring of all pairs."""

import numpy as np
import pytest

from tessera.operators.recommend import als_explicit, recommend
from tessera.operators.top_products import top_products


def frame(spark, name, ids, mat):
    rows = [(int(i), [None if x is None else float(x) for x in v] if v is not None else None) for i, v in zip(ids, mat)]
    return spark.createDataFrame(rows, f"{name} long, vector array<double>").repartition(3)


def brute(uid, u, pid, p, k):
    return {int(a): [(int(pid[j]), float(s[j])) for j in sorted(range(len(pid)), key=lambda j: (-s[j], pid[j]))[:k]]
            for a, s in zip(uid, np.asarray(u) @ np.asarray(p).T)}


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["user"], r["rank"])):
        out.setdefault(r["user"], []).append((r["product"], r["score"]))
        assert r["rank"] == len(out[r["user"]])
    return out


@pytest.mark.parametrize("round_items,block", [(40, 8), (500, 16), (7, 3)])
def test_whole_numbers_with_ties_equal_all_pairs(spark, round_items, block):
    rng = np.random.default_rng(1)
    u, p = rng.integers(-3, 4, (60, 3)), rng.integers(-4, 5, (200, 3))
    uid, pid = rng.permutation(60), rng.permutation(200) + 1000
    u[5] = 0  # scores 0 with everything
    df = top_products(frame(spark, "user", uid, u), frame(spark, "product", pid, p), 6, round_items=round_items, block=block)
    assert got(df) == brute(uid, u, pid, p, 6)


def test_most_pairs_are_not_scored(spark):
    rng = np.random.default_rng(2)
    u, p = rng.normal(size=(50, 3)), rng.normal(size=(20_000, 3)) * rng.lognormal(0, 1, (20_000, 1))
    df = top_products(frame(spark, "user", range(50), u), frame(spark, "product", range(20_000), p), 5, round_items=1000, block=64)
    want, have = brute(range(50), u, range(20_000), p, 5), got(df)
    assert {a: [i for i, _ in b] for a, b in have.items()} == {a: [i for i, _ in b] for a, b in want.items()}
    scored = {r["user"]: r["n_scored"] for r in df.collect()}
    assert sum(scored.values()) < 0.05 * 50 * 20_000


def test_edges(spark):
    u = frame(spark, "user", [1, 2, 3, 4], [[1, 0], None, [float("nan"), 1], [None, 2]])
    p = frame(spark, "product", [7, 8, 9, 10], [[2, 5], [2, -5], [float("inf"), 0], []])
    assert got(top_products(u, p, 5)) == {1: [(7, 2.0), (8, 2.0)]}
    assert top_products(u, p.limit(0), 5).count() == 0 and top_products(u.limit(0), p, 5).count() == 0
    with pytest.raises(ValueError, match="different lengths"):
        top_products(u, frame(spark, "product", [7], [[1, 2, 3]]), 5)


def test_recommend_equals_the_model(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a), int(b), float(r)) for a, b, r in zip(rng.integers(0, 30, 400), rng.integers(0, 50, 400), rng.integers(1, 6, 400))]
    model = als_explicit(spark.createDataFrame(rows, "user int, product int, rating float"), rank=3, iterations=5)
    want = {r["user"]: [(x["product"], pytest.approx(x["rating"], abs=1e-5)) for x in r["recommendations"]]
            for r in model.recommendForAllUsers(4).collect()}
    have = {r["user"]: [(x["product"], x["rating"]) for x in r["recommendations"]] for r in recommend(model, 4).collect()}
    assert have == want
