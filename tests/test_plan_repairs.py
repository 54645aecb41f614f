"""Operators whose hot groups are spread over tasks: same results whatever the spread."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import basket as B
from tessera.operators import encode as E
from tessera.operators import recommend as R
from tessera.operators import stats as H


@pytest.mark.parametrize("bucket", [1, 3, 512])
def test_pairwise_tests_over_buckets(spark, monkeypatch, bucket):
    monkeypatch.setattr(H, "BUCKET", bucket)
    rng = np.random.default_rng(0)
    rows = [(g, s, float(v)) for s in ("x", None) for g in (None, 1, 2, 5, 9) for v in rng.normal(g or 0, 1, 6)]
    rows += [(7, "x", 0.0), (7, "x", None)]
    df = spark.createDataFrame(rows, "grp int, seg string, v double").repartition(3)
    got = {(r["seg"], r["group_a"], r["group_b"]): r["z"] for r in H.pairwise_z_tests(df, "grp", "v", ["seg"]).collect()}
    want = {}
    for s in ("x", None):
        of = {}
        for g, t, v in rows:
            if t == s and v is not None:
                of.setdefault(g, []).append(v)
        for a, b in itertools.combinations(sorted(of, key=lambda g: (g is not None, g or 0)), 2):
            x, y = np.array(of[a]), np.array(of[b])
            want[s, a, b] = (x.mean() - y.mean()) / math.sqrt(x.var() / len(x) + y.var() / len(y))
    assert got == pytest.approx(want)
    assert H.pairwise_z_tests(df.limit(0), "grp", "v", ["seg"]).count() == 0
    assert H.pairwise_z_tests(df, "grp", "v").count() == 15


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_itemsets_whatever_the_slices(spark, chunk):
    orders = {1: "abcde", 2: "abd", 3: "bd", 4: "ace", 5: "a", 6: "abcd"}
    df = spark.createDataFrame([(o, i) for o, items in orders.items() for i in items + items[:1]], "o int, i string").repartition(3)
    got = {tuple(r["itemset"]): r["n_orders"] for r in B.frequent_itemsets(df, "o", "i", 2, 3, chunk).collect()}
    want = {}
    for k in (1, 2, 3):
        for s in itertools.combinations("abcde", k):
            n = sum(set(s) <= set(items) for items in orders.values())
            if n >= 2:
                want[s] = n
    assert got == want


def test_percentile_rank_metric(spark):
    rng = np.random.default_rng(1)
    rows = [(u, p, float(rng.integers(1, 4)), float(rng.integers(0, 5))) for u in range(6) for p in range(u + 1)]
    df = spark.createDataFrame(rows, "user int, product int, rating double, score double").repartition(4)
    num = den = 0.0
    for u in range(6):
        mine = sorted((r for r in rows if r[0] == u), key=lambda r: (-r[3], r[1]))
        for i, r in enumerate(mine):
            num += r[2] * (100 * i / (len(mine) - 1) if len(mine) > 1 else 0)
            den += r[2]
    assert R.mean_percentile_rank(df).first()["mpr"] == pytest.approx(num / den)
    more = df.unionByName(df.limit(0)).withColumn("rating", F.col("rating") * 2)
    assert R.mean_percentile_rank(df, more).first()["mpr"] == pytest.approx(num / den / 2)


def test_one_hot_columns_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(E, "MAX_VALUES", 3)
    df = spark.createDataFrame([(v,) for v in "aabbcd"], "v string")
    assert E.OneHotColumns(["v"], 2).fit(df).values == {"v": ["a", "b"]}
    with pytest.raises(ValueError, match="one_hot_long"):
        E.OneHotColumns(["v"]).fit(df)
