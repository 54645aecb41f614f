"""Evidence for the fitted models: known answers, invariants and floors."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import cluster as K
from tessera.operators import encode as E
from tessera.operators import evaluate as V
from tessera.operators import recommend as R
from tessera.operators import regress as G
from tessera.operators import stats as H
from tessera.operators import text as X
from tessera.operators.neighbors import nearest_neighbors

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def linear(spark):
    """y = 3 + 2 a - b + 0 c + noise, a offset by 1e6."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3)) + [1e6, 0, 0]
    y = 3 + 2 * (x[:, 0] - 1e6) - x[:, 1] + 0.1 * rng.normal(size=600)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").coalesce(1).cache()
    return df, x, y


@pytest.fixture(scope="module")
def binary(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    x = rng.normal(size=(400, 2)) + np.outer(y, [2.0, -1.0])
    rows = [(i, float(r[0]), float(r[1]), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.coalesce(1)).cache(), x, y


def coefs(model):
    return [*model.stages[-1].coefficients.toArray(), model.stages[-1].intercept]


def test_linear_models(linear):
    df, x, y = linear
    z = x - x.mean(0)
    ols = np.linalg.lstsq(z, y - y.mean(), rcond=None)[0]
    assert coefs(G.linear_regression(["b", "c"], "y").fit(df))[:2] == pytest.approx(
        np.linalg.lstsq(z[:, 1:], y - y.mean(), rcond=None)[0], abs=1e-6)
    stats = G.gram_stats(df, COLS, "y")
    assert G.ols_of_stats(stats, [0, 1, 2])[0] == pytest.approx(ols, abs=1e-6)  # despite the offset
    want = np.linalg.solve(z[:, 1:].T @ z[:, 1:] + 50 * np.eye(2), z[:, 1:].T @ (y - y.mean()))
    assert coefs(G.ridge(df, ["b", "c"], "y", 50.0).fit(df))[:2] == pytest.approx(want, abs=1e-4)
    small = coefs(G.lasso(["b", "c"], "y", 0.5).fit(df))
    assert small[1] == 0 and -1 < small[0] < -0.3
    bayes = G.bayesian_ridge(df, COLS, "y")
    assert bayes["coef"] == pytest.approx(ols, abs=1e-2)
    assert bayes["alpha"] == pytest.approx(100, rel=0.2)  # noise 0.1


def test_robust_regression_ignores_outliers(spark, linear):
    df, _, _ = linear
    bad = df.withColumn("y", F.when(F.col("id") % 10 == 0, F.col("y") + 500).otherwise(F.col("y")))
    model = G.robust_regression(bad.withColumn("a", F.col("a") - 1e6), COLS, "y", trials=3)
    assert model.coefficients.toArray() == pytest.approx([2, -1, 0], abs=0.05)


def test_sweeps_from_one_gram(linear):
    df, x, y = linear
    tr, te = df.where("id % 4 > 0"), df.where("id % 4 = 0")
    m = np.arange(600) % 4 > 0
    z = x[m] - x[m].mean(0)

    def r2(cols, alpha=0.0):
        b = np.linalg.solve(z[:, cols].T @ z[:, cols] + alpha * np.eye(len(cols)), z[:, cols].T @ (y[m] - y[m].mean()))
        err = y[~m] - (y[m].mean() + (x[~m] - x[m].mean(0))[:, cols] @ b)
        return 1 - (err ** 2).mean() / y[~m].var()

    got = {r["feature"]: r for r in G.drop_one_feature(tr, te, COLS, "y").collect()}
    for i, c in enumerate(COLS):
        assert got[c]["r2_change"] == pytest.approx(r2([j for j in range(3) if j != i]) - r2([0, 1, 2]), abs=1e-5)
    for r in G.ridge_sweep(tr, te, COLS, "y", [0.0, 1.0, 100.0]).collect():
        assert r["r2"] == pytest.approx(r2([0, 1, 2], r["alpha"]), abs=1e-5)


def test_trees_and_boosting(linear):
    df, _, _ = linear
    var = df.agg(F.var_pop("y")).first()[0]
    for pipe in (G.tree_regressor(COLS, "y", 6), G.forest_regressor(COLS, "y", 10, 6), G.gbt_regressor(COLS, "y", 7, 0.3, 3)):
        m = V.regression_metrics(pipe.fit(df).transform(df), "y", "prediction", 3).first()
        assert m["mse"] < 0.3 * var
    trees, base, rounds = G.gbm_residual(df, COLS, "y", n_trees=5, learning_rate=0.3)
    assert len(trees) == 5 and base == pytest.approx(df.agg(F.avg("y")).first()[0])
    rmse = [r[2] for r in rounds]
    assert rmse == sorted(rmse, reverse=True) and rmse[-1] < 0.6 * math.sqrt(var)
    # one round by hand: the tree fits y - mean, its prediction is added at the learning rate
    one = trees[0].transform(G.assemble(df, COLS)).select(F.sqrt(F.avg((F.col("y") - base - 0.3 * F.col("_p")) ** 2))).first()[0]
    assert one == pytest.approx(rmse[0], rel=1e-9)
    _, _, up = G.gbm_residual(df, COLS, "y", n_trees=5, learning_rate=0.3, eta=5.0)
    assert up[-1][2] > rmse[-1]  # pulled away from the squared optimum
    with pytest.raises(Exception):
        C.decision_tree(31).fit(df.withColumn("label", F.lit(1.0)).withColumn("features", array_to_vector(F.array("a"))))


def test_segments_and_scoring(spark, linear, tmp_path):
    df, _, _ = linear
    seg = df.withColumn("s", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    models = G.model_per_segment(seg, "s", lambda: G.linear_regression(["b"], "y"))
    scored = G.score_per_segment(seg, "s", models)
    assert set(models) == {"even", "odd"} and scored.count() == 600
    out = G.train_then_score(df, df.drop("y"), G.linear_regression(["b", "c"], "y"), "id", path=str(tmp_path / "p"))
    back = spark.read.option("header", True).csv(str(tmp_path / "p"))
    assert out.count() == back.count() == 600 and back.columns == ["id", "prediction"]


def test_discriminants_and_naive_bayes(binary):
    df, x, y = binary
    mean = [x[y == c].mean(0) for c in (0, 1)]
    cov = [np.cov(x[y == c].T) for c in (0, 1)]
    n = [(y == c).sum() for c in (0, 1)]
    pooled = sum(s * (k - 1) for s, k in zip(cov, n)) / (400 - 2)

    def pick(covs):
        s = np.stack([math.log(n[c] / 400) - 0.5 * np.linalg.slogdet(covs[c])[1]
                      - 0.5 * np.einsum("ij,jk,ik->i", x - mean[c], np.linalg.inv(covs[c]), x - mean[c]) for c in (0, 1)])
        return s.argmax(0)

    for quad, want in ((False, pick([pooled, pooled])), (True, pick(cov))):
        m = C.discriminant_fit(df, "label", ["a", "b"], quadratic=quad)
        got = {r["id"]: r["prediction"] for r in C.discriminant_predict(df, m, "id").collect()}
        assert [got[i] for i in range(400)] == want.tolist()
    flat = df.withColumn("z", F.lit(1.0))
    nb = C.gaussian_nb_fit(flat, "label", ["a", "z"])
    pred = C.gaussian_nb_predict(flat, nb, "label", ["a", "z"], "id")  # a constant feature is no error
    assert pred.join(df.select("id", "label"), "id").where("prediction = label").count() > 300
    proba = C.gaussian_nb_proba(flat, nb, "label", ["a", "z"], 1.0, "p").join(pred.select("id", "prediction"), "id")
    assert proba.where((F.col("p") > 0.5) != (F.col("prediction") == 1)).count() == 0
    assert proba.where("p < 0 or p > 1").count() == 0


def test_classifiers_beat_the_floor(binary):
    df, _, _ = binary
    n = df.count()
    rff = C.random_fourier_features(df, ["a", "b"], 50, 0.7)
    for est, data in ((C.logistic_regression(n), df), (C.logistic_regression(n, 1.0, "l1"), df), (C.decision_tree(3), df),
                      (C.random_forest(10, 3), df), (C.linear_svm(n), df), (C.linear_svm(n, features="rff"), rff),
                      (C.mlp([2, 4, 2], max_iter=50), df)):
        assert V.accuracy(est.fit(data).transform(data), "label", "prediction").first()[0] > 0.8
    # the kernel of the random features approaches exp(-gamma |x - y|^2)
    z = np.array([r[0] for r in C.random_fourier_features(df.orderBy("id").limit(20), ["a", "b"], 500, 0.7)
                  .orderBy("id").select(vector_to_array("rff")).collect()])
    x = np.array([[r["a"], r["b"]] for r in df.orderBy("id").limit(20).collect()])
    k = np.exp(-0.7 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - k).max() < 0.25


def test_logistic_regression_objective(binary):
    """At the optimum the gradient of C * loss + |w|^2 / 2 vanishes."""
    df, x, y = binary
    m = C.logistic_regression(400, C=0.5).setTol(1e-12).fit(df)
    p = 1 / (1 + np.exp(-(x @ m.coefficients.toArray() + m.intercept)))
    assert 0.5 * x.T @ (p - y) + m.coefficients.toArray() == pytest.approx([0, 0], abs=1e-3)


def test_adaboost_and_vote(spark, binary):
    df, _, _ = binary
    models = C.adaboost(df, rounds=5)
    out = C.adaboost_predict(df, models)
    alphas = [a for _, a in models]
    total = sum(alphas)
    for r in out.limit(50).collect():
        assert 1 / (1 + math.exp(total)) - 1e-9 <= r["prob_ada"] <= 1 / (1 + math.exp(-total)) + 1e-9
        assert (r["prob_ada"] > 0.5) == (r["prediction"] == 1)
    first = models[0][0].setPredictionCol("_q").setRawPredictionCol("_r").setProbabilityCol("_s").transform(df)
    err = first.agg(F.avg((F.col("_q") != F.col("label")).cast("double"))).first()[0]
    assert alphas[0] == pytest.approx(math.log((1 - err) / err))
    assert V.accuracy(out, "label", "prediction").first()[0] > 0.8
    v = spark.createDataFrame([(0.2, 0.9, 0.4, 0.6, 0.5)], "a double, b double, c double, d double, e double")
    r = C.soft_vote(v, ["a", "b", "c", "d", "e"], [1, 2, 2, 1, 2]).first()
    assert r["vote_prob"] == pytest.approx((0.2 + 1.8 + 0.8 + 0.6 + 1.0) / 8) and r["vote_pred"] == 1


def test_neighbors_ties_copies_and_plan(spark):
    rng = np.random.default_rng(5)
    pts = rng.integers(0, 3, size=(300, 3)).astype(float).tolist()  # many equal vectors and distances
    df = spark.createDataFrame([(i, p, i % 3) for i, p in enumerate(pts)], "id long, v array<double>, y int")
    near = nearest_neighbors(df.where("id < 40"), df.where("id >= 40"), "id", "v", 5, block_size=16)
    got = {}
    for r in near.collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbor"]
    x = np.array(pts)
    for i in range(40):
        d = ((x[40:] - x[i]) ** 2).sum(1)
        assert [got[i][k] for k in range(1, 6)] == (np.lexsort((np.arange(260), d))[:5] + 40).tolist()
    plan = near._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    few = C.knn_classify(df.where("id < 3"), df.where("id in (5, 8)"), "id", "v", "y", 5).collect()
    assert {(r["prediction"], r["share"]) for r in few} == {(2, 1.0)}
    same = spark.createDataFrame([(40 - i, [1.0, 0.0]) for i in range(40)] + [(99, [0.0, 0.0])], "id long, v array<double>")
    top = {(r["id"], r["similar"]) for r in R.similar_users(same, "id", "v", 3).where("id = 40").collect()}
    assert top == {(40, 1), (40, 2), (40, 3)}  # ties by id; the zero vector takes no part


def test_clusters(spark):
    rng = np.random.default_rng(6)
    pts = np.concatenate([rng.normal(size=(30, 2)) + c for c in ([0, 0], [20, 0], [0, 20])])
    df = spark.createDataFrame([(i, p.tolist(), i // 30) for i, p in enumerate(pts)], "id long, v array<double>, y int")
    df = df.withColumn("features", array_to_vector("v"))
    costs = [r["cost"] for r in K.elbow_costs(df, [2, 3, 4]).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2] * 0.99
    model = K.kmeans_restarts(df, 3, [1, 2, 3, 4])
    assert model.summary.trainingCost <= costs[1] + 1e-6
    pred = model.transform(df)
    assert K.silhouette(pred) > 0.9
    assert pred.select("y", "prediction").distinct().count() == 3
    model, spread = K.kmeans_by_spread(df, 3, [1, 2, 3], "id", "v")
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    want = np.mean([d[a:a + 30, a:a + 30][np.triu_indices(30, 1)].mean() for a in (0, 30, 60)])
    trials = [K.cluster_spread(K.mean_intra_distance(K.kmeans_restarts(df, 3, [i]).transform(df), "prediction", "id", "v"))
              .first()["spread"] for i in (1, 2, 3)]
    assert spread == pytest.approx(min(trials))
    for block in (4, 512):
        m = K.mean_intra_distance(df, "y", "id", "v", block_size=block)
        assert K.cluster_spread(m).first()["spread"] == pytest.approx(want)
    rms = {r["y"]: r["rms_distance"] for r in K.rms_intra_distance(df, "y", "v", 2).collect()}
    assert rms[0] == pytest.approx(math.sqrt((d[:30, :30][np.triu_indices(30, 1)] ** 2).mean()))


def test_als(spark):
    rng = np.random.default_rng(7)
    u, v = rng.random((30, 3)) + 0.5, rng.random((20, 3)) + 0.5
    rows = [(i, j, float(u[i] @ v[j])) for i in range(30) for j in range(20) if (i + j) % 5]
    df = spark.createDataFrame(rows, "user int, product int, rating float")
    fit = R.als_explicit(df, rank=3, reg=0.001, iterations=20)
    err = fit.transform(df).agg(F.sqrt(F.avg((F.col("rating") - F.col("prediction")) ** 2))).first()[0]
    assert err < 0.15
    top = R.recommend(fit, 4).select("user", F.explode("recommendations").alias("r")).select("user", "r.*")
    assert top.groupBy("user").count().where("count <> 4").count() == 0
    # users like products of their own parity: held-out ones rank high
    likes = [(i, j) for i in range(40) for j in range(40) if i % 2 == j % 2]
    out = {(i, j) for i, j in likes if (i * 13 + j * 7) % 5 == 0}
    seen = [(i, j, 3.0) for i, j in likes if (i, j) not in out]
    model = R.als_implicit(spark.createDataFrame(seen, "user int, product int, rating float"), rank=4, alpha=5.0)
    every = spark.createDataFrame([(i, j, float((i, j) in out)) for i in range(40) for j in range(40)
                                   if i % 2 != j % 2 or (i, j) in out], "user int, product int, rating double")
    mpr = R.mean_percentile_rank(model.transform(every).withColumnRenamed("prediction", "score")).first()["mpr"]
    assert mpr < 35  # 50 is chance


def test_splits(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    n = {r["split"]: r["count"] for r in V.hash_split(df, "k", [0.6, 0.2, 0.2]).groupBy("split").count().collect()}
    assert n[0] == pytest.approx(12_000, rel=0.03) and n[1] == pytest.approx(4_000, rel=0.06)
    # keys in steps of 1000 spread over the whole range
    u = [r[0] for r in spark.range(0, 1_000_000, 1000).select(V.hash_unit("id")).collect()]
    assert np.histogram(u, bins=10, range=(0, 1))[0].min() > 60
    odd = V.hash_split(df, "k", [0.12345, 0.87655]).where("split = 0").count()
    assert odd == pytest.approx(2469, rel=0.08)
    a, b = V.random_split(df, [0.7, 0.3], 5)
    assert a.count() + b.count() == 20_000 and a.intersect(b).count() == 0
    pairs = spark.createDataFrame([(i, j, 1) for i in range(60) for j in range(20)], "user long, product long, rating int")
    out, frac = R.split_repeat_aware(pairs, 0.7)
    assert frac == pytest.approx(0.7)
    for c in ("user", "product"):  # every one has pairs on both sides
        assert out.groupBy(c).agg(F.count_distinct("is_train").alias("n")).where("n < 2").count() == 0
    neg = R.negative_samples(pairs.where("product < 5").select("user", "product"), pairs.select("product"), 8)
    sets = neg.groupBy("user").agg(F.array_sort(F.collect_set("product")).alias("s"))
    assert sets.where(F.size("s") != 8).count() == 0 and sets.select("s").distinct().count() > 40
    assert neg.where("product < 5").count() == 0


def test_numbers_near_the_edge(spark):
    y = spark.createDataFrame([("x", 1e9 + 1), ("x", 1e9 + 2), ("y", 1e9 + 3), ("y", 1e9 + 4)], "c string, v double")
    assert H.eta_ratio(y, "c", "v").first()[0] == pytest.approx(0.894427, abs=1e-5)
    from tessera.functions.stats import two_sided_p
    z = spark.createDataFrame([(float(i) / 4,) for i in range(0, 60)], "z double")
    for r in z.select("z", two_sided_p(F.col("z")).alias("p")).collect():
        assert r["p"] == pytest.approx(math.erfc(r["z"] / math.sqrt(2)), rel=2e-7)
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    assert {r["b"] for r in E.Standardizer(["a", "b"]).fit(flat).transform(flat).collect()} == {0.0}
    assert {r["b"] for r in E.MinMaxScaler01(["a", "b"]).fit(flat).transform(flat).collect()} == {0.0}


def test_text_edges(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, ["zz"])], "doc_id long, tokens array<string>")
    vocab = X.build_vocabulary(docs.where("doc_id = 1"), "doc_id", "tokens")
    ids = {r["doc_id"]: r["ids"] for r in X.texts_to_ids(docs, "doc_id", "tokens", vocab).collect()}
    assert ids == {1: [1, 2, 1], 2: [], 3: []}
    tf = {(r["doc_id"], r["word"]): r["tf"] for r in X.count_vector(docs, "doc_id", "tokens").collect()}
    assert tf == {(1, "a"): 2, (1, "b"): 1, (3, "zz"): 1}
    vecs = spark.createDataFrame([(1, [1.0, -2.0])], "id long, vector array<double>")
    seq = X.texts_to_ids(docs, "doc_id", "tokens", vocab)
    pooled = {r["doc_id"]: r["vector"] for r in X.pooled_vectors(seq, vecs, 2).collect()}
    assert pooled[2] == pooled[3] == [0.0, 0.0]
    flat = {r["doc_id"]: r["vector"] for r in X.flattened_vectors(seq, vecs, 2, 4).collect()}
    assert flat[1] == [1.0, -2.0, 0.0, 0.0, 1.0, -2.0, 0.0, 0.0]
    h = docs.select(X.hashed_ids("tokens", 10).alias("h")).collect()
    assert all(1 <= i <= 9 for r in h for i in r["h"]) and h[0]["h"][0] == h[0]["h"][2]
    words = C.train_word_vectors(docs, "tokens", dim=4).getVectors()
    assert {r["word"] for r in words.collect()} == {"a", "b", "zz"}


def test_encodings(spark):
    df = spark.createDataFrame([(i, f"v{i % 7}", i % 3, float(i)) for i in range(70)], "id long, c string, d int, x double")
    cells = E.one_hot_long(df, ["c", "d"], ["id"])
    assert cells.count() == 140 and cells.select("feature").distinct().count() == 10
    assert E.one_hot_long(df, ["c", "d"], ["id"], min_count=11).select("feature").distinct().count() == 3
    idx = E.label_encoder("c").fit(df).transform(df)
    vec = E.one_hot_vector("c_idx").fit(idx).transform(idx).select(vector_to_array("c_idx_vec").alias("v"), "c_idx")
    assert all(sum(r["v"]) == 1 and r["v"][int(r["c_idx"])] == 1 for r in vec.collect())
    emb = E.category_embedding(df, "c", ["x", "d"], k=2).collect()
    assert len(emb) == 7 and all(len(r["embedding"]) == 2 for r in emb)


def test_optimal_bid(spark):
    ctx = spark.createDataFrame([("a",), ("b",)], "context string")
    grid = G.bid_grid(ctx, [0.3, 0.7]).withColumn("rate", F.when(F.col("context") == "a", F.col("bid")).otherwise(F.lit(0.5)))
    got = {(r["context"], round(r["cpc"], 2)): r["bid"] for r in G.optimal_bid(grid, ["context", "cpc"], "rate").collect()}
    assert got["a", 0.3] == pytest.approx(0.15) and got["a", 0.7] == pytest.approx(0.35)  # cpc / 2
    assert got["b", 0.3] == got["b", 0.7] == pytest.approx(0.01)


def test_sweep_of_undersampling(binary):
    df, _, _ = binary
    rows = V.undersample_sweep(df, df, "id", "label", 0.0, [0.1, 0.5, 1.0],
                               lambda t: C.logistic_regression(t.count()).fit(t), 1.0).collect()
    assert [r["fraction"] for r in rows] == [0.1, 0.5, 1.0]
    assert rows[0]["n_train"] < rows[1]["n_train"] < rows[2]["n_train"] == 400
    assert rows[0]["recall"] >= rows[2]["recall"]


def test_basket_slices(spark):
    """A hot order in slices gives the same sets; two names of one item stop the job."""
    from tessera.operators import basket as B
    rows = [(o, i) for o in range(12) for i in range(9) if (o * i) % 4 != 1]
    df = spark.createDataFrame(rows, "o long, i long")
    whole = {tuple(r["itemset"]): r["n_orders"] for r in B.frequent_itemsets(df, "o", "i", 3, 3).collect()}
    sliced = {tuple(r["itemset"]): r["n_orders"] for r in B.frequent_itemsets(df, "o", "i", 3, 3, chunk=2).collect()}
    assert whole == sliced and max(map(len, whole)) == 3
    with pytest.raises(ValueError):
        B.checked_names(spark.createDataFrame([(1, "x"), (1, "y")], "s int, n string"), "s", "n")
