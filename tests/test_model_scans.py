"""Fits that share scans give what the fits one by one gave."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import evaluate as V
from tessera.operators import regress as G
from tessera.operators import stats as ST
from tessera.operators import sweeps as W


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def linear_rows(spark, n=600):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2)) * [3, 50]
    y = 2 * x[:, 0] - 0.1 * x[:, 1] + 7 + rng.normal(size=n) * 4
    return spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double").repartition(3).localCheckpoint()


def test_linear_cv_is_the_cross_validator_in_one_scan(spark):
    df, pipe = linear_rows(spark), G.linear_regression(["a", "b"], "y")
    lr = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1, 5.0]).build()
    want = CrossValidator(estimator=pipe, estimatorParamMaps=grid, numFolds=4, seed=1,
                          evaluator=RegressionEvaluator(labelCol="y", metricName="r2")).fit(df).avgMetrics
    got, rows = [], pipe.getStages()[0].transform(df)
    jobs = jobs_of(spark, "linear_cv", lambda: got.extend(
        W.linear_cv(rows, "features", 2, "y", [0.0, 0.1, 5.0], W.drawn_fold(4, seed=1), 4)))
    assert got == pytest.approx(want, abs=1e-9) and jobs <= 3


@pytest.mark.parametrize("values", [[], [5.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0], [1e308, -1e308, 0.0], [1.0, 1e-300, 1e300, 2.0, 2.0, 7.0],
                                    [float(v) for v in range(1001)], [float("nan"), 1.0, 2.0, 3.0], [float("nan"), float("nan"), 1.0]])
def test_medians(spark, values):
    df = spark.createDataFrame([(v, -v) for v in values] + [(None, None)], "a double, b double")
    got = ST.medians(df, ["a", "b"])
    want = [ST.exact_quantiles(df, c, [0.5]).collect() for c in ("a", "b")]
    for g, w in zip(got, want):
        w = w[0]["q_0.5"] if w else None
        assert (g is None) == (w is None) and (g is None or g == w or math.isnan(g) and math.isnan(w))


def test_robust_regression_keeps_the_inliers(spark):
    df = linear_rows(spark)
    df = df.withColumn("y", F.when(F.col("a") > 4, F.col("y") + 1000).otherwise(F.col("y")))
    model = G.robust_regression(df, ["a", "b"], "y")
    assert list(model.coefficients) == pytest.approx([2, -0.1], abs=0.15)


def test_adaboost_scans_once_a_round_beside_its_fit(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    rows = [(i, float(a), float(b), float(a + b > 0)) for i, (a, b) in enumerate(x)]
    df = G.assemble(spark.createDataFrame(rows, "id long, a double, b double, label double"), ["a", "b"])
    models = C.adaboost(df, rounds=4)
    assert len(models) == 4
    # plain numbers: weights, errors and alphas of the same stumps
    label, w = np.array([r[3] for r in rows]), np.full(400, 1 / 400)
    for m, alpha in models:
        p = np.array([r["_p"] for r in m.transform(df).orderBy("id").collect()])
        err = w[p != label].sum() / w.sum()
        assert alpha == pytest.approx(math.log((1 - err) / err))
        w = w * np.exp(alpha * (p != label))
        w /= w.sum()
    out = C.adaboost_predict(df, models)
    assert set(out.columns) == {"id", "a", "b", "label", "features", "prob_ada", "prediction"}
    assert out.where("prediction = label").count() > 320


def test_logistic_cv_is_the_cross_validator_on_shared_scans(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 3)) * [1, 10, 0.1] + [0, 30, 1]
    x[:, 2] += x[:, 1] / 90
    y = (rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] - 0.05 * (x[:, 1] - 30))))).astype(float)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    df = G.assemble(spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(3), ["a", "b", "c"]).localCheckpoint()
    lr = C.logistic_regression(900).setTol(1e-12)
    grid = ParamGridBuilder().addGrid(lr.regParam, [1e-4, 1e-1]).addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    auc, f1 = BinaryClassificationEvaluator(labelCol="label"), V.MacroF1Evaluator("label", "prediction")
    scans, sums = [], W._logistic_sums
    monkeypatch.setattr(W, "_logistic_sums", lambda *a: scans.append(len(a[3])) or sums(*a))
    got = W.logistic_cv(df, "features", 3, "label", [(p[lr.regParam], p[lr.elasticNetParam]) for p in grid], [(3, auc), (2, f1)], seed=1)
    assert scans[0] == 20 and len(scans) < 15
    for mine, (folds, ev) in zip(got, ((3, auc), (2, f1))):
        want = CrossValidator(estimator=lr, estimatorParamMaps=grid, numFolds=folds, seed=1, evaluator=ev).fit(df).avgMetrics
        assert mine == pytest.approx(want, abs=1e-4)
    # the coefficients themselves, on all rows
    whole = df.select("a", "b", "c", "label", F.lit(0).alias("fold0"))
    fits = W.logistic_fits(whole, 3, ["fold0"], [(0, 1, 1e-4, 0.0), (0, 1, 1e-1, 1.0), (0, 1, 1e-4, 1.0)])
    for w, (reg, net) in zip(fits.T, ((1e-4, 0.0), (1e-1, 1.0), (1e-4, 1.0))):
        m = lr.copy({lr.regParam: reg, lr.elasticNetParam: net}).setMaxIter(1000).fit(df)
        assert [*w] == pytest.approx([*m.coefficients, m.intercept], abs=2e-3)


def test_logistic_fits_of_one_class(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (2.0, 1.0, 0), (3.0, 0.0, 1)], "a double, label double, fold0 int")
    w = W.logistic_fits(df, 1, ["fold0"], [(0, 1, 0.1, 0.0), (0, 2, 0.1, 0.0)])
    assert w[:, 0].tolist() == [0.0, math.inf] and np.isfinite(w[:, 1]).all()
