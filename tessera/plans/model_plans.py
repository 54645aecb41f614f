"""Recommender, clustering, classification, regression, time-series model,
tuning and file source/sink queries.  Fitted-model results are rows-only
checks; deterministic parts carry oracle SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import classify as C
from tessera.operators import cluster as K
from tessera.operators import evaluate as V
from tessera.operators import recommend as R
from tessera.operators import regress as G
from tessera.operators import sweeps as W
from tessera.operators import timeseries as TS
from tessera.plans.catalog import register, unit_sql
from tessera.plans.ordered_plans import daily_series
from tessera.session import cut_lineage, scratch_dir
from tessera.sources import files as S
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------ recommender
# user = customer, product = supplier of the line; "prior" orders = not 'P'.

_PAIRS_SQL = """
pairs AS (SELECT o.o_custkey AS user, l.l_suppkey AS product, count(*) AS rating
          FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
          WHERE o.o_orderstatus <> 'P' GROUP BY 1, 2)
"""


def rec_pairs(spark, d):
    t = Tables(spark, d)
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user"),
                             "o_orderstatus")
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("product"))
    return R.implicit_pairs(orders, lines, F.col("o_orderstatus") != "P")


@register("rec_implicit_pairs", "R1 A1 J1", sql=f"""
WITH {_PAIRS_SQL} SELECT user, product, rating FROM pairs
""")
def rec_implicit_pairs(spark, d):
    return rec_pairs(spark, d)


_SPLIT_SQL = f"""
{_PAIRS_SQL},
st AS (SELECT count(*) AS n, sum(CASE WHEN rating > 1 THEN 1 ELSE 0 END) AS rep FROM pairs),
fr AS (SELECT greatest(0.0, least(1.0, CASE WHEN n > rep THEN (floor(n * 0.7) - rep) / (n - rep) ELSE 0.0 END)) AS f FROM st),
sp AS (SELECT user, product, rating,
              rating > 1 OR {unit_sql('user', 'product')} < (SELECT f FROM fr) AS is_train
       FROM pairs)
"""


@register("rec_split_repeat_aware", "R2", sql=f"""
WITH {_SPLIT_SQL} SELECT user, product, rating, is_train FROM sp
""")
def rec_split_repeat_aware(spark, d):
    out, _ = R.split_repeat_aware(rec_pairs(spark, d), 0.7)
    return out


@register("rec_repair_coverage", "R3 J2 J3 A4 Q1", sql=f"""
WITH {_SPLIT_SQL},
tr AS (SELECT * FROM sp WHERE is_train), te AS (SELECT * FROM sp WHERE NOT is_train),
mu AS (SELECT user, max(product) AS product FROM te WHERE user NOT IN (SELECT user FROM tr) GROUP BY user),
tr1 AS (SELECT * FROM tr UNION ALL SELECT te.* FROM te JOIN mu USING (user, product)),
te1 AS (SELECT te.* FROM te ANTI JOIN mu USING (user, product)),
mp AS (SELECT product, max(user) AS user FROM te WHERE product NOT IN (SELECT product FROM tr1) GROUP BY product),
tr2 AS (SELECT user, product, rating FROM tr1 UNION ALL SELECT te1.user, te1.product, te1.rating FROM te1 JOIN mp USING (user, product)),
te2 AS (SELECT te1.user, te1.product, te1.rating FROM te1 ANTI JOIN mp USING (user, product))
SELECT user, product, rating, TRUE AS is_train FROM tr2
UNION ALL SELECT user, product, rating, FALSE FROM te2
""")
def rec_repair_coverage(spark, d):
    out, _ = R.split_repeat_aware(cut_lineage(rec_pairs(spark, d)), 0.7)
    return R.repair_coverage(cut_lineage(out)).select("user", "product", "rating", "is_train")


@register("rec_negative_samples", "R4 J8 U3 Q3", sql=f"""
WITH {_SPLIT_SQL},
te AS (SELECT user, product FROM sp WHERE NOT is_train),
prods AS (SELECT product, row_number() OVER (ORDER BY product) - 1 AS pidx FROM (SELECT DISTINCT product FROM pairs)),
np AS (SELECT count(*) AS P FROM prods),
nq AS (SELECT P, (SELECT min(q) FROM range(greatest(P, 2), 2 * P + 3) t(q)
                  WHERE NOT EXISTS (SELECT 1 FROM range(2, CAST(floor(sqrt(q)) AS BIGINT) + 1) u(f) WHERE q % f = 0)) AS Q
       FROM np),
nf AS (SELECT user, count(*) AS nf FROM te GROUP BY user),
steps AS (SELECT nf.user, 1 + CAST(floor({unit_sql('nf.user', "'step'", seed=11)} * (Q - 1)) AS BIGINT) AS a,
                 CAST(floor({unit_sql('nf.user', "'start'", seed=11)} * Q) AS BIGINT) AS b, Q,
                 unnest(range(0, least(nf.nf + 20 + (Q - P), Q))) AS k
          FROM nf, nq),
cand AS (SELECT s.user, s.k, p.product FROM steps s JOIN prods p ON p.pidx = (s.a * s.k + s.b) % s.Q),
ok AS (SELECT c.* FROM cand c ANTI JOIN te USING (user, product)),
rk AS (SELECT user, product, row_number() OVER (PARTITION BY user ORDER BY k) AS r FROM ok)
SELECT user, product, CAST(0.001 AS DOUBLE) AS rating FROM rk WHERE r <= 20
""")
def rec_negative_samples(spark, d):
    pairs = cut_lineage(rec_pairs(spark, d))
    out, _ = R.split_repeat_aware(pairs, 0.7)
    test = out.where(~F.col("is_train")).select("user", "product")
    return R.negative_samples(test, pairs.select("product"), 20, seed=11)


@register("rec_mean_percentile_rank", "R6 W4 Q5", sql=f"""
WITH {_SPLIT_SQL},
te AS (SELECT user, product, rating, ((user * 31 + product * 17) % 101) / 101.0 AS score FROM sp WHERE NOT is_train),
rk AS (SELECT rating, 100.0 * percent_rank() OVER (PARTITION BY user ORDER BY score DESC, product) AS pr FROM te)
SELECT round(sum(rating * pr) / sum(rating), 6) AS mpr FROM rk
""")
def rec_mean_percentile_rank(spark, d):
    out, _ = R.split_repeat_aware(rec_pairs(spark, d), 0.7)
    te = out.where(~F.col("is_train")).withColumn(
        "score", F.pmod(F.col("user") * 31 + F.col("product") * 17, F.lit(101)) / 101.0)
    return R.mean_percentile_rank(te, te).select(r6("mpr").alias("mpr"))


@register("rec_als_implicit", "R5 R6")
def rec_als_implicit(spark, d):
    out, _ = R.split_repeat_aware(rec_pairs(spark, d), 0.7)
    tr = out.where("is_train").select("user", "product", F.col("rating").cast("float").alias("rating"))
    fit, val = tr.randomSplit([0.8, 0.2], seed=32)
    model = R.als_implicit(fit, rank=5, iterations=20)
    scored = model.transform(val).withColumnRenamed("prediction", "score")
    return R.mean_percentile_rank(scored, val)


@register("rec_als_explicit_recommend", "R7 R8 E8")
def rec_als_explicit_recommend(spark, d):
    from tessera.operators.encode import mean_normalize
    p = rec_pairs(spark, d)
    norm = mean_normalize(p, "product", "rating").select("user", "product",
                                                         F.col("normalized").cast("float").alias("rating"))
    model = R.als_explicit(norm, rank=3, reg=0.3, iterations=100)
    return R.recommend(model, 5).select("user", F.explode("recommendations").alias("r")).select(
        "user", "r.product", "r.rating")


@register("rec_behaviour_profile", "R10", sql="""
WITH e AS (SELECT user_id, CAST(floor(hour(ts) / 6) AS INTEGER) AS slot, event_type FROM events),
piv AS (SELECT user_id, count(*) FILTER (WHERE slot = 0) AS "0", count(*) FILTER (WHERE slot = 1) AS "1",
               count(*) FILTER (WHERE slot = 2) AS "2", count(*) FILTER (WHERE slot = 3) AS "3"
        FROM e GROUP BY user_id),
ps AS (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM ps)
SELECT piv.*, (SELECT event_type FROM rk WHERE rk.user_id = piv.user_id AND r = 1) AS top1,
       (SELECT event_type FROM rk WHERE rk.user_id = piv.user_id AND r = 2) AS top2
FROM piv
""")
def rec_behaviour_profile(spark, d):
    e = Tables(spark, d).events.select("user_id", F.floor(F.hour("ts") / 6).cast("int").alias("slot"),
                                       "event_type")
    return R.behaviour_profile(e, "user_id", "slot", "event_type", [0, 1, 2, 3])


# -------------------------------------------------------------- clustering


def emb_vectors(spark, d):
    from pyspark.ml.functions import array_to_vector
    e = Tables(spark, d).embeddings
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"),
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@register("kmeans_restarts", "K1 K5")
def kmeans_restarts(spark, d):
    e = emb_vectors(spark, d)
    m = K.kmeans_restarts(e, 10, seeds=list(range(1, 11)))
    pred = m.transform(e)
    sil = K.silhouette(pred)
    return pred.select("vec_id", "prediction").withColumn("silhouette", F.lit(sil))


@register("kmeans_by_spread", "K1 K3")
def kmeans_by_spread(spark, d):
    """The trial with the smallest spread; its spread and size per cluster."""
    e = emb_vectors(spark, d)
    m, spread = K.kmeans_by_spread(e, 8, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10], "vec_id", "v")
    return m.transform(e).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).withColumn("spread", F.lit(spread))


@register("kmeans_elbow", "K2")
def kmeans_elbow(spark, d):
    return K.elbow_costs(emb_vectors(spark, d), list(range(3, 20)))


_PAIR_SQL = """
pairs AS (SELECT a.label, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS dist
          FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id),
per AS (SELECT label, count(*) AS n_pairs, avg(dist) AS mean_distance, sqrt(avg(dist * dist)) AS rms FROM pairs GROUP BY label)
"""


@register("mean_intra_distance", "K3", sql=f"""
WITH {_PAIR_SQL} SELECT label, n_pairs, round(mean_distance, 4) AS mean_distance FROM per
""")
def mean_intra_distance(spark, d):
    m = K.mean_intra_distance(emb_vectors(spark, d), "label", "vec_id", "v")
    return m.select("label", "n_pairs", F.round("mean_distance", 4).alias("mean_distance"))


@register("cluster_spread", "K3", sql=f"""
WITH {_PAIR_SQL} SELECT round(avg(mean_distance), 4) AS spread, count(*) AS n_clusters FROM per
""")
def cluster_spread(spark, d):
    m = K.mean_intra_distance(emb_vectors(spark, d), "label", "vec_id", "v")
    return K.cluster_spread(m).select(F.round("spread", 4).alias("spread"), "n_clusters")


@register("rms_intra_distance", "K3", sql=f"""
WITH {_PAIR_SQL} SELECT label, round(rms, 4) AS rms_distance FROM per
""")
def rms_intra_distance(spark, d):
    r = K.rms_intra_distance(emb_vectors(spark, d), "label", "v", 64)
    return r.select("label", F.round("rms_distance", 4).alias("rms_distance"))


# Prediction: the class whose mean slot value is nearest to the row's mean slot value.
_CENTROID_SQL = """
c AS (SELECT label AS cls, avg(list_avg(CAST(embedding AS DOUBLE[]))) AS m FROM embeddings GROUP BY label),
p AS (SELECT vec_id, any_value(e.label) AS label,
             arg_min(cls, (abs(list_avg(CAST(embedding AS DOUBLE[])) - m), cls)) AS pred FROM embeddings e, c GROUP BY vec_id)
"""


def centroid_predictions(spark, d):
    from tessera.operators.classify import nearest_class_mean
    e = Tables(spark, d).embeddings
    size = F.size("embedding")
    mean = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x) / size
    return nearest_class_mean(e.select("vec_id", "label", mean.alias("m")), "label", "m")


@register("label_agreement", "K4", sql=f"""
WITH {_CENTROID_SQL}
SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS agreement FROM p
""")
def label_agreement(spark, d):
    return K.label_agreement(centroid_predictions(spark, d), "label", "pred").select(r6("agreement").alias("agreement"))


@register("target_cluster_filter", "K6", sql="""
SELECT vec_id, label FROM embeddings WHERE label IN (1, 3) AND embedding[1] <> 0
""")
def target_cluster_filter(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label", F.col("embedding")[0].alias("age"))
    return K.target_cluster_filter(e, "label", [1, 3], "age").select("vec_id", "label")


# ----------------------------------------------------------- classification
# Binary: returned line (l_returnflag = 'R') from quantity, discount, tax, price.

FEATS = ["l_quantity", "l_discount", "l_tax", "price_k"]


def clf_frame(spark, d):
    li = Tables(spark, d).lineitem
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_discount",
                     "l_tax", (F.col("l_extendedprice") / 1000).alias("price_k"),
                     (F.col("l_returnflag") == "R").cast("double").alias("label"))


def clf_split(spark, d):
    df = VectorAssembler(inputCols=FEATS, outputCol="features").transform(clf_frame(spark, d))
    s = V.hash_split(df, "id", [0.7, 0.3])
    return s.where(F.col("split") == 0), s.where(F.col("split") == 1)


def clf_stored(spark, d):
    """(training, test) rows of the split, stored by columns for the many scans of a fit."""
    return [spark.read.schema(x.schema).parquet(S.write_parquet(x, scratch_dir(spark, "clf_rows"))) for x in clf_split(spark, d)]


@register("clf_models_vote", "C1 C2 C3 C4 C5 C6 V12 V16")
def clf_models_vote(spark, d):
    """Five voters: logistic regression, tree, forest, Gaussian NB, AdaBoost with weights 1, 2, 2, 1, 2."""
    tr, te = clf_stored(spark, d)
    n = tr.count()
    lr = C.logistic_regression(n, C=1.0).setProbabilityCol("p_lr").setRawPredictionCol("r_lr").setPredictionCol("y_lr").fit(tr)
    dt = C.decision_tree(4).setProbabilityCol("p_dt").setRawPredictionCol("r_dt").setPredictionCol("y_dt").fit(tr)
    rf = C.random_forest(20, 5).setProbabilityCol("p_rf").setRawPredictionCol("r_rf").setPredictionCol("y_rf").fit(tr)
    ada = C.adaboost(tr, rounds=10, id_col="id")
    out = rf.transform(dt.transform(lr.transform(te)))
    out = C.gaussian_nb_proba(out, C.gaussian_nb_fit(tr, "label", FEATS), "label", FEATS, 1.0, "q_nb")
    out = C.adaboost_predict(out, ada)
    for c, o in (("p_lr", "q_lr"), ("p_dt", "q_dt"), ("p_rf", "q_rf")):
        out = C.positive_prob(out, c, o)
    out = C.soft_vote(out, ["q_lr", "q_dt", "q_rf", "q_nb", "prob_ada"], [1, 2, 2, 1, 2])
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="r_rf").evaluate(out)
    imp = rf.featureImportances.toArray().tolist()
    return out.select("id", "label", "vote_prob", "vote_pred").withColumn("rf_auc", F.lit(auc)).withColumn(
        "rf_importance_qty", F.lit(imp[0]))


@register("undersample_sweep", "C16 V9")
def undersample_sweep(spark, d):
    tr, te = (cut_lineage(x) for x in clf_split(spark, d))
    fit = lambda rows: C.logistic_regression(rows.count(), C=1.0).fit(rows)
    return V.undersample_sweep(tr, te, "id", "label", 0.0, [0.02, 0.05, 0.2, 0.5, 0.8], fit, positive=1.0)


SLOTS = 64


@register("clf_gaussian_nb_whole", "C4", sql="""
WITH e AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i, label FROM embeddings),
m AS (SELECT label AS cls, i, avg(x) AS mu, var_pop(x) AS v FROM e GROUP BY label, i),
p AS (SELECT label AS cls, count(*) / (SELECT count(*) FROM embeddings) AS prior FROM embeddings GROUP BY label),
s AS (SELECT e.vec_id, m.cls, sum(-0.5 * ln(2 * pi() * v) - (x - mu) ^ 2 / (2 * v)) AS ll
      FROM e JOIN m ON e.i = m.i GROUP BY e.vec_id, m.cls)
SELECT vec_id, arg_max(s.cls, ll + ln(prior)) AS prediction FROM s JOIN p ON s.cls = p.cls GROUP BY vec_id
""")
def clf_gaussian_nb_whole(spark, d):
    cols = [f"x{i + 1}" for i in range(SLOTS)]
    e = Tables(spark, d).embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c)
                                                                for i, c in enumerate(cols)])
    model = C.gaussian_nb_fit(e, "label", cols)
    return C.gaussian_nb_predict(e, model, "label", cols, "vec_id").select("vec_id", "prediction")


@register("clf_discriminant_whole", "C7 C8")
def clf_discriminant_whole(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label", "embedding")
    models = {name: C.vector_discriminant_fit(e, "label", "embedding", quadratic=name == "qda") for name in ("lda", "qda")}
    return C.vector_discriminant_predict(e, models, "vec_id", "embedding")


@register("clf_knn", "C9", sql=f"""
WITH e AS (SELECT vec_id, label, embedding AS v, {unit_sql('vec_id')} < 0.7 AS is_train FROM embeddings),
tr AS (SELECT * FROM e WHERE is_train), te AS (SELECT * FROM e WHERE NOT is_train),
dd AS (SELECT te.vec_id, tr.label, tr.vec_id AS tid,
              list_sum(list_transform(list_zip(te.v, tr.v), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ^ 2)) AS d2
       FROM te, tr),
top AS (SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, tid) AS r FROM dd) WHERE r <= 5),
votes AS (SELECT vec_id, label, count(*) AS n FROM top GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS r FROM votes)
SELECT vec_id, label AS prediction, n / 5.0 AS share FROM best WHERE r = 1
""")
def clf_knn(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label", F.col("embedding").alias("v"))
    u = V.hash_unit("vec_id")
    return C.knn_classify(e.where(u >= 0.7), e.where(u < 0.7), "vec_id", "v", "label", 5)


@register("clf_svm_mlp", "C10 C11 C12")
def clf_svm_mlp(spark, d):
    tr, te = clf_split(spark, d)
    n = tr.count()
    svm = C.linear_svm(n, C=1.0).setPredictionCol("svm").setRawPredictionCol("svm_raw").fit(tr)
    rff_tr = C.random_fourier_features(tr, FEATS, 20, 0.7)
    rff_te = C.random_fourier_features(te, FEATS, 20, 0.7)
    rbf = C.linear_svm(n, C=1.0, features="rff").setPredictionCol("rbf").setRawPredictionCol("rbf_raw").fit(rff_tr)
    net = C.mlp([len(FEATS), 6, 2], max_iter=30).setPredictionCol("mlp").setProbabilityCol("mlp_p").setRawPredictionCol("mlp_raw").fit(tr)
    out = net.transform(svm.transform(rbf.transform(rff_te)))
    return out.select("id", "label", "svm", "rbf", "mlp")


# ---------------------------------------------------------------- regression

RFEATS = ["l_quantity", "p_retailprice", "l_discount", "p_size"]


def reg_frame(spark, d):
    t = Tables(spark, d)
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_quantity",
                    "p_retailprice", "l_discount", F.col("p_size").cast("double").alias("p_size"),
                    "l_returnflag", "l_extendedprice"))


def reg_split(spark, d):
    """(training, test) rows of the split; stored once, so that the many scans of a fit repeat no join."""
    s = V.hash_split(reg_frame(spark, d), "id", [0.8, 0.2])
    s = spark.read.schema(s.schema).parquet(S.write_parquet(s, scratch_dir(spark, "reg_rows")))
    return s.where("split = 0"), s.where("split = 1")


@register("reg_simple_ols", "G1", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n FROM lineitem
""")
def reg_simple_ols(spark, d):
    s = G.simple_ols(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice")
    return s.select(r6("slope").alias("slope"), F.round("intercept", 4).alias("intercept"), r6("r2").alias("r2"), "n")


_TWO_SQL = """
f AS (SELECT l.l_quantity AS x, p.p_retailprice AS z, l.l_extendedprice AS y
      FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
g AS (SELECT count(*) AS n, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS xx, covar_pop(x, z) AS xz,
             var_pop(z) AS zz, covar_pop(x, y) AS xy, covar_pop(z, y) AS zy FROM f),
a AS (SELECT unnest([0.0, 5000.0]) AS alpha),
r AS (SELECT alpha, mx, mz, my, ((zz + alpha / n) * xy - xz * zy) / ((xx + alpha / n) * (zz + alpha / n) - xz * xz) AS b1,
             ((xx + alpha / n) * zy - xz * xy) / ((xx + alpha / n) * (zz + alpha / n) - xz * xz) AS b2 FROM g, a)
"""


@register("reg_two_features", "G1 G2", sql=f"""
WITH {_TWO_SQL}
SELECT CAST(alpha AS DOUBLE) AS alpha, round(b1, 4) AS b1, round(b2, 4) AS b2, round(my - b1 * mx - b2 * mz, 2) AS b0 FROM r
""")
def reg_two_features(spark, d):
    """OLS (alpha 0) and ridge by the estimators, against the closed form."""
    df = cut_lineage(reg_frame(spark, d).select("l_quantity", "p_retailprice", "l_extendedprice"))
    cols, rows = ["l_quantity", "p_retailprice"], []
    for alpha, pipe in ((0.0, G.linear_regression(cols, "l_extendedprice")), (5000.0, G.ridge(df, cols, "l_extendedprice", 5000.0))):
        m = pipe.fit(df).stages[-1]
        rows.append((alpha, *[round(float(c), 4) for c in m.coefficients], round(float(m.intercept), 2)))
    return spark.createDataFrame(rows, "alpha double, b1 double, b2 double, b0 double")


@register("reg_linear_models", "G1 G2 G3 G4 G5 V14 V17")
def reg_linear_models(spark, d):
    tr, te = reg_split(spark, d)
    rows = []
    for name, pipe in (("ols", G.linear_regression(RFEATS, "l_extendedprice")),
                       ("ridge", G.ridge(tr, RFEATS, "l_extendedprice", 50.0)),
                       ("lasso", G.lasso(RFEATS, "l_extendedprice", 4.0))):
        pred = pipe.fit(tr).transform(te)
        m = V.regression_metrics(pred, "l_extendedprice", "prediction", len(RFEATS)).first()
        rows.append((name, float(m["mse"]), float(m["r2"])))
    br = G.bayesian_ridge(tr, RFEATS, "l_extendedprice")
    pred = G.score_linear(te, RFEATS, br["coef"], br["intercept"])
    m = V.regression_metrics(pred, "l_extendedprice", "prediction", len(RFEATS)).first()
    rows.append(("bayes_ridge", float(m["mse"]), float(m["r2"])))
    rob = G.robust_regression(tr, RFEATS, "l_extendedprice", trials=5)
    pred = rob.transform(G.assemble(te, RFEATS))
    m = V.regression_metrics(pred, "l_extendedprice", "prediction", len(RFEATS)).first()
    rows.append(("robust", float(m["mse"]), float(m["r2"])))
    return V.model_comparison(spark, rows)


@register("reg_tree_models", "G6 G7 G8 V16")
def reg_tree_models(spark, d):
    tr, te = reg_split(spark, d)
    out = te
    for name, pipe in (("tree", G.tree_regressor(RFEATS, "l_extendedprice", 6, 5)),
                       ("forest", G.forest_regressor(RFEATS, "l_extendedprice", 10, 6)),
                       ("gbt", G.gbt_regressor(RFEATS, "l_extendedprice", 7, 0.1, 3))):
        stages = pipe.getStages()
        stages[-1].setPredictionCol(f"pred_{name}")
        stages[0].setOutputCol(f"f_{name}")
        stages[-1].setFeaturesCol(f"f_{name}")
        out = Pipeline(stages=stages).fit(tr).transform(out)
    return out.select("id", "l_extendedprice", "pred_tree", "pred_forest", "pred_gbt")


@register("reg_gbm_loops", "G9 G10 V15")
def reg_gbm_loops(spark, d):
    tr, te = reg_split(spark, d)
    _, _, m1 = G.gbm_residual(tr, RFEATS, "l_extendedprice", n_trees=10, learning_rate=0.1, max_depth=3, eval_df=te)
    _, _, m2 = G.gbm_residual(tr, RFEATS, "l_extendedprice", n_trees=10, learning_rate=0.1, max_depth=3, eta=2.0, eval_df=te)
    rows = [("symmetric", r, mae, rmse) for r, mae, rmse in m1] + [("asymmetric", r, mae, rmse) for r, mae, rmse in m2]
    return spark.createDataFrame(rows, "variant string, round int, mae double, rmse double")


@register("reg_per_segment_score", "G11 G12 S7")
def reg_per_segment_score(spark, d):
    tr, te = reg_split(spark, d)
    te = te.drop("l_extendedprice")
    models = G.model_per_segment(tr, "l_returnflag", lambda: G.tree_regressor(RFEATS, "l_extendedprice", 4))
    scored = G.score_per_segment(te, "l_returnflag", models)
    path = scratch_dir(spark, "scored_csv")
    G.train_then_score(tr, te, G.linear_regression(RFEATS, "l_extendedprice"), "id", path=path)
    whole = S.read_csv(spark, path, "id BIGINT, whole DOUBLE")
    return scored.select("id", "l_returnflag", "prediction").join(whole, "id")


@register("reg_optimal_bid_model", "G13 J9 T3 F10")
def reg_optimal_bid_model(spark, d):
    # Win "rate" model: share of discount in price, learned from line items.
    t = Tables(spark, d)
    lines = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
             .select(F.col("c_mktsegment").alias("context"), (F.col("l_discount") * 10).alias("bid"),
                     (F.col("l_tax") * 12.5).alias("rate")))
    model = G.forest_regressor(["bid"], "rate", 5, 3).fit(lines)
    grid = G.bid_grid(lines.select("context").distinct(), [0.01, 0.02, 0.10, 0.15, 0.30, 0.70])
    scored = model.transform(grid).withColumnRenamed("prediction", "rate_hat")
    return G.optimal_bid(scored, ["context", "cpc"], "rate_hat")


@register("reg_drop_one_feature", "G14")
def reg_drop_one_feature(spark, d):
    s = V.hash_split(reg_frame(spark, d), "id", [0.8, 0.2])
    return G.drop_one_feature(s.where("split = 0"), s.where("split = 1"), RFEATS, "l_extendedprice")


@register("reg_ridge_sweep", "G2 V7")
def reg_ridge_sweep(spark, d):
    s = V.hash_split(reg_frame(spark, d), "id", [0.8, 0.2])
    return G.ridge_sweep(s.where("split = 0"), s.where("split = 1"), RFEATS, "l_extendedprice",
                         [0.0, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0])


# --------------------------------------------------------- time-series models


@register("ts_pacf", "M2", sql="""
WITH s AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS x
           FROM orders GROUP BY 1, 2),
l AS (SELECT series_id, x, lag(x, 1) OVER w AS a, lag(x, 2) OVER w AS b FROM s WINDOW w AS (PARTITION BY series_id ORDER BY day)),
g AS (SELECT series_id, var_pop(a) AS aa, covar_pop(a, b) AS ab, var_pop(b) AS bb, covar_pop(x, a) AS xa, covar_pop(x, b) AS xb
      FROM l WHERE b IS NOT NULL GROUP BY 1)
SELECT series_id, 1 AS k, round(regr_slope(x, a), 6) AS pacf FROM l GROUP BY 1
UNION ALL SELECT series_id, 2, round((aa * xb - ab * xa) / (aa * bb - ab * ab), 6) FROM g
""")
def ts_pacf(spark, d):
    p = TS.pacf(cut_lineage(daily_series(spark, d)), "series_id", "day", "value", 2)
    return p.select("series_id", "k", r6("pacf").alias("pacf"))


@register("ts_pacf_lags", "M2")
def ts_pacf_lags(spark, d):
    return TS.pacf(cut_lineage(daily_series(spark, d)), "series_id", "day", "value", 5)


@register("ts_adf", "M3")
def ts_adf(spark, d):
    return TS.adf_test(cut_lineage(daily_series(spark, d)), "series_id", "day", "value")


@register("ts_arima_search", "M4 M5")
def ts_arima_search(spark, d):
    return TS.arima_order_search(cut_lineage(daily_series(spark, d)), "series_id", "day", "value", max_order=3)


@register("ts_arima_likelihood", "M4 M5")
def ts_arima_likelihood(spark, d):
    """All 64 orders of every series by conditional likelihood; ``best`` marks the lowest AIC of a series."""
    from tessera.operators.arima_ml import arima_ml
    return arima_ml(cut_lineage(daily_series(spark, d)), "series_id", "day", "value", 3)


@register("ts_forecast", "M6 F2")
def ts_forecast(spark, d):
    return TS.forecast(cut_lineage(daily_series(spark, d)), "series_id", "day", "value", 1, 0, 1, 10, log_transform=True)


@register("ts_in_sample", "M4 M6")
def ts_in_sample(spark, d):
    """Fitted values of the detrended series with the moving average added back."""
    from tessera.operators import ordered as O
    r = cut_lineage(O.rolling_detrend(daily_series(spark, d), "series_id", "day", "value", 4))
    fit = TS.in_sample(r.select("series_id", "day", "detrended"), "series_id", "day", "detrended", 1, 0, 1)
    placed = O.series_positions(r, ["series_id"], "day").select(
        "series_id", "day", "value", "rolling_mean", F.col("_pos").alias("position"))
    return TS.add_back(fit, placed, ["series_id", "position"], "fitted", "rolling_mean").select(
        "series_id", "day", "value", "restored")


# ------------------------------------------------------------------- tuning


@register("tune_cv_grid", "V4 V5")
def tune_cv_grid(spark, d):
    """Grid search by macro F1 over 5 folds, AUC over 10 folds of the same grid."""
    tr = cut_lineage(clf_split(spark, d)[0])
    grid = [(reg, net) for reg in (1e-4, 1e-2) for net in (0.0, 1.0)]
    metrics = {"macro_f1": (5, V.MacroF1Evaluator("label", "prediction")), "auc": (10, BinaryClassificationEvaluator(labelCol="label"))}
    means = W.logistic_cv(tr, "features", len(FEATS), "label", grid, list(metrics.values()), seed=1)
    rows = [(name, folds, i, float(m)) for (name, (folds, _)), values in zip(metrics.items(), means) for i, m in enumerate(values)]
    return spark.createDataFrame(rows, "metric string, folds int, setting int, value double")


@register("tune_random_search", "V6 V4")
def tune_random_search(spark, d):
    """Random search: 5 settings drawn from a larger grid, 4 folds."""
    import random
    tr = cut_lineage(clf_split(spark, d)[0])
    lr = C.logistic_regression(tr.count())
    grid = (ParamGridBuilder().addGrid(lr.regParam, [1e-5, 1e-4, 1e-3, 1e-2, 1e-1])
            .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())
    drawn = random.Random(5).sample(grid, 5)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=drawn, numFolds=4, parallelism=2, seed=1,
                        evaluator=BinaryClassificationEvaluator(labelCol="label")).fit(tr)
    rows = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m)) for p, m in zip(drawn, cv.avgMetrics)]
    return spark.createDataFrame(rows, "reg_param double, elastic_net double, auc double")


@register("tune_regression_cv", "V4 G2")
def tune_regression_cv(spark, d):
    """Three penalties over the ten folds that ``CrossValidator`` draws with seed 1, all from one scan."""
    pipe = G.linear_regression(RFEATS, "l_extendedprice")
    df = pipe.getStages()[0].transform(cut_lineage(reg_frame(spark, d)))
    scores = W.linear_cv(df, "features", len(RFEATS), "l_extendedprice", [0.0, 0.1, 1.0], W.drawn_fold(10, seed=1), 10)
    return spark.createDataFrame(list(enumerate(scores)), "setting int, r2 double")


# --------------------------------------------------------- sources and sinks


@register("src_csv_roundtrip", "S1 S7", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def src_csv_roundtrip(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = S.write_csv(o, scratch_dir(spark, "orders_csv"))
    return S.read_csv(spark, path, o.schema)


@register("src_lines_csv", "S2", sql="""
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
""")
def src_lines_csv(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    path = S.write_csv(li, scratch_dir(spark, "lines_csv"))
    return S.read_lines_csv(spark, path, li.schema)


@register("src_tsv_tagged", "S3 U1", sql="""
SELECT o_orderkey, o_orderpriority, o_orderstatus AS source FROM orders
""")
def src_tsv_tagged(spark, d):
    o = Tables(spark, d).orders
    paths = {}
    for st in ("F", "O", "P"):
        part = o.where(F.col("o_orderstatus") == st).select("o_orderkey", "o_orderpriority")
        p = scratch_dir(spark, f"tsv_{st}")
        part.write.mode("overwrite").option("sep", "\t").option("header", False).csv(p)
        paths[st] = p
    return S.read_tsv_tagged(spark, paths, "o_orderkey BIGINT, o_orderpriority STRING")


@register("src_rating_tuples", "S4", sql="""
SELECT CAST(o_custkey AS INTEGER) AS user, CAST(l_suppkey AS INTEGER) AS product, CAST(l_quantity AS FLOAT) AS rating
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def src_rating_tuples(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    p = scratch_dir(spark, "rating_tuples")
    (j.select(F.format_string("(%d, %d, %s)", "o_custkey", "l_suppkey", F.col("l_quantity").cast("string")).alias("value"))
     .write.mode("overwrite").text(p))
    return S.read_rating_tuples(spark, p)


@register("src_vectors", "S5", sql="""
SELECT 'w' || vec_id AS word, len(embedding[1:16]) AS dim, round(list_sum(CAST(embedding[1:16] AS DOUBLE[])), 4) AS vsum
FROM embeddings
""")
def src_vectors(spark, d):
    e = Tables(spark, d).embeddings
    p = scratch_dir(spark, "vectors_txt")
    (e.select(F.concat_ws(" ", F.concat(F.lit("w"), F.col("vec_id").cast("string")),
                          F.array_join(F.transform("embedding", lambda x: x.cast("string")), " ")).alias("value"))
     .write.mode("overwrite").text(p))
    v = S.read_vectors(spark, p, 16)
    return v.select("word", F.size("vector").cast("bigint").alias("dim"),
                    F.round(F.aggregate(F.transform("vector", lambda x: x.cast("double")), F.lit(0.0),
                                        lambda a, x: a + x), 4).alias("vsum"))


@register("src_query_table", "S6 Q1", sql="""
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal > 0
""")
def src_query_table(spark, d):
    Tables(spark, d).customer.createOrReplaceTempView("tq_customer")
    return S.query_table(spark, "SELECT c_custkey, c_name, c_nationkey FROM tq_customer WHERE c_acctbal > 0")


@register("src_parquet_reload", "S8", sql="""
SELECT o_custkey AS user, count(*) AS n FROM orders GROUP BY 1
""")
def src_parquet_reload(spark, d):
    o = Tables(spark, d).orders.groupBy(F.col("o_custkey").alias("user")).agg(F.count(F.lit(1)).alias("n"))
    return spark.read.parquet(S.write_parquet(o, scratch_dir(spark, "prepared_pairs")))


@register("src_replace_table", "S9 B5", sql="""
WITH r AS (SELECT p_brand AS item, count(*) AS n FROM part GROUP BY 1)
SELECT row_number() OVER (ORDER BY n DESC, item) AS id, item, n FROM r
""")
def src_replace_table(spark, d):
    r = Tables(spark, d).part.groupBy(F.col("p_brand").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    out = S.replace_table(r, "tessera_brand_counts", scratch_dir(spark, "brand_counts_tbl"),
                          [F.col("n").desc(), F.col("item")], "id")
    return out.select("id", "item", "n")


@register("similar_users", "R9", sql="""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id, b.vec_id AS similar_id, list_cosine_similarity(a.v, b.v) AS cosine
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, similar_id) AS rank FROM s)
SELECT vec_id, similar_id, round(cosine, 6) AS cosine, rank FROM r WHERE rank <= 3
""")
def similar_users(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    s = R.similar_users(e, "vec_id", "v", k=3)
    return s.select("vec_id", F.col("similar").alias("similar_id"), r6("cosine").alias("cosine"), F.col("rank").cast("bigint").alias("rank"))


@register("ranked_feature_table", "T4 V16")
def ranked_feature_table(spark, d):
    tr, _ = clf_split(spark, d)
    rf = C.random_forest(10, 4).fit(tr)
    rows = list(zip(FEATS, [float(x) for x in rf.featureImportances.toArray()]))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())
