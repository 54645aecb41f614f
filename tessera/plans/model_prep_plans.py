"""Encoding (E*), splitting (V1-V3, C16) and evaluation (V8-V15) queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tessera.operators import encode as E
from tessera.operators import evaluate as V
from tessera.plans.catalog import register, unit_sql
from tessera.plans.model_plans import _CENTROID_SQL, centroid_predictions
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- encoding


@register("label_encode", "E1 E2", sql=f"""
WITH tr AS (SELECT DISTINCT p_type FROM part WHERE {unit_sql('p_partkey')} < 0.7),
codes AS (SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS type_id FROM tr)
SELECT p.p_partkey, p.p_type, coalesce(c.type_id, (SELECT count(*) FROM tr)) AS type_id,
       coalesce(c.p_type, '__unknown') AS back
FROM part p LEFT JOIN codes c ON p.p_type = c.p_type
""")
def label_encode(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_type")
    train = p.where(V.hash_unit("p_partkey") < 0.7)
    model = E.label_encoder("p_type", "type_idx").fit(train)
    out = model.transform(p)
    back = E.inverse_label("type_idx", list(model.labels) + ["__unknown"], "back").transform(out)
    return back.select("p_partkey", "p_type", F.col("type_idx").cast("bigint").alias("type_id"), "back")


@register("one_hot_columns", "E3", sql="""
SELECT c_custkey,
       CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS c_mktsegment_AUTOMOBILE,
       CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS c_mktsegment_BUILDING,
       CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS c_mktsegment_FURNITURE,
       CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS c_mktsegment_HOUSEHOLD,
       CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS c_mktsegment_MACHINERY
FROM customer
""")
def one_hot_columns(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    return E.OneHotColumns(["c_mktsegment"]).fit(c).transform(c).drop("c_mktsegment")


@register("one_hot_min_count", "E4", sql="""
WITH kept AS (SELECT p_type FROM part GROUP BY p_type HAVING count(*) >= 340)
SELECT p.p_partkey, 'p_type_' || k.p_type AS feature, CAST(p.p_type = k.p_type AS INTEGER) AS value
FROM part p, kept k
""")
def one_hot_min_count(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_type")
    enc = E.OneHotColumns(["p_type"], min_count=340).fit(p)
    wide = enc.transform(p).drop("p_type")
    cols = [c for c in wide.columns if c != "p_partkey"]
    if not cols:
        return spark.createDataFrame([], "p_partkey bigint, feature string, value int")
    # Checked in long form: the set of generated columns depends on the data.
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr("p_partkey", f"stack({len(cols)}, {pairs}) as (feature, value)")


@register("one_hot_vector", "E3 E7")
def one_hot_vector(spark, d):
    o = Tables(spark, d).orders
    train = o.where(F.year("o_orderdate") == 1997)
    pipe = Pipeline(stages=[E.label_encoder("o_orderpriority", "prio_idx"), E.one_hot_vector("prio_idx")])
    return pipe.fit(train).transform(o).select("o_orderkey", "prio_idx", "prio_idx_vec")


@register("standardize_pop", "E5", sql=f"""
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM orders
           WHERE {unit_sql('o_orderkey')} < 0.7)
SELECT o_orderkey, round((o_totalprice - m) / sd, 6) AS z FROM orders, s
""")
def standardize_pop(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    st = E.Standardizer(["o_totalprice"]).fit(o.where(V.hash_unit("o_orderkey") < 0.7))
    return st.transform(o).select("o_orderkey", r6("o_totalprice").alias("z"))


@register("minmax_scale", "E6", sql="""
SELECT p_partkey, round((p_retailprice - (SELECT min(p_retailprice) FROM part)) /
       ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)), 6) AS scaled FROM part
""")
def minmax_scale(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_retailprice")
    return E.MinMaxScaler01(["p_retailprice"]).fit(p).transform(p).select(
        "p_partkey", r6("p_retailprice").alias("scaled"))


@register("aligned_encoding", "E7 E1", sql="""
WITH tr AS (SELECT DISTINCT o_orderpriority FROM orders WHERE year(o_orderdate) = 1997),
codes AS (SELECT o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM tr)
SELECT o.o_orderkey, year(o.o_orderdate) = 1997 AS is_train, c.code
FROM orders o JOIN codes c ON o.o_orderpriority = c.o_orderpriority
""")
def aligned_encoding(spark, d):
    o = Tables(spark, d).orders
    train = o.where(F.year("o_orderdate") == 1997)
    enc = E.label_encoder("o_orderpriority", "code").fit(train)   # fitted once, on training rows
    return enc.transform(o).select("o_orderkey", (F.year("o_orderdate") == 1997).alias("is_train"),
                                   F.col("code").cast("bigint").alias("code"))


@register("mean_normalize", "E8", sql="""
WITH r AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item, count(*) AS rating
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)
SELECT user_id, item, rating, round(rating - avg(rating) OVER (PARTITION BY item), 6) AS normalized FROM r
""")
def mean_normalize(spark, d):
    t = Tables(spark, d)
    r = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
         .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item"))
         .agg(F.count(F.lit(1)).alias("rating")))
    return E.mean_normalize(r, "item", "rating").select("user_id", "item", "rating", r6("normalized").alias("normalized"))


@register("category_embedding", "E9")
def category_embedding(spark, d):
    p = Tables(spark, d).part
    return E.category_embedding(p, "p_type", ["p_size", "p_retailprice"], k=2)


# --------------------------------------------------------------- splitting


@register("hash_split_3way", "V1", sql=f"""
SELECT o_orderkey, CASE WHEN {unit_sql('o_orderkey')} < 0.6 THEN 0
                        WHEN {unit_sql('o_orderkey')} < 0.8 THEN 1 ELSE 2 END AS split
FROM orders
""")
def hash_split_3way(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    return V.hash_split(o, "o_orderkey", [0.6, 0.2, 0.2])


@register("random_split", "V1 P12")
def random_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey")
    tr, te = V.random_split(o, [0.7, 0.3], seed=11)
    return tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))


@register("stratified_split", "V2", sql=f"""
SELECT doc_id, quality, {unit_sql('quality', 'doc_id')} < 0.3 AS is_test FROM labels
""")
def stratified_split(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", "quality")
    return V.stratified_split(lab, "doc_id", "quality", 0.3)


@register("undersample_majority", "C16", sql=f"""
SELECT doc_id, quality FROM labels WHERE quality <> 1 OR {unit_sql('doc_id')} < 0.2
""")
def undersample_majority(spark, d):
    lab = Tables(spark, d).labels.select("doc_id", "quality")
    return V.undersample(lab, "doc_id", "quality", majority=1, keep_frac=0.2)


# -------------------------------------------------------------- evaluation
# Binary: label = labels.quality, prediction = long document (n_chars > 1500),
# score = n_chars / 1e5.

_BIN_SQL = """
b AS (SELECT l.doc_id, l.quality AS label, CAST(d.n_chars > 1500 AS INTEGER) AS pred, d.n_chars / 100000.0 AS score
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""


def binary_frame(spark, d):
    t = Tables(spark, d)
    return (t.labels.join(t.documents, "doc_id")
            .select("doc_id", F.col("quality").alias("label"),
                    (F.col("n_chars") > 1500).cast("int").alias("pred"),
                    (F.col("n_chars") / 100000.0).alias("score")))


@register("confusion_matrix", "V8", sql=f"""
WITH {_BIN_SQL}
SELECT sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
       sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
       sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn FROM b
""")
def confusion_matrix(spark, d):
    return V.confusion_counts(binary_frame(spark, d), "label", "pred")


@register("precision_recall_f1", "V9", sql=f"""
WITH {_BIN_SQL},
c AS (SELECT sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM b)
SELECT round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM c
""")
def precision_recall_f1(spark, d):
    m = V.precision_recall_f1(binary_frame(spark, d), "label", "pred")
    return m.select(r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"))


@register("accuracy", "V11", sql=f"""
WITH {_BIN_SQL}
SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM b
""")
def accuracy(spark, d):
    return V.accuracy(binary_frame(spark, d), "label", "pred").select(r6("accuracy").alias("accuracy"))


# Multiclass: embeddings label vs the class of the nearest mean (see model_plans).
_MC_SQL = f"""
{_CENTROID_SQL.strip()},
mc AS (SELECT label, pred FROM p),
lab AS (SELECT label AS cls, count(*) AS support FROM mc GROUP BY 1),
prd AS (SELECT pred AS cls, count(*) AS n_pred FROM mc GROUP BY 1),
tp AS (SELECT label AS cls, count(*) AS tp FROM mc WHERE label = pred GROUP BY 1),
j AS (SELECT coalesce(lab.cls, prd.cls) AS cls, coalesce(support, 0) AS support, coalesce(n_pred, 0) AS n_pred,
             coalesce(tp.tp, 0) AS tp
      FROM lab FULL JOIN prd ON lab.cls = prd.cls LEFT JOIN tp ON coalesce(lab.cls, prd.cls) = tp.cls),
per AS (SELECT CAST(cls AS VARCHAR) AS cls, coalesce(tp / nullif(n_pred, 0), 0.0) AS p,
               coalesce(tp / nullif(support, 0), 0.0) AS r, support FROM j),
per2 AS (SELECT cls, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1, support FROM per)
"""


@register("classification_report", "V10", sql=f"""
WITH {_MC_SQL}
SELECT cls, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, support FROM per2
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), sum(support) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), sum(support) FROM per2
""")
def classification_report(spark, d):
    rep = V.classification_report(centroid_predictions(spark, d), "label", "pred")
    return rep.select("cls", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


@register("roc_auc", "V12", sql=f"""
WITH {_BIN_SQL},
g AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM b GROUP BY score),
c AS (SELECT score, tp, fp, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp FROM g),
t AS (SELECT sum(tp) AS P, sum(fp) AS N FROM g)
SELECT round(sum((cfp - (cfp - fp)) / N * ((ctp / P) + ((ctp - tp) / P)) / 2), 6) AS auc FROM c, t
""")
def roc_auc(spark, d):
    _, auc = V.roc_curve(binary_frame(spark, d), "label", "score")
    return auc.select(r6("auc").alias("auc"))


@register("roc_points", "V12", sql=f"""
WITH {_BIN_SQL},
g AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM b GROUP BY score),
c AS (SELECT score, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp FROM g),
t AS (SELECT sum(tp) AS P, sum(fp) AS N FROM g)
SELECT score, round(cfp / N, 6) AS fpr, round(ctp / P, 6) AS tpr FROM c, t
""")
def roc_points(spark, d):
    pts, _ = V.roc_curve(binary_frame(spark, d), "label", "score")
    return pts.select("score", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("pr_auc", "V13", sql=f"""
WITH {_BIN_SQL},
g AS (SELECT score, sum(label) AS tp, sum(1 - label) AS fp FROM b GROUP BY score),
c AS (SELECT score, tp, fp, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp FROM g),
t AS (SELECT sum(tp) AS P FROM g),
q AS (SELECT ctp / P AS r, ctp / (ctp + cfp) AS p, (ctp - tp) / P AS r0,
             CASE WHEN (ctp - tp) + (cfp - fp) = 0 THEN 1.0 ELSE (ctp - tp) / ((ctp - tp) + (cfp - fp)) END AS p0
      FROM c, t)
SELECT round(sum((r - r0) * (p + p0) / 2), 6) AS pr_auc FROM q
""")
def pr_auc(spark, d):
    _, area = V.pr_curve(binary_frame(spark, d), "label", "score")
    return area.select(r6("pr_auc").alias("pr_auc"))


_REG_SQL = """
rg AS (SELECT l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS pred
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
"""


def regression_frame(spark, d):
    t = Tables(spark, d)
    return (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_extendedprice").alias("y"),
                    (F.col("l_quantity") * F.col("p_retailprice")).alias("pred")))


@register("regression_metrics", "V14", sql=f"""
WITH {_REG_SQL},
m AS (SELECT count(*) AS n, avg(abs(y - pred)) AS mae, avg((y - pred) * (y - pred)) AS mse, var_pop(y) AS vy FROM rg)
SELECT n, round(mae, 4) AS mae, round(mse, 2) AS mse, round(sqrt(mse), 4) AS rmse, round(1 - mse / vy, 6) AS r2,
       round(1 - (mse / vy) * (n - 1) / (n - 1 - 1), 6) AS adj_r2 FROM m
""")
def regression_metrics(spark, d):
    m = V.regression_metrics(regression_frame(spark, d), "y", "pred", 1)
    return m.select("n", F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"),
                    F.round("rmse", 4).alias("rmse"), r6("r2").alias("r2"), r6("adj_r2").alias("adj_r2"))


@register("split_mae", "V15", sql=f"""
WITH {_REG_SQL}
SELECT round(avg(y - pred) FILTER (WHERE y >= pred), 4) AS mae_under,
       round(avg(pred - y) FILTER (WHERE y < pred), 4) AS mae_over,
       count(*) FILTER (WHERE y >= pred) AS n_under, count(*) FILTER (WHERE y < pred) AS n_over FROM rg
""")
def split_mae(spark, d):
    m = V.split_mae(regression_frame(spark, d), "y", "pred")
    return m.select(F.round("mae_under", 4).alias("mae_under"), F.round("mae_over", 4).alias("mae_over"),
                    "n_under", "n_over")
