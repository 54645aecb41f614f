"""Classifiers on a few slots, written out in SQL (the registered queries read all slots)."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.sources.tables import Tables
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

NB_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x1, CAST(embedding[2] AS DOUBLE) AS x2,
                  CAST(embedding[3] AS DOUBLE) AS x3 FROM embeddings),
m AS (SELECT label AS cls, count(*) / (SELECT count(*) FROM e) AS prior, avg(x1) AS m1, var_pop(x1) AS v1,
             avg(x2) AS m2, var_pop(x2) AS v2, avg(x3) AS m3, var_pop(x3) AS v3 FROM e GROUP BY label),
s AS (SELECT e.vec_id, m.cls,
             ln(prior) - 0.5 * ln(2 * pi() * v1) - (x1 - m1) ^ 2 / (2 * v1)
                       - 0.5 * ln(2 * pi() * v2) - (x2 - m2) ^ 2 / (2 * v2)
                       - 0.5 * ln(2 * pi() * v3) - (x3 - m3) ^ 2 / (2 * v3) AS ll
      FROM e, m)
SELECT vec_id, arg_max(cls, ll) AS prediction FROM s GROUP BY vec_id
"""

DISCRIMINANT_SQL = """
WITH e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
m AS (SELECT label, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c
      FROM e GROUP BY label),
w AS (SELECT sum(n) AS t, sum(a * (n - 1)) / (sum(n) - count(*)) AS a, sum(b * (n - 1)) / (sum(n) - count(*)) AS b,
             sum(c * (n - 1)) / (sum(n) - count(*)) AS c FROM m),
s AS (SELECT e.vec_id, m.label AS cls,
             ln(n / t) - 0.5 * (w.c * (x - mx) ^ 2 - 2 * w.b * (x - mx) * (y - my) + w.a * (y - my) ^ 2)
                       / (w.a * w.c - w.b * w.b) AS l,
             ln(n / t) - 0.5 * ln(m.a * m.c - m.b * m.b)
                       - 0.5 * (m.c * (x - mx) ^ 2 - 2 * m.b * (x - mx) * (y - my) + m.a * (y - my) ^ 2)
                       / (m.a * m.c - m.b * m.b) AS q
      FROM e, m, w)
SELECT vec_id, arg_max(cls, l) AS lda, arg_max(cls, q) AS qda FROM s GROUP BY vec_id
"""


def clf_gaussian_nb(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"x{i+1}")
                                                                for i in range(3)])
    cols = ["x1", "x2", "x3"]
    model = C.gaussian_nb_fit(e, "label", cols)
    return C.gaussian_nb_predict(e, model, "label", cols, "vec_id").select("vec_id", "prediction")


def clf_discriminant(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"x{i+1}")
                                                                for i in range(2)])
    cols = ["x1", "x2"]
    lda = C.discriminant_predict(e, C.discriminant_fit(e, "label", cols), "vec_id").withColumnRenamed("prediction", "lda")
    qda = C.discriminant_predict(e, C.discriminant_fit(e, "label", cols, quadratic=True), "vec_id").withColumnRenamed("prediction", "qda")
    return lda.join(qda, "vec_id")


@pytest.mark.parametrize("fn,sql", [(clf_gaussian_nb, NB_SQL), (clf_discriminant, DISCRIMINANT_SQL)])
def test_against_sql(spark, fn, sql):
    assert compare(spark, duck(SF), fn.__name__, fn, sql, SF)["status"] in ("EXACT", "CLOSE")
