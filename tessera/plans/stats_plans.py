"""Statistics queries (H*) on lineitem / orders / events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.stats import two_sided_p_sql
from tessera.operators import stats as H
from tessera.plans.catalog import register
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


@register("pearson", "H1", sql="""
SELECT round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
""")
def pearson(spark, d):
    return H.pearson(Tables(spark, d).lineitem, "l_quantity", "l_extendedprice").select(r6("corr").alias("corr"))


@register("correlation_with_target", "H2", sql="""
SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM lineitem
""")
def correlation_with_target(spark, d):
    c = H.correlation_with_target(Tables(spark, d).lineitem, ["l_quantity", "l_discount", "l_tax"],
                                  "l_extendedprice")
    return c.select("feature", r6("corr").alias("corr"))


@register("correlation_matrix", "H2", sql="""
SELECT 'l_quantity' AS col_a, 'l_discount' AS col_b, round(corr(l_quantity, l_discount), 6) AS corr FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem
UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 6) FROM lineitem
""")
def correlation_matrix(spark, d):
    c = H.correlation_matrix(Tables(spark, d).lineitem, ["l_quantity", "l_discount", "l_tax"])
    return c.select("col_a", "col_b", r6("corr").alias("corr"))


@register("eta_ratio", "H3", sql="""
WITH m AS (SELECT avg(o_totalprice) AS mu FROM orders),
g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mc FROM orders GROUP BY 1)
SELECT round(sqrt((SELECT sum(n * (mc - mu) * (mc - mu)) FROM g, m) /
                  (SELECT sum((o_totalprice - mu) * (o_totalprice - mu)) FROM orders, m)), 6) AS eta
""")
def eta_ratio(spark, d):
    return H.eta_ratio(Tables(spark, d).orders, "o_orderpriority", "o_totalprice").select(r6("eta").alias("eta"))


@register("pairwise_z_tests", "H4 H5", sql=f"""
WITH m AS (SELECT event_type, count(*) AS n, avg(value) AS mean, var_pop(value) AS var FROM events GROUP BY 1),
p AS (SELECT a.event_type AS group_a, b.event_type AS group_b,
             (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS z
      FROM m a JOIN m b ON a.event_type < b.event_type)
SELECT group_a, group_b, round(z, 6) AS z, round({two_sided_p_sql('z')}, 6) AS p_value FROM p
""")
def pairwise_z_tests(spark, d):
    z = H.pairwise_z_tests(Tables(spark, d).events, "event_type", "value")
    return z.select("group_a", "group_b", r6("z").alias("z"), r6("p_value").alias("p_value"))


@register("grouped_z_tests", "H5", sql=f"""
WITH e AS (SELECT * FROM events WHERE value <> 0),
m AS (SELECT user_id % 3 AS segment, event_type, count(*) AS n, avg(value) AS mean, var_pop(value) AS var
      FROM e GROUP BY 1, 2),
p AS (SELECT a.segment, a.event_type AS group_a, b.event_type AS group_b,
             (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS z
      FROM m a JOIN m b ON a.segment = b.segment AND a.event_type < b.event_type)
SELECT segment, group_a, group_b, round(z, 6) AS z, round({two_sided_p_sql('z')}, 6) AS p_value FROM p
""")
def grouped_z_tests(spark, d):
    """All pairs of event types inside each user segment, zeros removed."""
    e = Tables(spark, d).events.withColumn("segment", F.col("user_id") % 3)
    z = H.pairwise_z_tests(e, "event_type", "value", within=["segment"], drop_zeros=True)
    return z.select("segment", "group_a", "group_b", r6("z").alias("z"), r6("p_value").alias("p_value"))


@register("chi_square_gof", "H6 A10", sql="""
WITH pos AS (SELECT o_orderpriority AS cat, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
ref AS (SELECT o_orderpriority AS cat, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
ps AS (SELECT cat, n, round(n / (SELECT sum(n) FROM pos), 4) AS o FROM pos ORDER BY n DESC, cat LIMIT 10),
rs AS (SELECT cat, round(n / (SELECT sum(n) FROM ref), 4) AS e FROM ref)
SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, count(*) AS n_categories
FROM ps JOIN rs ON ps.cat IS NOT DISTINCT FROM rs.cat WHERE e > 0
""")
def chi_square_gof(spark, d):
    o = Tables(spark, d).orders
    c = H.chi_square_gof(o.where(F.col("o_orderstatus") == "F"), o.where(F.col("o_orderstatus") == "O"),
                         "o_orderpriority", top=10)
    return c.select(r6("chi2").alias("chi2"), "n_categories")


@register("median_mean_by_class", "H7", sql="""
SELECT l_returnflag, round(sum(l_extendedprice), 2) / count(*) AS mean,
       round(median(l_extendedprice), 6) AS median
FROM lineitem GROUP BY 1
""")
def median_mean_by_class(spark, d):
    li = Tables(spark, d).lineitem
    med = H.median_mean_by(li, "l_returnflag", "l_extendedprice").select("l_returnflag", "median")
    mean = li.groupBy("l_returnflag").agg((F.round(F.sum("l_extendedprice"), 2) / F.count(F.lit(1))).alias("mean"))
    return mean.join(med, "l_returnflag").select("l_returnflag", "mean", r6("median").alias("median"))


@register("modified_z_report", "H8 H9", sql="""
WITH normal AS (SELECT value FROM events WHERE event_type <> 'error'),
med AS (SELECT median(value) AS m FROM normal),
mad AS (SELECT median(abs(value - (SELECT m FROM med))) AS s FROM normal),
f AS (SELECT nullif(value, 0.0) AS x FROM events WHERE event_type = 'error')
SELECT (SELECT m FROM med) AS median, (SELECT s FROM mad) AS mad,
       count(x) AS n_non_null, count(*) - count(x) AS n_null,
       sum(CASE WHEN x IS NOT NULL AND abs(0.6745 * (x - (SELECT m FROM med)) / (SELECT s FROM mad)) > 3.5 THEN 1 ELSE 0 END) AS n_flagged,
       round(sum(CASE WHEN x IS NOT NULL AND abs(0.6745 * (x - (SELECT m FROM med)) / (SELECT s FROM mad)) > 3.5 THEN 1 ELSE 0 END) / count(x), 6) AS recall,
       round((count(*) - count(x)) / count(x), 6) AS nan_ratio
FROM f
""")
def modified_z_report(spark, d):
    e = Tables(spark, d).events
    normal = e.where(F.col("event_type") != "error").select("value")
    fraud = e.where(F.col("event_type") == "error").select(F.nullif("value", F.lit(0.0)).alias("value"))
    r = H.modified_z_report(normal, fraud, "value")
    return r.select("median", "mad", "n_non_null", "n_null", "n_flagged", r6("recall").alias("recall"),
                    r6("nan_ratio").alias("nan_ratio"))


@register("histogram_bins", "H10", sql="""
SELECT event_type, CASE WHEN value < 0 THEN 0 WHEN value >= 50 THEN 11
                        ELSE CAST(floor(value / 5.0) AS BIGINT) + 1 END AS bin, count(*) AS n
FROM events GROUP BY 1, 2
""")
def histogram_bins(spark, d):
    return H.histogram(Tables(spark, d).events, "value", 0.0, 50.0, 10, group="event_type")


@register("boxplot_numbers", "H10", sql="""
SELECT event_type, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.25), 6) AS q1,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3
FROM events GROUP BY 1
""")
def boxplot_numbers(spark, d):
    b = H.boxplot_numbers(Tables(spark, d).events, "value", "event_type")
    return b.select("event_type", "min", "max", r6("q1").alias("q1"), r6("median").alias("median"),
                    r6("q3").alias("q3"))
