"""Relational core queries (P*, J*, A*, U*, Q*) on customer / orders /
lineitem / part / nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import relational as R
from tessera.operators.evaluate import hash_unit
from tessera.plans.catalog import register, unit_sql
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


# ------------------------------------------------------------- projection


@register("proj_drop_columns", "P1", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
""")
def proj_drop_columns(spark, d):
    return R.drop_columns(Tables(spark, d).orders, ["o_orderstatus", "o_orderpriority"])


@register("proj_select_columns", "P1", sql="""
SELECT o_orderkey, o_totalprice FROM orders
""")
def proj_select_columns(spark, d):
    return R.select_columns(Tables(spark, d).orders, ["o_orderkey", "o_totalprice"])


@register("proj_positions", "P2", sql="""
SELECT l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem
""")
def proj_positions(spark, d):
    return R.select_positions(Tables(spark, d).lineitem, [3, 4, 5, 6])


@register("proj_label_range", "P2", sql="""
SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
""")
def proj_label_range(spark, d):
    return R.select_range(Tables(spark, d).lineitem, "l_quantity", "l_tax")


@register("proj_rename", "P3", sql="""
SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer
""")
def proj_rename(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    return R.rename_columns(c, {"c_custkey": "customer_id", "c_mktsegment": "segment"})


@register("filter_equality", "P4", sql="""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def filter_equality(spark, d):
    o = Tables(spark, d).orders
    return o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@register("filter_range_inclusive", "P4 F1", sql="""
SELECT l_orderkey, l_linenumber, round(l_discount / nullif(l_tax, 0), 6) AS ratio
FROM lineitem
WHERE l_tax <> 0 AND l_discount / l_tax BETWEEN 0 AND 1
""")
def filter_range_inclusive(spark, d):
    li = Tables(spark, d).lineitem.withColumn("ratio", S.ratio_in_range("l_discount", "l_tax"))
    return li.where(F.col("ratio").isNotNull()).select("l_orderkey", "l_linenumber",
                                                      r6("ratio").alias("ratio"))


@register("filter_membership", "P4", sql="""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def filter_membership(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_mktsegment")
    return R.filter_isin(c, "c_mktsegment", ["BUILDING", "MACHINERY"])


@register("filter_year_holdout", "P4 V3", sql="""
SELECT o_orderkey, year(o_orderdate) = 1997 AS is_holdout FROM orders
""")
def filter_year_holdout(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", (F.year("o_orderdate") == 1997).alias("is_holdout"))


@register("filter_strict_between", "P4", sql="""
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_acctbal < 5000
""")
def filter_strict_between(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_acctbal")
    return R.filter_between(c, "c_acctbal", 0, 5000, strict=True)


# ------------------------------------------------------------ missing data
# Zero discount / tax are treated as "not recorded" to get real NULLs.

_LINES_WITH_NULLS = """
(SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS discount,
        nullif(l_tax, 0.0) AS tax, l_quantity, l_returnflag FROM lineitem)
"""


def lines_with_nulls(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif("l_discount", F.lit(0.0)).alias("discount"),
                     F.nullif("l_tax", F.lit(0.0)).alias("tax"), "l_quantity", "l_returnflag")


@register("null_counts", "P5", sql=f"""
SELECT 'discount' AS column_name, count(*) - count(discount) AS n_missing FROM {_LINES_WITH_NULLS}
UNION ALL SELECT 'tax', count(*) - count(tax) FROM {_LINES_WITH_NULLS}
UNION ALL SELECT 'l_quantity', count(*) - count(l_quantity) FROM {_LINES_WITH_NULLS}
""")
def null_counts(spark, d):
    return R.null_counts(lines_with_nulls(spark, d), ["discount", "tax", "l_quantity"])


@register("drop_nulls_subset", "P6", sql=f"""
SELECT l_orderkey, l_linenumber FROM {_LINES_WITH_NULLS} WHERE discount IS NOT NULL AND tax IS NOT NULL
""")
def drop_nulls_subset(spark, d):
    return R.drop_nulls(lines_with_nulls(spark, d), ["discount", "tax"]).select("l_orderkey", "l_linenumber")


@register("fill_constant", "P7", sql=f"""
SELECT l.l_orderkey, l.l_linenumber, coalesce(l.discount, 0.0) AS discount,
       coalesce(nullif(c.c_mktsegment, 'BUILDING'), 'No Type') AS segment
FROM {_LINES_WITH_NULLS} l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
""")
def fill_constant(spark, d):
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    j = (lines_with_nulls(spark, d).join(t.orders.select("o_orderkey", "o_custkey"),
                                         F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey")))
    return R.fill_constant(j, {"discount": 0.0, "segment": "No Type"}).select(
        "l_orderkey", "l_linenumber", "discount", "segment")


@register("impute_median", "P8", sql=f"""
WITH l AS {_LINES_WITH_NULLS},
m AS (SELECT median(discount) AS md, median(tax) AS mt FROM l WHERE {unit_sql('l_orderkey')} < 0.7)
SELECT l_orderkey, l_linenumber, round(coalesce(discount, md), 6) AS discount,
       round(coalesce(tax, mt), 6) AS tax
FROM l, m
""")
def impute_median(spark, d):
    li = lines_with_nulls(spark, d)
    train = li.where(hash_unit("l_orderkey") < 0.7)
    imp = R.MedianImputer(["discount", "tax"]).fit(train)
    return imp.transform(li).select("l_orderkey", "l_linenumber", r6("discount").alias("discount"),
                                    r6("tax").alias("tax"))


@register("profile_lineitem", "P9", sql="""
WITH long AS (
  SELECT 'l_quantity' AS column_name, CAST(l_quantity AS DOUBLE) AS value FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem)
SELECT column_name, count(value) AS count, round(sum(value), 2) / count(value) AS mean,
       round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
       count(DISTINCT value) AS n_distinct,
       round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50,
       round(quantile_cont(value, 0.75), 6) AS q75
FROM long GROUP BY column_name
""")
def profile_lineitem(spark, d):
    p = R.profile(Tables(spark, d).lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    mean = F.round("total", 2) / F.col("count")
    return p.select("column_name", "count", mean.alias("mean"), r6("std").alias("std"),
                    "min", "max", "n_distinct", r6("q25").alias("q25"), r6("q50").alias("q50"),
                    r6("q75").alias("q75"))


@register("min_max_dates", "P10", sql="""
SELECT min(o_orderdate) AS min_o_orderdate, max(o_orderdate) AS max_o_orderdate,
       min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice FROM orders
""")
def min_max_dates(spark, d):
    return R.min_max(Tables(spark, d).orders, ["o_orderdate", "o_totalprice"])


@register("cut_outliers", "P11", sql="""
SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > 50000 THEN 'outlier' ELSE 'kept' END AS part
FROM lineitem WHERE l_extendedprice <> 50000
""")
def cut_outliers(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return R.cut_outliers(li, "l_extendedprice", 50000.0).drop("l_extendedprice")


@register("random_sample", "P12")
def random_sample(spark, d):
    return R.random_sample(Tables(spark, d).lineitem, 0.1, seed=3)


# ------------------------------------------------------------------- joins


@register("join_inner", "J1", sql="""
SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_extendedprice
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def join_inner(spark, d):
    t = Tables(spark, d)
    return (t.orders.select("o_orderkey", "o_custkey")
            .join(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"),
                  F.col("o_orderkey") == F.col("l_orderkey"))
            .drop("l_orderkey"))


@register("join_anti_keys", "J2 U3", sql="""
SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def join_anti_keys(spark, d):
    t = Tables(spark, d)
    pending = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return R.anti_keys(t.customer.select("c_custkey"), pending, ["c_custkey"])


def _cust_part(spark, d):
    t = Tables(spark, d)
    return (t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
            .join(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"),
                  F.col("o_orderkey") == F.col("l_orderkey")))


_CP_SQL = """
cp AS (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, l.l_partkey, l.l_quantity
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
late AS (SELECT * FROM cp WHERE year(o_orderdate) >= 1998),
early AS (SELECT * FROM cp WHERE year(o_orderdate) < 1998)
"""


@register("join_semi_pair", "J3", sql=f"""
WITH {_CP_SQL}
SELECT o_orderkey, o_custkey, l_partkey FROM late
WHERE (o_custkey, l_partkey) IN (SELECT (o_custkey, l_partkey) FROM early)
""")
def join_semi_pair(spark, d):
    cp = _cust_part(spark, d)
    late = cp.where(F.year("o_orderdate") >= 1998)
    early = cp.where(F.year("o_orderdate") < 1998)
    return R.semi_on(late, early, ["o_custkey", "l_partkey"]).select("o_orderkey", "o_custkey", "l_partkey")


@register("join_anti_pair", "J3", sql=f"""
WITH {_CP_SQL}
SELECT o_orderkey, o_custkey, l_partkey FROM late l
WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.o_custkey = l.o_custkey AND e.l_partkey = l.l_partkey)
""")
def join_anti_pair(spark, d):
    cp = _cust_part(spark, d)
    late = cp.where(F.year("o_orderdate") >= 1998)
    early = cp.where(F.year("o_orderdate") < 1998)
    return R.anti_on(late, early, ["o_custkey", "l_partkey"]).select("o_orderkey", "o_custkey", "l_partkey")


@register("join_keyed_pairs", "J4 A1", sql=f"""
WITH {_CP_SQL},
a AS (SELECT o_custkey, l_partkey, sum(l_quantity) AS late_qty FROM late GROUP BY 1, 2),
b AS (SELECT o_custkey, l_partkey, sum(l_quantity) AS early_qty FROM early GROUP BY 1, 2)
SELECT a.o_custkey, a.l_partkey, round(late_qty, 6) AS late_qty, round(early_qty, 6) AS early_qty
FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.l_partkey = b.l_partkey
""")
def join_keyed_pairs(spark, d):
    cp = _cust_part(spark, d)
    keys = ["o_custkey", "l_partkey"]
    a = cp.where(F.year("o_orderdate") >= 1998).groupBy(*keys).agg(F.sum("l_quantity").alias("late_qty"))
    b = cp.where(F.year("o_orderdate") < 1998).groupBy(*keys).agg(F.sum("l_quantity").alias("early_qty"))
    return a.join(b, keys).select(*keys, r6("late_qty").alias("late_qty"), r6("early_qty").alias("early_qty"))


@register("join_lookup", "J5", sql="""
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def join_lookup(spark, d):
    t = Tables(spark, d)
    # Dimension lookups: AQE broadcasts these at runtime when they are small.
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "n_name", "r_name"))


@register("join_left_default", "J6", sql="""
SELECT c.c_custkey, coalesce(a.n_orders, 0) AS n_orders, round(coalesce(a.total, 0.0), 6) AS total
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total
                           FROM orders GROUP BY o_custkey) a ON c.c_custkey = a.o_custkey
""")
def join_left_default(spark, d):
    t = Tables(spark, d)
    agg = (t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total")))
    j = R.left_join_default(t.customer.select("c_custkey"), agg, ["c_custkey"],
                            {"n_orders": 0, "total": 0.0})
    return j.select("c_custkey", "n_orders", r6("total").alias("total"))


# ------------------------------------------------------------- aggregation


@register("agg_count_pairs", "A1 R1", sql="""
SELECT o.o_custkey AS user_id, l.l_partkey AS product, count(*) AS rating
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2
""")
def agg_count_pairs(spark, d):
    cp = _cust_part(spark, d)
    return R.count_by_key(cp.select(F.col("o_custkey").alias("user_id"),
                                    F.col("l_partkey").alias("product")),
                          ["user_id", "product"], "rating")


@register("agg_distinct_having", "A2", sql="""
SELECT l_partkey, count(DISTINCT l_orderkey) AS n_distinct FROM lineitem
GROUP BY l_partkey HAVING count(DISTINCT l_orderkey) >= 35
""")
def agg_distinct_having(spark, d):
    return R.distinct_count_by_key(Tables(spark, d).lineitem, "l_partkey", "l_orderkey", 35)


@register("agg_collect_sorted", "A3", sql="""
SELECT n.n_name, array_to_string(list_sort(list(DISTINCT c.c_mktsegment)), ',') AS segs,
       count(*) AS n_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name
""")
def agg_collect_sorted(spark, d):
    t = Tables(spark, d)
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    segs = R.collect_sorted(j, "n_name", "c_mktsegment").select("n_name", F.array_join("values", ",").alias("segs"))
    return segs.join(j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers")), "n_name")


@register("agg_max_other", "A4", sql="""
SELECT l_orderkey, max(l_partkey) AS max_l_partkey FROM lineitem GROUP BY l_orderkey
""")
def agg_max_other(spark, d):
    return R.max_other_by_key(Tables(spark, d).lineitem, "l_orderkey", "l_partkey")


# "Plays" = line items of a customer's orders, length = extended price
# (returned lines count as zero-length plays), "paid" = urgent orders.
_PLAYS_SQL = """
plays AS (SELECT o.o_custkey AS user_id, l.l_partkey AS song,
                 CASE WHEN l.l_returnflag = 'R' THEN 0.0 ELSE l.l_extendedprice END AS ms,
                 o.o_orderpriority = '1-URGENT' AS paid
          FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
"""


def plays(spark, d):
    cp = Tables(spark, d)
    o, li = cp.orders, cp.lineitem
    return (o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song"),
                    F.when(F.col("l_returnflag") == "R", F.lit(0.0))
                    .otherwise(F.col("l_extendedprice")).alias("ms"),
                    (F.col("o_orderpriority") == "1-URGENT").alias("paid")))


@register("agg_conditional", "A5", sql=f"""
WITH {_PLAYS_SQL}
SELECT user_id, count(*) FILTER (WHERE ms <> 0) AS listen_count,
       count(*) FILTER (WHERE paid) AS paid_count,
       round(sum(ms), 6) AS total_ms, round(coalesce(sum(ms) FILTER (WHERE paid), 0), 6) AS paid_ms
FROM plays GROUP BY user_id
""")
def agg_conditional(spark, d):
    p = plays(spark, d)
    return p.groupBy("user_id").agg(
        F.count(F.when(F.col("ms") != 0, 1)).alias("listen_count"),
        F.count(F.when(F.col("paid"), 1)).alias("paid_count"),
        r6(F.sum("ms")).alias("total_ms"),
        r6(F.coalesce(F.sum(F.when(F.col("paid"), F.col("ms"))), F.lit(0.0))).alias("paid_ms"))


@register("user_listen_stats", "A6 J6 F11", sql=f"""
WITH {_PLAYS_SQL},
a AS (SELECT user_id, count(*) FILTER (WHERE ms <> 0) AS cnt, round(sum(ms), 2) / 1000 / 60 AS minutes,
             count(*) FILTER (WHERE paid) AS paid_count,
             coalesce(round(sum(ms) FILTER (WHERE paid), 2), 0) / 1000 / 60 AS paid_minutes
      FROM plays GROUP BY user_id),
u AS (SELECT c.c_custkey AS user_id, coalesce(cnt, 0) AS cnt, coalesce(minutes, 0.0) AS minutes,
             coalesce(paid_count, 0) AS paid_count, coalesce(paid_minutes, 0.0) AS paid_minutes
      FROM customer c LEFT JOIN a ON c.c_custkey = a.user_id WHERE c.c_acctbal >= 0)
SELECT user_id, cnt, minutes,
       CASE WHEN cnt = 0 THEN 0 ELSE minutes / cnt END AS avg_minutes,
       paid_count, paid_minutes,
       CASE WHEN paid_count = 0 THEN 0 ELSE paid_minutes / paid_count END AS avg_paid_minutes,
       CASE WHEN minutes = 0 THEN NULL ELSE paid_minutes / minutes END AS paid_share
FROM u
""")
def user_listen_stats(spark, d):
    from tessera.operators.stats import user_listen_stats as uls
    # Customers with a negative balance play the role of users without an age: skipped.
    users = Tables(spark, d).customer.where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("user_id"))
    # Sums rounded to cents (the input precision) make the results exact.
    out = uls(users, plays(spark, d), "user_id", "ms", "paid", sum_digits=2)
    return out.select("user_id", "cnt", "minutes", "avg_minutes", "paid_count", "paid_minutes",
                      "avg_paid_minutes", "paid_share")


@register("agg_mean_sum_pivot", "A7", sql="""
SELECT c.c_mktsegment,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 6) AS F_mean,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 6) AS O_mean,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 6) AS P_mean,
       round(sum(o_totalprice), 6) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment
""")
def agg_mean_sum_pivot(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    piv = (j.groupBy("c_mktsegment").pivot("o_orderstatus", ["F", "O", "P"])
           .agg(F.avg("o_totalprice")))
    tot = j.groupBy("c_mktsegment").agg(F.sum("o_totalprice").alias("total"))
    return piv.join(tot, "c_mktsegment").select(
        "c_mktsegment", r6("F").alias("F_mean"), r6("O").alias("O_mean"), r6("P").alias("P_mean"),
        r6("total").alias("total"))


@register("segment_statistics", "A8", sql=f"""
WITH {_PLAYS_SQL}
SELECT c.c_mktsegment AS segment, count(*) AS n, round(sum(ms), 6) AS total_ms,
       round(sum(ms) / count(*) / 1000, 6) AS mean_seconds
FROM plays p JOIN customer c ON p.user_id = c.c_custkey GROUP BY c.c_mktsegment
""")
def segment_statistics(spark, d):
    c = Tables(spark, d).customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    g = plays(spark, d).join(c, "user_id").groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms").alias("total_ms"))
    return g.select("segment", "n", r6("total_ms").alias("total_ms"),
                    r6(F.col("total_ms") / F.col("n") / 1000).alias("mean_seconds"))


@register("song_stats", "A9 F12", sql=f"""
WITH {_PLAYS_SQL},
u AS (SELECT c.c_custkey AS user_id, c.c_mktsegment = 'BUILDING' AS male,
             n.n_name = 'UNITED STATES' AS us,
             CASE WHEN c.c_acctbal < 0 THEN 0 WHEN c.c_acctbal < 1500 THEN 1 WHEN c.c_acctbal < 3000 THEN 2
                  WHEN c.c_acctbal < 4500 THEN 3 WHEN c.c_acctbal < 6000 THEN 4 WHEN c.c_acctbal < 7500 THEN 5
                  WHEN c.c_acctbal < 9000 THEN 6 ELSE 7 END AS age_code
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT song, count(*) AS plays, round(sum(ms), 2) / 1000 / 60 AS minutes,
       coalesce(round(sum(ms) FILTER (WHERE paid), 2), 0) / 1000 / 60 AS paid_minutes,
       round(avg(CASE WHEN paid THEN 1.0 ELSE 0.0 END), 6) AS paid_ratio,
       round(avg(age_code), 6) AS mean_age_code,
       round(avg(CASE WHEN male THEN 1.0 ELSE 0.0 END), 6) AS male_share,
       round(avg(CASE WHEN us THEN 1.0 ELSE 0.0 END), 6) AS us_share
FROM plays p JOIN u ON p.user_id = u.user_id WHERE ms <> 0 GROUP BY song
""")
def song_stats(spark, d):
    from tessera.operators.stats import song_stats as ss
    t = Tables(spark, d)
    edges = [0, 1500, 3000, 4500, 6000, 7500, 9000]
    users = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.col("c_custkey").alias("user_id"),
                     (F.col("c_mktsegment") == "BUILDING").alias("male"),
                     (F.col("n_name") == "UNITED STATES").alias("us"),
                     _age_code(F.col("c_acctbal"), edges).alias("age_code")))
    out = ss(plays(spark, d), users, "song", "user_id", "ms", "paid", sum_digits=2)
    return out.select("song", "plays", "minutes", "paid_minutes",
                      *[r6(c).alias(c) for c in ("paid_ratio", "mean_age_code", "male_share", "us_share")])


def _age_code(x, edges):
    # code k for edges[k-1] <= x < edges[k]; 0 below the first edge, 7 above the last
    expr = F.when(x < edges[0], F.lit(0))
    for k in range(1, len(edges)):
        expr = expr.when(x < edges[k], F.lit(k))
    return expr.otherwise(F.lit(len(edges)))


@register("category_distribution", "A10", sql="""
WITH c AS (SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, count(*) AS n FROM orders GROUP BY 1)
SELECT priority, n, round(n / (SELECT sum(n) FROM c), 4) AS ratio FROM c
""")
def category_distribution(spark, d):
    o = Tables(spark, d).orders.select(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"))
    return R.category_distribution(o, "priority", 4)


@register("share_within_segment", "A11", sql="""
WITH c AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_linestatus, l_returnflag, n, round(n / sum(n) OVER (PARTITION BY l_linestatus), 6) AS share FROM c
""")
def share_within_segment(spark, d):
    s = R.share_within(Tables(spark, d).lineitem, "l_linestatus", "l_returnflag")
    return s.withColumn("share", r6("share"))


@register("positive_rate_by", "A12", sql="""
SELECT l_linestatus, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_pos,
       round(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 6) AS pos_rate
FROM lineitem GROUP BY l_linestatus
""")
def positive_rate_by(spark, d):
    li = Tables(spark, d).lineitem.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return R.positive_rate_by(li, "l_linestatus", "label").withColumn("pos_rate", r6("pos_rate"))


@register("anomaly_rate_by_month", "A13 F7", sql="""
SELECT month(l_shipdate) AS month, round(avg(CASE WHEN l_extendedprice > 80000 THEN 1.0 ELSE 0.0 END), 7) AS rate
FROM lineitem GROUP BY 1
""")
def anomaly_rate_by_month(spark, d):
    li = Tables(spark, d).lineitem
    out = R.rate_by(li, F.month("l_shipdate").alias("month"), F.col("l_extendedprice") > 80000)
    return out.withColumn("rate", F.round("rate", 7))


@register("anomaly_rate_by_weekday", "A13 F7", sql="""
SELECT isodow(l_shipdate) - 1 AS weekday,
       round(avg(CASE WHEN l_extendedprice > 80000 THEN 1.0 ELSE 0.0 END), 7) AS rate
FROM lineitem GROUP BY 1
""")
def anomaly_rate_by_weekday(spark, d):
    li = Tables(spark, d).lineitem
    out = R.rate_by(li, S.weekday_mon0("l_shipdate").alias("weekday"), F.col("l_extendedprice") > 80000)
    return out.withColumn("rate", F.round("rate", 7))


@register("group_mean_by_weekday", "A14", sql="""
SELECT isodow(o_orderdate) - 1 AS weekday, round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY 1
""")
def group_mean_by_weekday(spark, d):
    o = Tables(spark, d).orders
    return o.groupBy(S.weekday_mon0("o_orderdate").alias("weekday")).agg(r6(F.avg("o_totalprice")).alias("avg_price"))


@register("cluster_profile", "A15", sql="""
SELECT label, round(avg(embedding[1] * 100), 4) AS avg_age, round(stddev_samp(embedding[1] * 100), 4) AS sd_age,
       round(avg(embedding[2] * 1000), 4) AS avg_rev, round(stddev_samp(embedding[2] * 1000), 4) AS sd_rev
FROM embeddings GROUP BY label
""")
def cluster_profile(spark, d):
    e = Tables(spark, d).embeddings.select(
        "label", (F.col("embedding")[0].cast("double") * 100).alias("age"),
        (F.col("embedding")[1].cast("double") * 1000).alias("rev"))
    g = R.group_moments(e, ["label"], ["age", "rev"])
    r4 = lambda c: F.round(c, 4)  # noqa: E731  (float32 inputs: 4 places)
    return g.select("label", r4("avg_age").alias("avg_age"), r4("sd_age").alias("sd_age"),
                    r4("avg_rev").alias("avg_rev"), r4("sd_rev").alias("sd_rev"))


@register("baseline_mse", "A16", sql="""
SELECT round(avg(o_totalprice), 6) AS mean, round(var_pop(o_totalprice), 4) AS mse FROM orders
""")
def baseline_mse(spark, d):
    b = R.baseline_mse(Tables(spark, d).orders, "o_totalprice")
    return b.select(r6("mean").alias("mean"), F.round("mse", 4).alias("mse"))


@register("rfm_features", "A17", sql="""
SELECT o_custkey, round(sum(o_totalprice), 6) AS revenue, count(*) AS frequency,
       CASE WHEN count(*) = 1 THEN -300.0
            ELSE round(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) / (count(*) - 1), 6) END AS interval
FROM orders GROUP BY o_custkey
""")
def rfm_features(spark, d):
    r = R.rfm_features(Tables(spark, d).orders, "o_custkey", "o_orderdate", "o_totalprice")
    return r.select("o_custkey", r6("revenue").alias("revenue"), "frequency", r6("interval").alias("interval"))


# ---------------------------------------------------------------- set ops


@register("union_all_years", "U1", sql="""
SELECT o_orderkey, year(o_orderdate) AS yr FROM orders
""")
def union_all_years(spark, d):
    """Every year's orders apart, stacked again."""
    o = Tables(spark, d).orders.select("o_orderkey", F.year("o_orderdate").alias("yr"))
    before, year, after = (o.where(c) for c in ("yr < 1995", "yr = 1995", "yr > 1995"))
    return R.union_all(before, year, after)


@register("distinct_buyers", "U2", sql="""
SELECT DISTINCT o_custkey FROM orders
""")
def distinct_buyers(spark, d):
    return Tables(spark, d).orders.select("o_custkey").distinct()


@register("parts_never_sold", "U3", sql="""
SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity >= 48
""")
def parts_never_sold(spark, d):
    """Parts never sold in bulk (48 pieces or more on a line)."""
    t = Tables(spark, d)
    bulk = t.lineitem.where(F.col("l_quantity") >= 48).select(F.col("l_partkey").alias("p_partkey"))
    return R.difference(t.part.select("p_partkey"), bulk, ["p_partkey"])


# ------------------------------------------------------------ SQL surface


@register("sql_views", "Q1 J2 A4", sql="""
SELECT o.o_custkey, max(l.l_partkey) AS max_part
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
WHERE s.s_suppkey IS NULL
GROUP BY o.o_custkey
""")
def sql_views(spark, d):
    t = Tables(spark, d)
    for name in ("orders", "lineitem", "supplier"):
        t.read(name).createOrReplaceTempView(f"tq_{name}")
    return spark.sql("""
        SELECT o.o_custkey, max(l.l_partkey) AS max_part
        FROM tq_orders o JOIN tq_lineitem l ON o.o_orderkey = l.l_orderkey
        LEFT JOIN (SELECT * FROM tq_supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
        WHERE s.s_suppkey IS NULL
        GROUP BY o.o_custkey ORDER BY o.o_custkey""")


@register("row_functions", "Q2 F2 F6", sql="""
SELECT l_orderkey, l_linenumber,
       round(ln(l_extendedprice), 6) AS log_price,
       round(exp(ln(l_extendedprice)), 4) AS back,
       epoch(l_shipdate) - epoch(o_orderdate) AS ship_seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def row_functions(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber",
                    r6(S.log_transform("l_extendedprice")).alias("log_price"),
                    F.round(S.exp_transform(S.log_transform("l_extendedprice")), 4).alias("back"),
                    S.seconds_between("o_orderdate", "l_shipdate").alias("ship_seconds"))


@register("flat_map_explode", "Q3", sql="""
SELECT o_orderkey, unnest(range(0, CAST(floor(o_totalprice / 100000) AS BIGINT) + 1)) AS slot FROM orders
""")
def flat_map_explode(spark, d):
    o = Tables(spark, d).orders
    n = F.floor(F.col("o_totalprice") / 100000).cast("bigint")
    return o.select("o_orderkey", F.explode(F.sequence(F.lit(0).cast("bigint"), n)).alias("slot"))


@register("value_map", "Q4", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                                        ELSE NULL END AS prio FROM orders
""")
def value_map(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", S.value_map("o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}).alias("prio"))
