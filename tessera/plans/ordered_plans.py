"""Window, ordering and split queries (W*, T*, M1) on the daily order-value
series per priority and on orders / lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ordered as O
from tessera.operators import timeseries as TS
from tessera.plans.catalog import register
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


_SERIES_SQL = """
series AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS day,
                  round(sum(o_totalprice), 2) AS value
           FROM orders GROUP BY 1, 2)
"""


def daily_series(spark, d):
    """One value per (priority, day): the day's total order value."""
    o = Tables(spark, d).orders
    return TS.daily_series(o, "o_orderpriority", "o_orderdate", "o_totalprice", digits=2)


@register("rolling_mean_std", "W1", sql=f"""
WITH {_SERIES_SQL},
w AS (SELECT series_id, day, value,
             count(value) OVER w4 AS n, avg(value) OVER w4 AS m, stddev_samp(value) OVER w4 AS s
      FROM series WINDOW w4 AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT series_id, day, value, CASE WHEN n = 4 THEN round(m, 6) END AS rolling_mean,
       CASE WHEN n = 4 THEN round(s, 6) END AS rolling_std FROM w
""")
def rolling_mean_std(spark, d):
    r = O.rolling_stats(daily_series(spark, d), "series_id", "day", "value", 4)
    return r.select("series_id", "day", "value", r6("rolling_mean").alias("rolling_mean"),
                    r6("rolling_std").alias("rolling_std"))


@register("rolling_detrend", "W2", sql=f"""
WITH {_SERIES_SQL},
w AS (SELECT series_id, day, value, count(value) OVER w4 AS n, avg(value) OVER w4 AS m
      FROM series WINDOW w4 AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT series_id, day, round(value - m, 6) AS detrended FROM w WHERE n = 4
""")
def rolling_detrend(spark, d):
    r = O.rolling_detrend(daily_series(spark, d), "series_id", "day", "value", 4)
    return r.select("series_id", "day", r6("detrended").alias("detrended"))


@register("lag_difference", "W3", sql=f"""
WITH {_SERIES_SQL}
SELECT series_id, day, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
       round(value - 2 * lag(value, 1) OVER w + lag(value, 2) OVER w, 6) AS diff_2
FROM series WINDOW w AS (PARTITION BY series_id ORDER BY day)
""")
def lag_difference(spark, d):
    r = O.lags_and_diffs(daily_series(spark, d), "series_id", "day", "value", lags=2, d=2)
    return r.select("series_id", "day", "lag_1", "lag_2", r6("diff_2").alias("diff_2"))


@register("percentile_rank_user", "W4", sql="""
WITH s AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item, sum(l.l_quantity) AS score
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)
SELECT user_id, item, round(100.0 * percent_rank() OVER (PARTITION BY user_id ORDER BY score DESC, item), 6) AS rank_pct
FROM s
""")
def percentile_rank_user(spark, d):
    t = Tables(spark, d)
    s = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
         .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item"))
         .agg(F.sum("l_quantity").alias("score")))
    return O.percentile_rank(s, "user_id", "score", "item").select("user_id", "item", r6("rank_pct").alias("rank_pct"))


@register("regular_date_index", "W5 W6", sql=f"""
WITH {_SERIES_SQL}
SELECT series_id, day, row_number() OVER w - 1 AS position,
       CAST(DATE '2010-08-22' + INTERVAL (7 * (row_number() OVER w - 1)) DAY AS DATE) AS period_date
FROM series WINDOW w AS (PARTITION BY series_id ORDER BY day)
""")
def regular_date_index(spark, d):
    r = O.regular_date_index(daily_series(spark, d), "series_id", "day", "2010-08-22", 7)
    return r.select("series_id", "day", F.col("position").cast("bigint").alias("position"), "period_date")


@register("chronological_split", "W7", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, rn <= floor(0.8 * (SELECT count(*) FROM orders)) AS is_train FROM r
""")
def chronological_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return O.chronological_split(o, ["o_orderdate", "o_orderkey"], 0.8).select("o_orderkey", "is_train")


@register("positional_split", "W8 E7", sql="""
SELECT o_orderkey, year(o_orderdate) < 1997 AS is_train FROM orders
""")
def positional_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return O.positional_split(o.where(F.year("o_orderdate") < 1997),
                              o.where(F.year("o_orderdate") >= 1997)).select("o_orderkey", "is_train")


@register("first_n_split", "W8", sql="""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, rn <= 500 AS is_train FROM r
""")
def first_n_split(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return O.first_n_split(o, ["o_orderdate", "o_orderkey"], 500).select("o_orderkey", "is_train")


@register("reverse_order", "W6", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS position FROM orders
""")
def reverse_order(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return O.reverse_order(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "position")


@register("sort_orders", "T1", sql="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey
""")
def sort_orders(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return o.orderBy(F.col("o_orderdate").desc(), "o_orderkey")


@register("top_k_parts", "T2", sql="""
SELECT l_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey
ORDER BY qty DESC, l_partkey LIMIT 10
""")
def top_k_parts(spark, d):
    g = Tables(spark, d).lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    return O.top_k(g, [F.col("qty").desc(), "l_partkey"], 10)


@register("top_k_per_nation", "T2", sql="""
WITH s AS (SELECT c_nationkey, c_custkey, c_acctbal,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank
           FROM customer)
SELECT c_nationkey, c_custkey, c_acctbal, rank FROM s WHERE rank <= 3
""")
def top_k_per_nation(spark, d):
    c = Tables(spark, d).customer.select("c_nationkey", "c_custkey", "c_acctbal")
    r = O.top_k_per_group(c, ["c_nationkey"], [F.col("c_acctbal").desc(), "c_custkey"], 3)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


@register("argmax_first", "T3", sql="""
SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS o_orderkey,
       max(o_totalprice) AS o_totalprice
FROM orders GROUP BY o_custkey
""")
def argmax_first(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return O.argmax_first(o, ["o_custkey"], "o_totalprice", "o_orderkey")


@register("acf_series", "M1", sql=f"""
WITH {_SERIES_SQL},
c AS (SELECT series_id, day, value - avg(value) OVER (PARTITION BY series_id) AS x,
             count(*) OVER (PARTITION BY series_id) AS n FROM series),
l AS (SELECT series_id, x, n, lead(x, 1) OVER w AS x1, lead(x, 2) OVER w AS x2, lead(x, 3) OVER w AS x3,
             lead(x, 4) OVER w AS x4, lead(x, 5) OVER w AS x5
      FROM c WINDOW w AS (PARTITION BY series_id ORDER BY day)),
a AS (SELECT series_id, any_value(n) AS n, sum(x * x) AS c0, sum(x * x1) AS c1, sum(x * x2) AS c2,
             sum(x * x3) AS c3, sum(x * x4) AS c4, sum(x * x5) AS c5 FROM l GROUP BY series_id)
SELECT series_id, k, round(ck / c0, 6) AS acf, round(1.96 / sqrt(n), 6) AS bound
FROM a, (VALUES (1), (2), (3), (4), (5)) v(k),
     LATERAL (SELECT CASE k WHEN 1 THEN c1 WHEN 2 THEN c2 WHEN 3 THEN c3 WHEN 4 THEN c4 ELSE c5 END AS ck)
""")
def acf_series(spark, d):
    a = TS.acf(daily_series(spark, d), "series_id", "day", "value", nlags=5)
    return a.select("series_id", "k", r6("acf").alias("acf"), r6("bound").alias("bound"))
