"""Scalar function queries (F*) and the bid grid (J9, F10, T3, G13 with a
given win-rate curve)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.operators import regress as G
from tessera.plans.catalog import register
from tessera.sources.tables import Tables


def r6(c):
    return F.round(c, 6)


_COORDS_SQL = """
pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 180 AS lng1, CAST(embedding[2] AS DOUBLE) * 90 AS lat1,
               CAST(embedding[3] AS DOUBLE) * 180 AS lng2, CAST(embedding[4] AS DOUBLE) * 90 AS lat2
        FROM embeddings)
"""


def coords(spark, d):
    e = Tables(spark, d).embeddings
    v = F.col("embedding")
    return e.select("vec_id", (v[0].cast("double") * 180).alias("lng1"), (v[1].cast("double") * 90).alias("lat1"),
                    (v[2].cast("double") * 180).alias("lng2"), (v[3].cast("double") * 90).alias("lat2"))


@register("geo_distances", "F3 F4", sql=f"""
WITH {_COORDS_SQL},
g AS (SELECT vec_id, lng1, lat1, lng2, lat2,
             pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lng2 - lng1) / 2), 2) AS a,
             pow(sin((lat2 - lat1) / 2), 2) + cos(lat1) * cos(lat2) * pow(sin((lng2 - lng1) / 2), 2) AS a_raw
      FROM pts)
SELECT vec_id, round(abs(lng2 - lng1) + abs(lat2 - lat1), 6) AS manhattan,
       round(2 * atan2(sqrt(a), sqrt(1 - a)), 6) AS great_circle,
       round(2 * atan2(sqrt(a_raw), sqrt(1 - a_raw)), 6) AS great_circle_raw
FROM g
""")
def geo_distances(spark, d):
    c = coords(spark, d)
    return c.select("vec_id",
                    r6(S.manhattan_distance("lng1", "lat1", "lng2", "lat2")).alias("manhattan"),
                    r6(S.great_circle("lng1", "lat1", "lng2", "lat2")).alias("great_circle"),
                    r6(S.great_circle("lng1", "lat1", "lng2", "lat2", raw=True)).alias("great_circle_raw"))


@register("day_diff", "F5", sql="""
SELECT l.l_orderkey, l.l_linenumber,
       date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS days
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def day_diff(spark, d):
    t = Tables(spark, d)
    j = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("l_orderkey", "l_linenumber", S.day_diff("l_shipdate", "o_orderdate").alias("days"))


@register("calendar_fields", "F7 F8", sql="""
SELECT event_id, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute,
       isodow(ts) - 1 AS weekday, isodow(ts) AS weekday_mon1,
       CASE WHEN isodow(ts) IN (6, 7) THEN 1 ELSE 0 END AS weekend,
       CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       to_timestamp(CAST(floor(epoch(ts)) AS BIGINT))::TIMESTAMP AS back
FROM events
""")
def calendar_fields(spark, d):
    e = Tables(spark, d).events
    f0 = S.calendar_fields("ts", "mon0")
    f1 = S.calendar_fields("ts", "mon1")
    epoch = S.local_to_epoch("ts")
    return e.select("event_id", f0["month"].alias("month"), f0["day"].alias("day"), f0["hour"].alias("hour"),
                    f0["minute"].alias("minute"), f0["weekday"].alias("weekday"),
                    f1["weekday"].alias("weekday_mon1"), f1["weekend"].alias("weekend"),
                    epoch.alias("epoch_s"),
                    S.epoch_to_local(epoch).cast("timestamp_ntz").alias("back"))


@register("age_at", "F9", sql="""
SELECT c.c_custkey,
       year(DATE '2024-02-29') - year(o.first_order) -
       CASE WHEN month(DATE '2024-02-29') * 100 + day(DATE '2024-02-29') < month(o.first_order) * 100 + day(o.first_order)
            THEN 1 ELSE 0 END AS age
FROM customer c JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_order FROM orders GROUP BY 1) o
  ON c.c_custkey = o.o_custkey
""")
def age_at(spark, d):
    t = Tables(spark, d)
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    j = t.customer.join(first, F.col("c_custkey") == F.col("o_custkey"))
    return j.select("c_custkey", S.age_at("first_order", F.lit("2024-02-29")).alias("age"))


@register("bin_to_group", "F12", sql="""
SELECT p_partkey, CASE WHEN p_size <= 25 THEN 'small' ELSE 'large' END AS g2,
       CASE WHEN p_size <= 15 THEN 'S' WHEN p_size <= 35 THEN 'M' ELSE 'L' END AS g3,
       CASE WHEN p_size <= 10 THEN 1 WHEN p_size <= 25 THEN 2 WHEN p_size <= 40 THEN 3 ELSE 4 END AS g4
FROM part
""")
def bin_to_group(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", S.bin_to_group("p_size", [25], ["small", "large"]).alias("g2"),
                    S.bin_to_group("p_size", [15, 35], ["S", "M", "L"]).alias("g3"),
                    S.bin_to_group("p_size", [10, 25, 40], [1, 2, 3, 4]).alias("g4"))


@register("inequality_flag", "F13", sql="""
SELECT l.l_orderkey, l.l_linenumber,
       CAST(coalesce(nullif(c.c_nationkey, 0) <> nullif(s.s_nationkey, 0), TRUE) AS INTEGER) AS diff_location
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def inequality_flag(spark, d):
    t = Tables(spark, d)
    j = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    # Nation 0 stands for "unknown location" here, to exercise the NULL rule.
    return j.select("l_orderkey", "l_linenumber",
                    S.differs(F.nullif("c_nationkey", F.lit(0)), F.nullif("s_nationkey", F.lit(0))).alias("diff_location"))


# Bid grid: context = market segment; win rate given by a fixed curve of the
# bid scaled by the segment's mean discount (stands in for a fitted model).
_BID_SQL = """
ctx AS (SELECT c.c_mktsegment AS context, avg(l.l_discount) AS k
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
grid AS (SELECT context, CAST(cpc AS DOUBLE) AS cpc, CAST(b AS DOUBLE) / 100 AS bid,
                least(1.0, (CAST(b AS DOUBLE) / 100) * (1 + 10 * k) * 2) AS rate
         FROM ctx, (VALUES (0.01), (0.02), (0.10), (0.15), (0.30), (0.70)) c(cpc), range(1, 100) r(b)),
rev AS (SELECT context, cpc, bid, (cpc - bid) * rate * 0.15 AS revenue FROM grid)
"""


@register("optimal_bid_given_rate", "J9 F10 T3 G13", sql=f"""
WITH {_BID_SQL}
SELECT context, cpc, arg_max(bid, (round(revenue, 10), -bid)) AS bid,
       round(max(revenue), 8) AS revenue
FROM rev GROUP BY context, cpc
""")
def optimal_bid_given_rate(spark, d):
    t = Tables(spark, d)
    ctx = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .groupBy(F.col("c_mktsegment").alias("context")).agg(F.avg("l_discount").alias("k")))
    grid = G.bid_grid(ctx, [0.01, 0.02, 0.10, 0.15, 0.30, 0.70])
    grid = grid.withColumn("rate", F.least(F.lit(1.0), F.col("bid") * (1 + 10 * F.col("k")) * 2))
    best = G.optimal_bid(grid, ["context", "cpc"], "rate", revenue_digits=10)
    return best.select("context", "cpc", "bid", F.round("revenue", 8).alias("revenue"))
