"""Market-basket queries: order = l_orderkey, item = brand of the line's part."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import basket
from tessera.plans.catalog import register
from tessera.sources.tables import Tables

MIN_COUNT = 10

_LINES_SQL = """
oi AS (
  SELECT DISTINCT l.l_orderkey AS order_id, p.p_brand AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE p.p_brand IS NOT NULL),
tot AS (SELECT count(DISTINCT order_id) AS n FROM oi),
single AS (
  SELECT item, count(*) AS n_orders FROM oi GROUP BY item HAVING count(*) >= 10),
fo AS (SELECT oi.* FROM oi WHERE item IN (SELECT item FROM single)),
pair AS (
  SELECT a.item AS item_a, b.item AS item_b, count(*) AS n_orders
  FROM fo a JOIN fo b ON a.order_id = b.order_id AND a.item < b.item
  GROUP BY a.item, b.item HAVING count(*) >= 10)
"""


def brand_lines(spark, d):
    t = Tables(spark, d)
    return (t.lineitem.select("l_orderkey", "l_partkey")
            .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")))


@register("basket_sets", "B1", sql="""
SELECT l.l_orderkey AS order_id,
       array_to_string(list_sort(list(DISTINCT p.p_brand)), ',') AS items,
       count(DISTINCT p.p_brand) AS n_items
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY l.l_orderkey
""")
def basket_sets(spark, d):
    b = basket.baskets(brand_lines(spark, d), "l_orderkey", "p_brand")
    return b.select("order_id", F.array_join("items", ",").alias("items"),
                    F.col("n_items").cast("bigint").alias("n_items"))


@register("basket_name_conflicts", "B1", sql="""
SELECT p.p_brand, count(DISTINCT p.p_type) AS n_names
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand HAVING count(DISTINCT p.p_type) > 1
""")
def basket_name_conflicts(spark, d):
    """Brands are no names of one item: almost all carry several part types."""
    t = Tables(spark, d)
    lines = (t.lineitem.select("l_partkey")
             .join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey")))
    return basket.conflicting_names(lines, "p_brand", "p_type")


@register("basket_item_support", "B2", sql=f"""
WITH {_LINES_SQL}
SELECT item, n_orders, round(n_orders / (SELECT n FROM tot), 6) AS support FROM single
""")
def basket_item_support(spark, d):
    s = basket.item_support(brand_lines(spark, d), "l_orderkey", "p_brand", MIN_COUNT)
    return s.select("item", "n_orders", F.round("support", 6).alias("support"))


@register("basket_pairs", "B4", sql=f"""
WITH {_LINES_SQL}
SELECT item_a, item_b, n_orders, round(n_orders / (SELECT n FROM tot), 6) AS support FROM pair
""")
def basket_pairs(spark, d):
    p = basket.frequent_pairs(brand_lines(spark, d), "l_orderkey", "p_brand", MIN_COUNT)
    return p.select("item_a", "item_b", "n_orders", F.round("support", 6).alias("support"))


@register("basket_itemsets_k3", "B3 B4", sql="""
WITH oi AS (
  SELECT DISTINCT l.l_orderkey AS order_id, p.p_brand AS item
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
tot AS (SELECT count(DISTINCT order_id) AS n FROM oi),
s1 AS (SELECT item, count(*) AS c FROM oi GROUP BY item HAVING count(*) >= 40),
fo AS (SELECT * FROM oi WHERE item IN (SELECT item FROM s1)),
s2 AS (SELECT a.item AS i1, b.item AS i2, count(*) AS c
       FROM fo a JOIN fo b ON a.order_id = b.order_id AND a.item < b.item
       GROUP BY 1, 2 HAVING count(*) >= 40),
s3 AS (SELECT a.item AS i1, b.item AS i2, c.item AS i3, count(*) AS c
       FROM fo a JOIN fo b ON a.order_id = b.order_id AND a.item < b.item
                 JOIN fo c ON a.order_id = c.order_id AND b.item < c.item
       GROUP BY 1, 2, 3 HAVING count(*) >= 40),
u AS (SELECT item AS itemset, 1 AS k, c FROM s1
      UNION ALL SELECT i1 || ',' || i2, 2, c FROM s2
      UNION ALL SELECT i1 || ',' || i2 || ',' || i3, 3, c FROM s3)
SELECT itemset, k, c AS n_orders, round(c / (SELECT n FROM tot), 6) AS support FROM u
""")
def basket_itemsets_k3(spark, d):
    # Lower relative threshold (40 orders) with three levels of the search.
    s = basket.frequent_itemsets(brand_lines(spark, d), "l_orderkey", "p_brand", 40, max_k=3)
    return s.select(F.array_join("itemset", ",").alias("itemset"), "k", "n_orders",
                    F.round("support", 6).alias("support"))


@register("basket_rules", "B1 B2 B4 B5", sql=f"""
WITH {_LINES_SQL},
sup AS (SELECT item, n_orders / (SELECT n FROM tot) AS s FROM single),
ps AS (SELECT item_a, item_b, n_orders / (SELECT n FROM tot) AS s FROM pair),
r AS (
  SELECT ps.item_a AS item, ps.item_b AS associate, sa.s AS support, ps.s AS itemset_sup,
         ps.s / sa.s AS confidence, ps.s / (sa.s * sb.s) AS lift
  FROM ps JOIN sup sa ON ps.item_a = sa.item JOIN sup sb ON ps.item_b = sb.item
  UNION ALL
  SELECT ps.item_b, ps.item_a, sb.s, ps.s, ps.s / sb.s, ps.s / (sa.s * sb.s)
  FROM ps JOIN sup sa ON ps.item_a = sa.item JOIN sup sb ON ps.item_b = sb.item)
SELECT item, associate, round(support, 6) AS support, item || '->' || associate AS itemset,
       round(itemset_sup, 6) AS itemset_sup, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift
FROM r
""")
def basket_rules(spark, d):
    # the job stops if one part had two brands
    lines = basket.checked_names(brand_lines(spark, d), "l_partkey", "p_brand")
    r = basket.basket_rules(lines, "l_orderkey", "p_brand", MIN_COUNT)
    return r.select("item", "associate", F.round("support", 6).alias("support"), "itemset",
                    F.round("itemset_sup", 6).alias("itemset_sup"),
                    F.round("confidence", 6).alias("confidence"), F.round("lift", 6).alias("lift"))
