"""Market-basket operators: baskets, item support, level-wise frequent
itemsets and two-item association rules.

Scale notes
-----------
* (order, item) rows are de-duplicated first, so a basket never holds more
  rows than there are distinct items in it, however many lines an order has.
* Infrequent items are removed by a semi-join before any itemset is built
  (downward closure); Catalyst cannot infer that rule by itself.
* Itemsets are grown per order: a frequent (k-1)-set found in an order is
  extended by the order's larger frequent items.  The work is proportional
  to the itemsets really present.  Orders with many frequent items are
  split into slices (``chunk`` items each) on the probe side and the other
  side is replicated per slice, so a hot order is spread over many tasks
  instead of one.
* Counts are aggregated map-side (partial aggregation) before shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

# Orders with more distinct frequent items than this are split into slices.
DEFAULT_CHUNK = 256


def order_items(lines: DataFrame, order_col: str, item_col: str) -> DataFrame:
    """Distinct (order, item) rows with null items removed."""
    return (lines.select(F.col(order_col).alias("order_id"), F.col(item_col).alias("item"))
            .where(F.col("item").isNotNull())
            .distinct())


def checked_names(lines: DataFrame, sku_col: str, name_col: str) -> DataFrame:
    """B1 guard: the lines themselves, or ValueError if one sku has two names."""
    bad = conflicting_names(lines, sku_col, name_col).limit(1).collect()
    if bad:
        raise ValueError(f"item {bad[0][0]!r} has more than one name")
    return lines


def baskets(lines: DataFrame, order_col: str, item_col: str) -> DataFrame:
    """B1: one row per order with its sorted distinct item set.

    The list per order is bounded by the item vocabulary because lines are
    de-duplicated before ``collect_set``.
    """
    oi = order_items(lines, order_col, item_col)
    return (oi.groupBy("order_id")
            .agg(F.sort_array(F.collect_set("item")).alias("items"))
            .withColumn("n_items", F.size("items")))


def conflicting_names(lines: DataFrame, sku_col: str, name_col: str) -> DataFrame:
    """B1 guard: skus that carry more than one name (should be empty)."""
    return (lines.groupBy(sku_col)
            .agg(F.count_distinct(name_col).alias("n_names"))
            .where(F.col("n_names") > 1))


def item_support(lines: DataFrame, order_col: str, item_col: str, min_count: int,
                 n_orders: int | None = None) -> DataFrame:
    """B2: orders per item, kept when >= min_count; support = count / orders."""
    oi = order_items(lines, order_col, item_col)
    if n_orders is None:
        n_orders = oi.select("order_id").distinct().count()
    return (oi.groupBy("item").agg(F.count(F.lit(1)).alias("n_orders"))
            .where(F.col("n_orders") >= min_count)
            .withColumn("support", F.col("n_orders") / F.lit(float(n_orders))))


def _frequent_rows(oi: DataFrame, singles: DataFrame, chunk: int) -> DataFrame:
    """(order_id, item, n_slices): rows of frequent items with the number of
    slices of their order; materialised once, as every level reads them.

    Only orders of more than ``chunk`` items have several slices; they are
    counted by a partial aggregate and joined, so no order is gathered."""
    rows = cut_lineage(oi.join(singles.select("item"), "item", "left_semi").select("order_id", "item"))
    m = F.count(F.lit(1))
    long_orders = (rows.groupBy("order_id").agg(F.ceil(m / F.lit(chunk)).cast("int").alias("_m"))
                   .where(F.col("_m") > 1))
    return cut_lineage(rows.join(long_orders, "order_id", "left")
                       .select("order_id", "item", F.coalesce("_m", F.lit(1)).alias("n_slices")))


def _extend(level: DataFrame, frequent_rows: DataFrame) -> DataFrame:
    """Grow each per-order itemset by one larger frequent item of the same order.

    ``level``: (order_id, n_slices, itemset, last); ``frequent_rows``: (order_id,
    item, n_slices).  The itemsets of an order are dealt to its slices by a
    hash; its items are sent to every slice.
    """
    lv = level.withColumn("slice", F.pmod(F.xxhash64("itemset"), F.col("n_slices")).cast("int"))
    fr = frequent_rows.select("order_id", "item", F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)).alias("slice"))
    joined = lv.join(fr, ["order_id", "slice"]).where(F.col("item") > F.col("last"))
    return joined.select("order_id", "n_slices", F.concat("itemset", F.array("item")).alias("itemset"),
                         F.col("item").alias("last"))


def frequent_itemsets(lines: DataFrame, order_col: str, item_col: str, min_count: int,
                      max_k: int = 2, chunk: int = DEFAULT_CHUNK,
                      n_orders: int | None = None) -> DataFrame:
    """B3 + B4: all itemsets of size 1..max_k present in >= min_count orders.

    Output: (itemset array<item> sorted, k, n_orders, support).  The distinct
    (order, item) rows are made by one shuffle and materialised; singles, the
    number of orders and the frequent rows all come from them.
    """
    oi = cut_lineage(order_items(lines, order_col, item_col))
    if n_orders is None:
        n_orders = oi.select("order_id").distinct().count()
    singles = oi.groupBy("item").agg(F.count(F.lit(1)).alias("n_orders")).where(F.col("n_orders") >= min_count)
    out = singles.select(F.array("item").alias("itemset"), F.lit(1).alias("k"), "n_orders")
    if max_k > 1:
        frequent_rows = _frequent_rows(oi, singles, chunk)
        level = frequent_rows.select("order_id", "n_slices", F.array("item").alias("itemset"), F.col("item").alias("last"))
    for k in range(2, max_k + 1):
        cand = _extend(level, frequent_rows)
        if k < max_k:  # counted and grown: make it once
            cand = cut_lineage(cand)
        counts = (cand.groupBy("itemset").agg(F.count(F.lit(1)).alias("n_orders"))
                  .where(F.col("n_orders") >= min_count))
        out = out.unionByName(counts.select("itemset", F.lit(k).alias("k"), "n_orders"))
        if k < max_k:
            # Keep only frequent k-sets before growing further (downward closure).
            level = cand.join(counts.select("itemset"), "itemset", "left_semi")
    return out.withColumn("support", F.col("n_orders") / F.lit(float(n_orders)))


def frequent_pairs(lines: DataFrame, order_col: str, item_col: str, min_count: int,
                   chunk: int = DEFAULT_CHUNK, n_orders: int | None = None) -> DataFrame:
    """B4 with k=2 in flat form: (item_a < item_b, n_orders, support)."""
    sets = frequent_itemsets(lines, order_col, item_col, min_count, 2, chunk, n_orders)
    return (sets.where(F.col("k") == 2)
            .select(F.col("itemset")[0].alias("item_a"), F.col("itemset")[1].alias("item_b"),
                    "n_orders", "support"))


def pair_rules(pairs: DataFrame, singles: DataFrame) -> DataFrame:
    """Both directed rules of every frequent pair.

    item -> associate: support = sup(item), itemset_sup = sup(pair),
    confidence = sup(pair) / sup(item), lift = sup(pair) / (sup(a) sup(b)).
    ``pairs``: (item_a, item_b, support); ``singles``: (item, support).
    """
    s = singles.select("item", F.col("support").alias("sup"))
    p = (pairs.select("item_a", "item_b", F.col("support").alias("pair_sup"))
         .join(s.withColumnsRenamed({"item": "item_a", "sup": "sup_a"}), "item_a")
         .join(s.withColumnsRenamed({"item": "item_b", "sup": "sup_b"}), "item_b"))
    lift = F.col("pair_sup") / (F.col("sup_a") * F.col("sup_b"))
    way = lambda src, dst, sup: F.struct(F.col(src).alias("item"), F.col(dst).alias("associate"),
                                         F.col(sup).alias("support"))
    # both directions of a pair from one row, so the pairs are made once
    both = p.select("pair_sup", lift.alias("lift"), F.explode(F.array(
        way("item_a", "item_b", "sup_a"), way("item_b", "item_a", "sup_b"))).alias("r"))
    return both.select("r.item", "r.associate", "r.support", F.concat_ws("->", "r.item", "r.associate").alias("itemset"),
                       F.col("pair_sup").alias("itemset_sup"), (F.col("pair_sup") / F.col("r.support")).alias("confidence"),
                       "lift")


def basket_rules(lines: DataFrame, order_col: str, item_col: str, min_count: int,
                 chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """B1 -> B2 -> B4(k=2) -> B5 in one plan."""
    sets = frequent_itemsets(lines, order_col, item_col, min_count, 2, chunk)
    singles = sets.where(F.col("k") == 1).select(F.col("itemset")[0].alias("item"), "support")
    pairs = sets.where(F.col("k") == 2).select(
        F.col("itemset")[0].alias("item_a"), F.col("itemset")[1].alias("item_b"), "support")
    return pair_rules(pairs, singles)
