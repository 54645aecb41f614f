"""Unit tests on the hand-worked fixtures (values computed by hand)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import basket, encode, evaluate, ordered, relational, stats, text
from tessera.functions import scalar
from tessera.functions import text as tf

BASKET = {1: [1, 2, 3, 4], 2: [1, 2, 4], 3: [1, 2], 4: [2, 3, 4], 5: [2, 3], 6: [3, 4], 7: [2, 4]}


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(o, str(i)) for o, items in BASKET.items() for i in items]
    rows.append((1, "1"))  # duplicate line must not double count
    return spark.createDataFrame(rows, "order_id int, item string")


def test_item_support(lines):
    s = {r["item"]: (r["n_orders"], r["support"]) for r in basket.item_support(lines, "order_id", "item", 3).collect()}
    assert s == {"1": (3, 3 / 7), "2": (6, 6 / 7), "3": (4, 4 / 7), "4": (5, 5 / 7)}


def test_frequent_itemsets_levels(lines):
    out = basket.frequent_itemsets(lines, "order_id", "item", 3, max_k=3, chunk=2).collect()
    got = {tuple(r["itemset"]): r["n_orders"] for r in out}
    assert got == {("1",): 3, ("2",): 6, ("3",): 4, ("4",): 5,
                   ("1", "2"): 3, ("2", "3"): 3, ("2", "4"): 4, ("3", "4"): 3}


def test_hot_order_slicing_matches_unsliced(lines):
    a = basket.frequent_itemsets(lines, "order_id", "item", 1, max_k=3, chunk=1).collect()
    b = basket.frequent_itemsets(lines, "order_id", "item", 1, max_k=3, chunk=1000).collect()
    norm = lambda rows: sorted((tuple(r["itemset"]), r["n_orders"]) for r in rows)
    assert norm(a) == norm(b)


def test_rule_one_to_two(lines):
    r = basket.basket_rules(lines, "order_id", "item", 3).where("item = '1' AND associate = '2'").first()
    assert r["support"] == pytest.approx(3 / 7)
    assert r["itemset_sup"] == pytest.approx(3 / 7)
    assert r["confidence"] == pytest.approx(1.0)
    assert r["lift"] == pytest.approx(7 / 6)
    assert r["itemset"] == "1->2"


def test_percentile_rank_lists(spark):
    for n, expect in [(1, [0.0]), (2, [0.0, 100.0]), (3, [0.0, 50.0, 100.0]), (5, [0, 25, 50, 75, 100])]:
        df = spark.createDataFrame([(1, i, float(n - i)) for i in range(n)], "user int, item int, score double")
        got = [r["rank_pct"] for r in ordered.percentile_rank(df, "user", "score", "item").orderBy("item").collect()]
        assert got == pytest.approx([float(x) for x in expect])


def test_mean_percentile_rank(spark):
    from tessera.operators.recommend import mean_percentile_rank
    df = spark.createDataFrame([(1, 1, 2.0, 0.9), (1, 2, 1.0, 0.5), (1, 3, 1.0, 0.1)],
                               "user int, product int, rating double, score double")
    assert mean_percentile_rank(df).first()["mpr"] == pytest.approx(37.5)


def test_category_shares(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), ("A",), ("C",), ("C",)], "c string")
    got = {r["c"]: (r["n"], r["ratio"]) for r in relational.category_distribution(df, "c").collect()}
    assert got == {"A": (3, 0.5), "B": (1, 0.1667), "C": (2, 0.3333)}


def test_modified_z(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    med, m = stats.mad(df, "x")
    assert (med, m) == (3.0, 1.0)
    r = stats.modified_z_report(df, df, "x").first()
    assert r["n_flagged"] == 1 and r["recall"] == pytest.approx(0.2)


def test_exact_quantiles_match_interpolation(spark):
    vals = [5.0, 1.0, 9.0, 3.0, 7.0, 2.0]
    df = spark.createDataFrame([("g", v) for v in vals] + [("h", 4.0)], "g string, v double")
    q = {r["g"]: (r["q_0.25"], r["q_0.5"]) for r in ordered.exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()}
    s = sorted(vals)
    assert q["g"][1] == pytest.approx((s[2] + s[3]) / 2)
    assert q["g"][0] == pytest.approx(s[1] + 0.25 * (s[2] - s[1]))
    assert q["h"] == (4.0, 4.0)


def test_dense_index_is_a_permutation(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    idx = ordered.dense_index(df, ["k", "id"], n_partitions=7)
    rows = idx.select("k", "row_idx").collect()
    assert sorted(r["row_idx"] for r in rows) == list(range(1000))
    assert all(r["row_idx"] == r["k"] for r in rows)


def test_two_sentence_vocabulary(spark):
    docs = spark.createDataFrame([(0, "John likes ice cream"), (1, "John hates chocolate, John.")],
                                 "doc_id int, text string").select("doc_id", tf.keras_tokens("text").alias("t"))
    v = {r["word"]: r["id"] for r in text.build_vocabulary(docs, "doc_id", "t").collect()}
    assert v == {"john": 1, "chocolate": 2, "cream": 3, "hates": 4, "ice": 5, "likes": 6}
    assert text.max_length(docs, "t").first()[0] == 4
    ids = {r["doc_id"]: r["ids"] for r in text.texts_to_ids(docs, "doc_id", "t", text.build_vocabulary(docs, "doc_id", "t")).collect()}
    assert ids[1] == [1, 4, 2, 1]
    padded = docs.sparkSession.createDataFrame([([1, 2],)], "ids array<bigint>").select(text.pad_post("ids", 4)).first()[0]
    assert padded == [1, 2, 0, 0]


def test_clean_text(spark):
    df = spark.createDataFrame([("Visit http://x.org <b>The</b> Cat, is  HERE!",)], "t string")
    assert df.select(tf.clean_text("t", ["the", "is"])).first()[0] == "visit cat here"


def test_city_label_codes(spark):
    df = spark.createDataFrame([(c,) for c in ["London", "Berlin", "Berlin", "New York", "London"]], "city string")
    m = encode.label_encoder("city", "code").fit(df)
    assert [int(r["code"]) for r in m.transform(df).collect()] == [1, 0, 0, 2, 1]


def test_age_at_leap_birthday(spark):
    df = spark.createDataFrame([("2000-02-29", "2024-02-28"), ("2000-02-29", "2024-02-29"), (None, "2024-01-01")],
                               "b string, t string")
    assert [r[0] for r in df.select(scalar.age_at("b", "t")).collect()] == [23, 24, 0]


def test_differs_null_rule(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, None), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(scalar.differs("a", "b")).collect()] == [0, 1, 1, 1]


def test_roc_auc_against_spark(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    rows = [(int(i % 3 == 0 or i % 7 == 0), float((i * 37) % 50) / 50) for i in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    _, auc = evaluate.roc_curve(df, "label", "score")
    ref = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw").evaluate(
        df.withColumn("raw", array_to_vector(F.array(-F.col("score"), F.col("score")))).withColumn(
            "label", F.col("label").cast("double")))
    assert auc.first()["auc"] == pytest.approx(ref, abs=1e-9)


def test_two_sided_p_value(spark):
    df = spark.createDataFrame([(1.96,), (0.0,)], "z double")
    from tessera.functions.stats import two_sided_p
    got = [r[0] for r in df.select(two_sided_p(F.col("z"))).collect()]
    assert got[0] == pytest.approx(math.erfc(1.96 / math.sqrt(2)), abs=2e-7)
    assert got[1] == pytest.approx(1.0, abs=2e-7)


def test_undersample_keeps_minority(spark):
    df = spark.range(0, 2000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    out = evaluate.undersample(df, "id", "y", majority=0, keep_frac=0.2)
    assert out.where("y = 1").count() == 200
    assert 250 < out.where("y = 0").count() < 470
