import random

import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tessera.operators.factor_rounds import als_rounds
from tessera.operators.recommend import als_explicit

SCHEMA = "user int, product int, rating float"


def ratings(spark, n, users=60, products=25, seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.randrange(users) - 5, rng.randrange(products) * 8, rng.random()) for _ in range(n)], SCHEMA)


def mllib(train, iterations, reg=0.05):
    return ALS(rank=3, maxIter=iterations, regParam=reg, seed=1, userCol="user", itemCol="product", ratingCol="rating",
               coldStartStrategy="drop").fit(train)


def vectors(factors):
    return {r["id"]: pytest.approx(list(r["features"]), abs=1e-5) for r in factors.collect()}


@pytest.mark.parametrize("iterations, size", [(1, 1 << 21), (7, 20)])
def test_rounds_give_the_factors_of_mllib(spark, iterations, size):
    """Repeated pairs, negative ids, one and several blocks for each core, parts without products."""
    train = ratings(spark, 600)
    got, want = als_rounds(train, 3, 0.05, iterations, 1, block_ratings=size), mllib(train, iterations)
    for name in ("userFactors", "itemFactors"):
        assert {r["id"]: list(r["features"]) for r in getattr(got, name).collect()} == vectors(getattr(want, name))
    assert got.userFactors.schema.simpleString() == want.userFactors.schema.simpleString()
    seen = train.limit(3).union(spark.createDataFrame([(999, 0, 1.0)], SCHEMA))  # the unknown user is dropped
    assert got.transform(seen).count() == 3


def test_rounds_end_when_no_factor_changes(spark):
    """Ratings of one product's mean: the factors fall to zero, and further rounds would repeat that."""
    train = ratings(spark, 300).withColumn("rating", (F.col("rating") * 0.01).cast("float"))
    sc = spark.sparkContext
    sc.setJobGroup("als-rounds", "one fit")
    try:
        model = als_explicit(train, rank=3, reg=0.9, iterations=2000)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("als-rounds") for s in (tracker.getJobInfo(j) or ([], [], []))[1]}
    assert model.itemFactors.where(F.exists("features", lambda x: x != 0)).isEmpty()
    assert len(stages) < 2000  # every round has two


def test_odd_ratings_are_errors(spark):
    one = "SELECT CAST({} AS {}) AS user, 1 AS product, CAST({} AS FLOAT) AS rating"
    for user, kind, rating in (("NULL", "INT", "1"), ("2.5", "DOUBLE", "1"), ("5000000000", "BIGINT", "1"), ("1", "INT", "NULL")):
        with pytest.raises(Exception, match="ALS"):
            als_rounds(spark.sql(one.format(user, kind, rating)), 3, 0.1, 2, 1)
    with pytest.raises(Exception, match="No ratings"):
        als_rounds(ratings(spark, 1).limit(0), 3, 0.1, 2, 1)
