"""Feature encoding and scaling (E*).  Every encoder is fitted once on
training rows and re-applied to any frame (scoring data is never re-fitted).
Fitted state is a small driver-side table (categories, moments)."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most values of a column that may become columns of their own.
MAX_VALUES = 2_000


def label_encoder(col: str, out: str | None = None) -> StringIndexer:
    """Sorted distinct values to 0..k-1, unseen values to k."""
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx",
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def inverse_label(col: str, labels: list[str], out: str | None = None) -> IndexToString:
    """Id back to value."""
    return IndexToString(inputCol=col, outputCol=out or f"{col}_value", labels=labels)


def one_hot_vector(col_idx: str, out: str | None = None, drop_last: bool = False) -> OneHotEncoder:
    """E3 (model input): index to sparse 0/1 vector."""
    return OneHotEncoder(inputCols=[col_idx], outputCols=[out or f"{col_idx}_vec"], dropLast=drop_last)


def one_hot_long(df: DataFrame, cols: list[str], keys: list[str], min_count: int = 1) -> DataFrame:
    """E3 / E4 for any number of values: (keys, feature) rows, one for each 1 of
    the matrix.  Values with fewer than ``min_count`` rows have no feature."""
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    cells = df.select(*keys, F.explode(pairs).alias("cell")).where(F.col("cell.v").isNotNull())
    cells = cells.select(*keys, F.concat_ws("_", "cell.c", "cell.v").alias("feature"))
    if min_count <= 1:
        return cells
    kept = cells.groupBy("feature").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
    return cells.join(kept.select("feature"), "feature", "left_semi").select(*keys, "feature")


class OneHotColumns:
    """Explicit 0/1 columns ``<col>_<value>`` for the values with at
    least ``min_count`` training rows.  One column per value is a form for
    few values: more than ``MAX_VALUES`` of a column are an error, and
    ``one_hot_long`` holds any number."""

    def __init__(self, cols: list[str], min_count: int = 1, drop_first: bool = False):
        self.cols, self.min_count, self.drop_first = cols, min_count, drop_first
        self.values: dict[str, list] = {}

    def fit(self, df: DataFrame) -> "OneHotColumns":
        for c in self.cols:
            vals = (df.groupBy(c).count().where((F.col("count") >= self.min_count) & F.col(c).isNotNull())
                    .select(c).orderBy(c).limit(MAX_VALUES + 1).collect())
            if len(vals) > MAX_VALUES:
                raise ValueError(f"{c} has over {MAX_VALUES} values; use one_hot_long")
            v = [r[0] for r in vals]
            self.values[c] = v[1:] if self.drop_first else v
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        new = {f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for c, vs in self.values.items() for v in vs}
        return df.withColumns(new)


class Standardizer:
    """E5: (x - mean) / std with the *population* std, fitted on train.
    A constant column is only centred."""

    def __init__(self, cols: list[str]):
        self.cols = cols
        self.stats: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> "Standardizer":
        aggs = []
        for c in self.cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        self.stats = {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s or 1.0) for c, (m, s) in self.stats.items()})


class MinMaxScaler01:
    """(x - min) / (max - min) fitted on train.  A constant column is
    only shifted; without training values everything is NULL."""

    def __init__(self, cols: list[str]):
        self.cols = cols
        self.stats: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> "MinMaxScaler01":
        row = df.agg(*[e for c in self.cols for e in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"))]).first()
        self.stats = {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(lo)) / F.lit((hi - lo or 1) if lo is not None else None)
                               for c, (lo, hi) in self.stats.items()})


def mean_normalize(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """Rating minus the item's mean over rated cells (missing cells are
    absent rows, so they neither count nor change).  Item means come from a
    grouped aggregate joined back, not a whole-item window."""
    means = ratings.groupBy(item).agg(F.avg(rating).alias("item_mean"))
    return ratings.join(means, item).withColumn("normalized", F.col(rating) - F.col("item_mean"))


def category_embedding(df: DataFrame, cat: str, numeric: list[str], k: int = 2) -> DataFrame:
    """E9 (re-aimed): a k-dimensional vector per category from the PCA of its
    numeric profile (means and standard deviations per category, standardised)."""
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
    prof = df.groupBy(cat).agg(*[F.avg(c).alias(c) for c in numeric], *[F.stddev_pop(c).alias(f"sd_{c}") for c in numeric])
    v = VectorAssembler(inputCols=[*numeric, *[f"sd_{c}" for c in numeric]], outputCol="_raw").transform(prof)
    v = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True).fit(v).transform(v)
    return PCA(k=k, inputCol="_std", outputCol="embedding").fit(v).transform(v).select(cat, "embedding")
