"""Clustering (K*): k-means with restarts, elbow costs, exact mean
intra-cluster distance (tiled), label agreement, silhouette, filters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.blocks import block_pairs, make_blocks, product


def kmeans_restarts(df: DataFrame, k: int, seeds: list[int], features: str = "features",
                    max_iter: int = 20):
    """K1: fit one model per seed (k-means|| init) and keep the lowest cost."""
    data = df.select(features).cache()
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, featuresCol=features, maxIter=max_iter, initMode="k-means||").fit(data)
        cost = m.summary.trainingCost
        if best is None or cost < best[0]:
            best = (cost, m)
    data.unpersist()
    return best[1]


def kmeans_by_spread(df: DataFrame, k: int, seeds: list[int], id_col: str, vec: str, features: str = "features",
                     max_iter: int = 20):
    """K1 + K3: fit one model per seed and keep the one whose clusters have the
    smallest mean distance of members, averaged over the clusters.
    Returns (model, spread)."""
    data = df.select(id_col, vec, features).cache()
    best = None
    for s in seeds:
        m = KMeans(k=k, seed=s, featuresCol=features, maxIter=max_iter, initMode="k-means||").fit(data)
        spread = cluster_spread(mean_intra_distance(m.transform(data), "prediction", id_col, vec)).first()["spread"]
        if best is None or (spread or 0.0) < best[1]:
            best = (m, spread or 0.0)
    data.unpersist()
    return best


def elbow_costs(df: DataFrame, ks: list[int], features: str = "features", seed: int = 1) -> DataFrame:
    """K2: training cost per k."""
    data = df.select(features).cache()
    rows = [(k, float(KMeans(k=k, seed=seed, featuresCol=features).fit(data).summary.trainingCost)) for k in ks]
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


def _pair_sums(it):
    for pdf in it:
        out = []
        for g, bi, bj, va, vb in zip(pdf.iloc[:, 0], pdf["bi"], pdf["bj"], pdf["vecs_a"], pdf["vecs_b"]):
            A = np.array([np.asarray(v, dtype=float) for v in va])
            B = np.array([np.asarray(v, dtype=float) for v in vb])
            s, n = 0.0, len(A) * (len(A) - 1) // 2 if bi == bj else len(A) * len(B)
            for i in range(0, len(A), 512):
                a, b = A[i:i + 512], B[i:] if bi == bj else B
                d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * product(a, b)
                dist = np.sqrt(np.maximum(d2, 0.0))
                s += float(dist[np.triu_indices(len(a), 1, len(b))].sum() if bi == bj else dist.sum())
            out.append((g, s, n))
        yield pd.DataFrame(out, columns=[pdf.columns[0], "dist_sum", "n_pairs"])


def mean_intra_distance(df: DataFrame, cluster: str, id_col: str, vec_col: str,
                        block_size: int = 512) -> DataFrame:
    """K3: exact mean pairwise Euclidean distance of the members of each
    cluster (pairs of distinct members), computed over block pairs."""
    blocks = make_blocks(df, cluster, id_col, vec_col, block_size)
    pairs = block_pairs(blocks, cluster)
    ct = df.schema[cluster].dataType.simpleString()
    sums = pairs.select(cluster, "bi", "bj", "vecs_a", "vecs_b").mapInPandas(
        _pair_sums, f"{cluster} {ct}, dist_sum double, n_pairs long")
    return (sums.groupBy(cluster).agg(F.sum("dist_sum").alias("dist_sum"), F.sum("n_pairs").alias("n_pairs"))
            .withColumn("mean_distance", F.try_divide("dist_sum", "n_pairs")))


def cluster_spread(distances: DataFrame) -> DataFrame:
    """K3: mean member distance averaged over the clusters (those with a pair)."""
    return distances.where(F.col("n_pairs") > 0).agg(F.avg("mean_distance").alias("spread"),
                                                     F.count(F.lit(1)).alias("n_clusters"))


def rms_intra_distance(df: DataFrame, cluster: str, vec_col: str, dim: int) -> DataFrame:
    """Root mean square distance of member pairs, another measure than the
    mean of K3 but linear: from n, means and variances per dimension,
    sum over pairs of |a - b|^2 = n^2 * (total population variance)."""
    total = sum((F.var_pop(F.get(vec_col, F.lit(i))) for i in range(1, dim)), F.var_pop(F.get(vec_col, F.lit(0))))
    g = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), total.alias("_v"))
    return g.select(cluster, "n", F.sqrt(F.try_divide(2 * F.col("n") * F.col("_v"), F.col("n") - 1)).alias("rms_distance"))


def label_agreement(df: DataFrame, y: str, label: str) -> DataFrame:
    """K4: share of rows where the cluster label equals y."""
    return df.agg(F.avg((F.col(y) == F.col(label)).cast("double")).alias("agreement"))


def silhouette(pred: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    """K5: squared-Euclidean silhouette."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(pred)


def target_cluster_filter(df: DataFrame, prediction: str, clusters: list[int], age: str | None = None) -> DataFrame:
    """K6: rows of the chosen clusters (optionally with a known, non-zero age)."""
    out = df.where(F.col(prediction).isin(clusters))
    return out.where(F.col(age) != 0) if age else out
