"""The k best products of every user by inner product, without scoring all pairs.

Products are ordered by norm, longest first, and cut into rounds of a bounded
size.  A round's products travel to the tasks that hold users; inside, they
are split into small blocks of one direction.  No product of a block scores
more than u.c + |u| r (c its centre, r its radius) or |u| times its longest
norm, so a user skips blocks below the own k-th score; and a user whose k-th
score exceeds |u| times the next round's longest norm is finished and leaves.
The result is that of scoring all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import dense_index
from tessera.session import cut_lineage, scratch_dir

#: Bytes of product vectors that travel to every task in one round.
ROUND_BYTES = 32 << 20
#: Products of a block, and users scored together.
BLOCK, TILE = 256, 2048
_NONE = np.iinfo(np.int64).max
_STATE = "user long, vector array<double>, scores array<double>, products array<long>, n_scored long"


def _split(mat: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """Cut ``rows`` at the median of their main direction until ``size`` are left."""
    if len(rows) <= size:
        return [rows]
    x = mat[rows] - mat[rows].mean(0)
    along = x @ np.linalg.eigh(x.T @ x)[1][:, -1]
    order, half = np.argsort(along, kind="stable"), len(rows) // 2
    return _split(mat, rows[order[:half]], size) + _split(mat, rows[order[half:]], size)


def _blocks(ids: np.ndarray, mat: np.ndarray, size: int) -> dict:
    parts = _split(mat, np.arange(len(ids)), size)
    centre = np.stack([mat[p].mean(0) for p in parts])
    return {"ids": [ids[p] for p in parts], "mat": [np.ascontiguousarray(mat[p].T) for p in parts], "centre": centre,
            "radius": np.array([np.linalg.norm(mat[p] - c, axis=1).max() for p, c in zip(parts, centre)]),
            "norm": np.array([np.linalg.norm(mat[p], axis=1).max() for p in parts])}


def _merge(scores, products, rows, found, ids):
    """Keep the best of what ``rows`` hold and of ``found``: higher scores, then smaller products."""
    better = (found >= scores[rows, -1:]).any(1)
    rows, found = rows[better], found[better]
    if len(rows):
        s = np.concatenate([scores[rows], found], 1)
        p = np.concatenate([products[rows], np.broadcast_to(ids, found.shape)], 1)
        best = np.lexsort((p, -s), axis=1)[:, :scores.shape[1]]
        scores[rows], products[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(p, best, 1)


def _search(u: np.ndarray, scores: np.ndarray, products: np.ndarray, blocks: dict) -> np.ndarray:
    """Update the best products of the users ``u``; how many products each was scored against."""
    length = np.linalg.norm(u, axis=1)[:, None]
    bound = np.minimum(u @ blocks["centre"].T + length * blocks["radius"], length * blocks["norm"])
    bound += 1e-9 * length * blocks["norm"]  # rounding
    first, scored = bound.argmax(1), np.zeros(len(u), np.int64)
    for own in (True, False):  # the most promising block first: it raises the k-th score
        for j, ids in enumerate(blocks["ids"]):
            rows = np.flatnonzero((first == j) if own else (first != j) & (bound[:, j] >= scores[:, -1]))
            if len(rows):
                _merge(scores, products, rows, u[rows] @ blocks["mat"][j], ids)
                scored[rows] += len(ids)
    return scored


def _round(shared, k: int, dim: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        for batch in batches:
            for tile in (batch.slice(a, TILE) for a in range(0, batch.num_rows, TILE)):
                n = tile.num_rows
                u = tile.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
                scores, products = np.full((n, k), -np.inf), np.full((n, k), _NONE)
                held = np.diff(tile.column("scores").offsets.to_numpy())
                at = np.arange(k) < held[:, None]
                scores[at] = tile.column("scores").flatten().to_numpy(zero_copy_only=False)
                products[at] = tile.column("products").flatten().to_numpy(zero_copy_only=False)
                scored = tile.column("n_scored").to_numpy() + _search(u, scores, products, blocks)
                at = products != _NONE
                ends = pa.array(np.concatenate([[0], at.sum(1).cumsum()]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [tile.column("user"), tile.column("vector"), pa.ListArray.from_arrays(ends, pa.array(scores[at])),
                     pa.ListArray.from_arrays(ends, pa.array(products[at])), pa.array(scored)],
                    names=["user", "vector", "scores", "products", "n_scored"])
    return step


def _usable(df: DataFrame, key: str, vec: str, name: str) -> DataFrame:
    v = F.col(vec).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = df.where(F.col(key).isNotNull() & F.coalesce(finite & (F.size(v) > 0), F.lit(False)))
    return ok.select(F.col(key).cast("long").alias(name), v.alias("vector"),
                     F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)).alias("norm"))


def top_products(users: DataFrame, items: DataFrame, k: int, user: str = "user", product: str = "product",
                 vec: str = "vector", round_items: int | None = None, block: int = BLOCK) -> DataFrame:
    """(user, rank, product, score, n_scored): the ``k`` products of the highest inner
    product with each user, ties by smaller product; fewer if there are fewer.

    Keys are whole numbers, one row each; vectors have one common length, else
    it is an error.  Rows with a null key or a null, empty or non-finite vector
    take no part.  A user of length zero scores 0 with everything and gets the
    smallest products.  ``n_scored`` counts the products the user was scored
    against.  Only ``round_items`` products (by default those of
    ``ROUND_BYTES``) travel to the tasks at once; users are never shuffled.
    """
    spark = users.sparkSession
    u, v = _usable(users, user, vec, "user"), _usable(items, product, vec, "product")
    empty = spark.createDataFrame([], "user long, rank int, product long, score double, n_scored long")
    widths = [r[0] for r in u.select(F.size("vector")).union(v.select(F.size("vector"))).distinct().limit(2).collect()]
    if not widths or v.isEmpty():
        return empty
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    dim = widths[0]
    size = round_items or max(1, ROUND_BYTES // (8 * (dim + 1)))
    path = scratch_dir(spark, "products")
    placed = dense_index(v, [F.col("norm").desc(), F.col("product").asc()], name="pos")
    (placed.withColumn("round", F.floor(F.col("pos") / size).cast("int")).write.partitionBy("round").parquet(path))
    by_round = spark.read.parquet(path)
    longest = [r["norm"] for r in by_round.groupBy("round").agg(F.max("norm").alias("norm")).orderBy("round").collect()]
    smallest = [r[0] for r in by_round.select("product").orderBy("product").limit(k).collect()]

    out = scratch_dir(spark, "top-products")
    still = u.where(F.col("norm") == 0).select(
        "user", F.array_repeat(F.lit(0.0), len(smallest)).alias("scores"),
        F.array(*map(F.lit, smallest)).cast("array<long>").alias("products"), F.lit(0).cast("long").alias("n_scored"))
    still.write.parquet(out)
    state = u.where(F.col("norm") > 0).select(
        "user", "vector", F.array().cast("array<double>").alias("scores"), F.array().cast("array<long>").alias("products"),
        F.lit(0).cast("long").alias("n_scored"))
    for t in range(len(longest)):
        rows = by_round.where(F.col("round") == t).select("product", "vector").toArrow()
        mat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        shared = spark.sparkContext.broadcast(_blocks(rows.column("product").to_numpy(), mat, block))
        state = state.mapInArrow(_round(shared, k, dim), _STATE)
        done = F.lit(True)
        if t + 1 < len(longest):
            state = cut_lineage(state)
            length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
            done = F.coalesce(F.get("scores", F.lit(k - 1)) > length * (longest[t + 1] * (1 + 1e-9)), F.lit(False))
        state.where(done).select("user", "scores", "products", "n_scored").write.mode("append").parquet(out)
        shared.destroy()
        if t + 1 < len(longest):
            state = state.where(~done)
            if state.isEmpty():
                break
    found = spark.read.parquet(out).select("user", "n_scored", F.posexplode(F.arrays_zip("scores", "products")).alias("i", "p"))
    return found.select("user", (F.col("i") + 1).alias("rank"), F.col("p.products").alias("product"),
                        F.col("p.scores").alias("score"), "n_scored")
