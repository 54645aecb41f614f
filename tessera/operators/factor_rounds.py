"""Explicit ALS by rounds over packed ratings, ended when no factor changes.

MLlib's ALS runs every round it is given, two stages each, and reads rating by
rating.  Here the ratings are packed once into blocks of whole users, as arrays
that stay cached.  A round is one pass: a block solves its users from the
products' factors and adds up what these users give to each product's normal
equations; a part of the products sums that over the blocks, solves and sends
the factors back to the blocks that hold the products.  The start, the penalty
(scaled by counts) and the factors' single precision are those of MLlib.  A
round that changes no factor would be repeated exactly by all that follow, so
the rounds end there; the result is that of all rounds.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tessera.session import cut_lineage, scratch_dir

#: Ratings of a block, about; it travels to its task in every round, 12 bytes a rating.
BLOCK_RATINGS = 1 << 21
#: Ratings summed at once, at least; their arrays fit the cache.
CHUNK = 1 << 16
#: Rounds between two looks at whether a factor changed.
LOOK = 5
_CELLS = ("block int, users binary, products binary, ends binary, row binary, col binary, rating binary, start binary")
_SUMS = "part int, block int, ids binary, sums binary, old binary"
_FACTORS = "block int, part int, factors binary, changed boolean"
_OUT = "is_user boolean, id int, features array<float>"


def _array(table: pa.Table, name: str, dtype, i: int = 0) -> np.ndarray:
    return np.frombuffer(table.column(name)[i].as_buffer(), dtype)


def _packed(columns: dict[str, list], like: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [c.split() for c in like.split(", ")]
    plain = lambda v: v.tobytes() if isinstance(v, np.ndarray) else v
    return pa.table({n: pa.array([plain(v) for v in columns[n]], kinds[t]) for n, t in fields})


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    """A part of the products by the mixed bits of the id."""
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % np.uint64(parts)).astype(np.intp)


def _pack(keys: list[int], rank: int):
    """Ratings and first factors of a block's users -> arrays; products ordered by part."""
    def pack(rated: pa.Table, first: pa.Table) -> pa.Table:
        users, row = np.unique(rated.column("user").to_numpy(), return_inverse=True)
        ids, col = np.unique(rated.column("product").to_numpy(), return_inverse=True)
        part = _part(ids, len(keys))
        order = np.argsort(part, kind="stable")
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids))
        by_user = np.argsort(row, kind="stable")
        at = np.argsort(first.column("id").to_numpy(), kind="stable")
        start = first.column("features").combine_chunks().flatten().to_numpy().reshape(-1, rank)[at]
        return _packed({"block": [rated.column("block")[0].as_py()], "users": [users.astype(np.int32)],
                        "products": [ids[order].astype(np.int32)],
                        "ends": [np.bincount(part, minlength=len(keys)).cumsum().astype(np.int64)], "row": [row[by_user].astype(np.int32)],
                        "col": [place[col[by_user]]], "rating": [rated.column("rating").to_numpy()[by_user].astype(np.float32)],
                        "start": [start.astype(np.float32)]}, _CELLS)
    return pack


def _equations(factors: np.ndarray, at: np.ndarray, to: np.ndarray, n: int, rating: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the sums over its ratings: upper triangle of f f', rating f, count."""
    f, step = np.ascontiguousarray(factors.T, np.float64), max(CHUNK, n)
    sums = np.zeros((len(f) * (len(f) + 3) // 2 + 1, n))
    for c in (slice(i, i + step) for i in range(0, len(to), step)):
        t, g = to[c].astype(np.intp), [x[at[c]] for x in f]
        terms = [g[a] * g[b] for a in range(len(f)) for b in range(a, len(f))] + [x * rating[c] for x in g]
        for total, x in zip(sums, [*terms, None]):
            total += np.bincount(t, x, n)
    return sums.T


def _solve(sums: np.ndarray, rank: int, reg: float) -> np.ndarray:
    up = rank * (rank + 1) // 2
    a = np.empty((len(sums), rank, rank))
    i, j = np.triu_indices(rank)
    a[:, i, j] = a[:, j, i] = sums[:, :up]
    a[:, range(rank), range(rank)] += reg * sums[:, -1:]
    return np.linalg.solve(a, sums[:, up:-1, None])[..., 0].astype(np.float32)


def _known(factors: pa.Table, rank: int) -> np.ndarray:
    """Factors of the block's products: the parts' answers follow each other as the products do."""
    order = np.argsort(factors.column("part").to_numpy())
    return np.concatenate([_array(factors, "factors", np.float32, i) for i in order.tolist()]).reshape(-1, rank)


def _users(cells: pa.Table, known: np.ndarray, rank: int, reg: float) -> np.ndarray:
    row, n = _array(cells, "row", np.int32), len(_array(cells, "users", np.int32))
    return _solve(_equations(known, _array(cells, "col", np.int32), row, n, _array(cells, "rating", np.float32)), rank, reg)


def _send(cells: pa.Table, users: np.ndarray, old: np.ndarray, keys: list[int]) -> pa.Table:
    """What the block's users give to the equations of its products, a row for each part."""
    ids, ends = _array(cells, "products", np.int32), _array(cells, "ends", np.int64)
    sums = _equations(users, _array(cells, "row", np.int32), _array(cells, "col", np.int32), len(ids),
                      _array(cells, "rating", np.float32))
    cuts = [slice(a, b) for a, b in zip([0, *ends[:-1]], ends)]
    held = [i for i, c in enumerate(cuts) if c.stop > c.start]
    return _packed({"part": [keys[i] for i in held], "block": [cells.column("block")[0].as_py()] * len(held),
                    **{name: [np.ascontiguousarray(x[cuts[i]]) for i in held]
                       for name, x in (("ids", ids), ("sums", sums), ("old", old))}}, _SUMS)


def _products(rank: int, reg: float):
    """A part's products: sum the blocks' shares in one order, solve, answer each block."""
    width = rank * (rank + 1) // 2 + rank + 1

    def products(sent: pa.Table) -> pa.Table:
        sent = sent.sort_by("block")
        each = [_array(sent, "ids", np.int32, i) for i in range(sent.num_rows)]
        ids, to = np.unique(np.concatenate(each), return_inverse=True)
        sums = np.concatenate([_array(sent, "sums", np.float64, i) for i in range(sent.num_rows)]).reshape(-1, width)
        new = _solve(np.stack([np.bincount(to, s, len(ids)) for s in sums.T], 1), rank, reg)[to]
        old = np.concatenate([_array(sent, "old", np.float32, i) for i in range(sent.num_rows)]).reshape(-1, rank)
        changed = not np.array_equal(new, old)
        n = sent.num_rows
        return _packed({"block": sent.column("block").to_pylist(), "part": [sent.column("part")[0].as_py()] * n,
                        "factors": np.split(new, np.cumsum([len(x) for x in each])[:-1]), "changed": [changed] * n}, _FACTORS)
    return products


def _even_keys(spark: SparkSession, n: int) -> list[int]:
    """Group keys that fall into ``n`` shuffle partitions one by one."""
    found = (spark.range(64 * n).select(F.col("id").cast("int").alias("k"))
             .groupBy(F.pmod(F.hash("k"), F.lit(n)).alias("p")).agg(F.min("k").alias("k")).collect())
    return sorted(r["k"] for r in found)


def _whole(name: str) -> Column:
    """The key as int; a null or a number that is none is an error, as in MLlib."""
    c = F.col(name)
    wrong = c.isNull() | (c != F.floor(c)) | ~c.between(-(2 ** 31), 2 ** 31 - 1)
    return F.when(wrong, F.raise_error(F.concat(F.lit(f"ALS: not a whole number in {name}: "), F.coalesce(c.cast("string"), F.lit("null"))))
                  ).otherwise(c.cast("int")).alias(name)


def als_rounds(train: DataFrame, rank: int, reg: float, iterations: int, seed: int, look: int = LOOK,
               block_ratings: int = BLOCK_RATINGS):
    """The model of MLlib's explicit ALS on (user, product, rating) after ``iterations`` rounds, up to rounding.

    Each pair row counts as a rating.  A null rating or key is an error.
    """
    from pyspark.ml.recommendation import ALS, ALSModel

    spark = train.sparkSession
    start = ALS(rank=rank, maxIter=0, regParam=reg, seed=seed, implicitPrefs=False, userCol="user", itemCol="product",
                ratingCol="rating", coldStartStrategy="drop")
    if iterations < 1:
        return start.fit(train)
    path = scratch_dir(spark, "ratings")
    rating = F.when(F.col("rating").isNull(), F.raise_error(F.lit("ALS: rating is null"))).otherwise(F.col("rating").cast("float"))
    train.select(_whole("user"), _whole("product"), rating.alias("rating")).write.parquet(path)
    rated = spark.read.parquet(path)
    # the first factors of users depend on their ids alone, so MLlib draws them without the ratings
    ids = rated.select("user").distinct().select("user", F.col("user").alias("product"), F.lit(0.0).cast("float").alias("rating"))
    drawn = start.fit(ids)

    cores = spark.sparkContext.defaultParallelism
    n = cores * max(1, math.ceil(rated.count() / (block_ratings * cores)))
    keys = _even_keys(spark, n)

    def block(user: str) -> Column:
        return F.element_at(F.array(*map(F.lit, keys)), (F.pmod(F.xxhash64(user), F.lit(n)) + 1).cast("int")).alias("block")

    cells = (rated.select(block("user"), "user", "product", "rating").repartition(n, "block").groupBy("block")
             .cogroup(drawn.userFactors.select(block("id"), "id", "features").repartition(n, "block").groupBy("block"))
             .applyInArrow(_pack(keys, rank), _CELLS).repartition(n, "block").sortWithinPartitions("block")
             .persist(StorageLevel.MEMORY_AND_DISK))

    def parts(sent: DataFrame) -> DataFrame:
        return sent.repartition(n, "part").groupBy("part").applyInArrow(_products(rank, reg), _FACTORS)

    def first(batches):
        for t in (pa.Table.from_batches([b.slice(i, 1)]) for b in batches for i in range(b.num_rows)):
            old = np.full((len(_array(t, "products", np.int32)), rank), np.nan, np.float32)
            yield from _send(t, _array(t, "start", np.float32).reshape(-1, rank), old, keys).to_batches()

    def again(t: pa.Table, factors: pa.Table) -> pa.Table:
        known = _known(factors, rank)
        return _send(t, _users(t, known, rank, reg), known, keys)

    def last(t: pa.Table, factors: pa.Table) -> pa.Table:
        known = _known(factors, rank)
        users, ids = _array(t, "users", np.int32), _array(t, "products", np.int32)
        vectors = np.concatenate([_users(t, known, rank, reg), known])
        return pa.table({"is_user": np.arange(len(vectors)) < len(users), "id": np.concatenate([users, ids]),
                         "features": pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * rank, pa.int32()),
                                                              pa.array(vectors.ravel()))})

    def meet(factors: DataFrame, step, schema: str) -> DataFrame:
        return cells.groupBy("block").cogroup(factors.repartition(n, "block").groupBy("block")).applyInArrow(step, schema)

    try:
        factors = parts(cells.mapInArrow(first, _SUMS))
        for done in range(1, iterations):
            if done % look == 0:
                factors = cut_lineage(factors)
                if factors.where("changed").isEmpty():
                    break
            factors = parts(meet(factors, again, _SUMS))
        out = scratch_dir(spark, "factors")
        meet(factors, last, _OUT).write.parquet(out)
    finally:
        cells.unpersist()
    made = spark.read.parquet(out)
    to = scratch_dir(spark, "als")
    drawn.save(to)  # MLlib's folder of a model: its parameters, and the two tables of factors
    made.where("is_user").select("id", "features").write.mode("overwrite").parquet(f"{to}/userFactors")
    (made.where("not is_user").groupBy("id").agg(F.first("features").alias("features"))
     .write.mode("overwrite").parquet(f"{to}/itemFactors"))
    return ALSModel.load(to)
