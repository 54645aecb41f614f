"""Uniform sharding by a hypergeometric communication matrix.

The rows lie in P source partitions and are to be dealt to blocks of exact
size (a shard is a run of blocks).  In a uniform random permutation the
numbers of rows that go from each partition to each block follow a
multivariate hypergeometric law.  So the matrix of counts is drawn first,
every partition permutes its own rows and deals them by its row of the
matrix, the rows are exchanged, and each block permutes what it received.

The matrix is never held in one place.  It is drawn down a binary tree over
the partitions: a node knows how many rows of each block lie in its range and
draws how many of them fall in its left half, with a seed that only names the
node.  A task walks from the root to its own leaf, so all tasks agree without
talking, a retried task draws the same row, and the driver keeps only one
count per partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, cut_lineage, fresh_name, map_arrow, with_fields

#: monotonically_increasing_id() keeps the partition above these bits.
_ROW_BITS = 33


def block_sizes(n_rows: int, n_shards: int, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, first slot, rows) of every block; shard sizes differ by one at most."""
    shard, first, size = [], [], []
    for s in range(n_shards):
        rows = n_rows // n_shards + (s < n_rows % n_shards)
        parts = max(1, -(-rows // block_rows))
        sizes = rows // parts + (np.arange(parts) < rows % parts)
        shard.append(np.full(parts, s))
        first.append(np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        size.append(sizes)
    return tuple(np.concatenate(x).astype(np.int64) for x in (shard, first, size))


def _draw_large(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """Hypergeometric draw for populations that numpy's sampler refuses (ratio of uniforms)."""
    n = good + bad
    mean = take * good / n
    spread = math.sqrt(mean * (bad / n) * ((n - take) / (n - 1)) + 0.5)
    low, high = max(0, take - bad), min(good, take)

    def log_mass(k: int) -> float:
        return -sum(map(math.lgamma, (k + 1, good - k + 1, take - k + 1, bad - take + k + 1)))

    top = log_mass((take + 1) * (good + 1) // (n + 2))
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    while True:
        x, y = rng.random(), rng.random()
        w = mean + 0.5 + width * (y - 0.5) / x if x else -1.0
        if low <= w < high + 1 and 2 * math.log(x) <= log_mass(int(w)) - top:
            return int(w)


def split_counts(rng: np.random.Generator, colors: np.ndarray, take: int) -> np.ndarray:
    """Draw ``take`` rows without replacement and count them by color.

    A population too large for numpy's sampler is halved by color: how many rows
    come from the first half is one draw, and the halves are then independent.
    So about two draws per 1e9 rows are made here, however many colors there are.
    """
    n = int(colors.sum())
    if n < 1_000_000_000:
        return rng.multivariate_hypergeometric(colors, take, method="marginals")
    if len(colors) == 1:
        return np.array([take], np.int64)
    mid = len(colors) // 2
    first, second = colors[:mid], colors[mid:]
    good = int(first.sum())
    if take in (0, n) or good in (0, n):
        taken = min(good, take)
    else:
        taken = _draw_large(rng, good, n - good, take)
    return np.concatenate([split_counts(rng, first, taken), split_counts(rng, second, take - taken)])


def matrix_row(counts: np.ndarray, sizes: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Rows that source partition ``part`` sends to each block."""
    lo, hi, colors = 0, len(counts), sizes
    total = np.concatenate([[0], np.cumsum(counts)])
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = split_counts(rng, colors, int(total[mid] - total[lo]))
        lo, hi, colors = (lo, mid, left) if part < mid else (mid, hi, colors - left)
    return colors


def shuffle_shards(df: DataFrame, n_shards: int, seed: int = 42, block_rows: int = 1 << 16,
                   shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """Deal all rows uniformly at random to ``n_shards`` shards.

    Adds ``shard`` (int, 0 to n_shards - 1) and ``slot`` (long, gapless from 0
    in every shard).  Shard sizes differ by one at most.  Each row takes part
    by itself: nulls, empty and very long texts, ties and repeated rows are
    all placed; an empty table gives no rows.  Existing columns are kept; a
    column of the name ``shard_col`` or ``slot_col`` (in any case) raises
    ValueError, as a Spark frame can't hold both.

    ``block_rows`` bounds the rows that one exchange group holds; no result
    depends on executors or on retries, as the rows, their partitions and
    their order are fixed by one checkpoint before the first draw.
    """
    if n_shards < 1 or block_rows < 1:
        raise ValueError("n_shards and block_rows must be positive")
    for name in (shard_col, slot_col):
        if fresh_name(df, name) != name:
            raise ValueError(f"the frame already has a column {name}")
    origin = fresh_name(df, "_origin")
    block = fresh_name(df.columns + [origin], "_block")
    order = fresh_name(df.columns + [origin, block], "_order")

    fixed = cut_lineage(df.withColumn(origin, F.monotonically_increasing_id()))
    part = F.shiftright(col(origin), _ROW_BITS)
    # one row per partition, not per record
    found = {r["p"]: r["n"] for r in fixed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(max(found, default=0) + 1, np.int64)
    for p, n in found.items():
        counts[p] = n
    shard_of, first_of, size_of = block_sizes(int(counts.sum()), n_shards, block_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, goes, keys = -1, None, None
        for batch in batches:
            ids = batch.column(origin).to_numpy()
            parts, pos = ids >> _ROW_BITS, ids & ((1 << _ROW_BITS) - 1)
            blocks, orders = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            for p in np.unique(parts).tolist():
                if p != now:  # local permutation of the partition: position -> block
                    row = matrix_row(counts, size_of, p, seed)
                    rng = np.random.default_rng([seed, 1, p])
                    goes = rng.permutation(np.repeat(np.arange(len(row)), row))
                    keys = rng.integers(0, 1 << 62, len(goes))
                    now = p
                mine = parts == p
                blocks[mine], orders[mine] = goes[pos[mine]], keys[pos[mine]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks), pa.array(orders)],
                names=[*batch.schema.names, block, order])

    dealt = map_arrow(fixed, deal, with_fields(fixed.schema, (block, T.LongType()), (order, T.LongType())))
    # the exchange by block, then the second permutation: block_rows rows a group at most
    rank = F.row_number().over(Window.partitionBy(block).orderBy(order, origin)) - 1
    # few numbers a shard turn a block into its shard and slots: blocks are numbered shard by shard
    per_shard = np.bincount(shard_of, minlength=n_shards)
    rows_of = np.bincount(shard_of, weights=size_of, minlength=n_shards).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(per_shard)])
    b = col(block)
    shard, slot = F.lit(0), F.lit(0).cast("long")
    for s in range(n_shards):
        here = (b >= int(starts[s])) & (b < int(starts[s + 1]))
        parts, rows = int(per_shard[s]), int(rows_of[s])
        k = b - int(starts[s])
        first = k * (rows // parts) + F.least(k, F.lit(rows % parts))
        shard = F.when(here, F.lit(s)).otherwise(shard)
        slot = F.when(here, first).otherwise(slot)
    return dealt.select(*[col(c) for c in df.columns], shard.cast("int").alias(shard_col),
                        (slot + rank).cast("long").alias(slot_col))


def shard_report(docs: DataFrame, n_shards: int = 8, seed: int = 42) -> DataFrame:
    """Sizes, checksums and places of all documents; a null text has no bytes and checksum 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
                       F.lit("rows").alias("law"))
    return (shuffle_shards(slim, n_shards, seed)
            .withColumn("grown_shard", F.lit(None).cast("int")))
