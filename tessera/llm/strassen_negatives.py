"""Hard negatives by exact integer products of anchor and candidate tiles.

Vectors become integers.  Anchors and rows are dealt to a grid of cells of
bounded size by a hash of the row; each cell multiplies its anchors with its
rows tile by tile, by Strassen's recursion on zero-padded int64 blocks.  Every
cell keeps, for each anchor, a heap of its best rows; heaps of equal size merge
by taking the best of both, so Spark merges those of all cells.

Two passes: the first scores rows of the anchor's own label only and yields the
positives; the second scores all rows and fills one heap for each positive's
window of scores.  Strassen only adds, subtracts and multiplies, so its
intermediate values may wrap modulo 2^64 and the result is still exact; a tile
whose result might not fit a long raises OverflowError instead of a wrong score.

The work is the number of anchors times the number of rows, as asked; each row
is sent to one cell for every ``ANCHORS`` anchors and each anchor to one for
every ``ROWS`` rows.  Nothing is broadcast, no heap holds more than its few rows.

Defined results: a null id, label or vector, or a null or non-finite component,
takes no part.  Rows equal in id, label and integer vector count once; rows that
share an id but differ otherwise are rows of their own, and "other" rows are
those of another id.  Equal scores are in order of the smaller id.  Shorter
vectors are padded with zeros.  A positive without a negative gives no row, an
empty table none; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import col, via_table

#: Anchors and rows of a cell on the mean, and of a tile inside it.
ANCHORS, ROWS = 4096, 4096
_TILE = (512, 1024)
#: A side that is not halved any more.
_LEAF = 16
_LOW = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = _LEAF) -> np.ndarray:
    """a @ b over int64 (modulo 2^64); odd sides are padded with zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if (m | k | n) & 1:
        a, b = np.pad(a, ((0, m & 1), (0, k & 1))), np.pad(b, ((0, k & 1), (0, n & 1)))
    h, q, w = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :q], a[:h, q:], a[h:, :q], a[h:, q:]
    b11, b12, b21, b22 = b[:q, :w], b[:q, w:], b[q:, :w], b[q:, w:]
    out = np.empty((2 * h, 2 * w), np.int64)
    c11, c12, c21, c22 = out[:h, :w], out[:h, w:], out[h:, :w], out[h:, w:]
    c11[:] = c22[:] = strassen(a11 + a22, b11 + b22, leaf)
    part = strassen(a21 + a22, b11, leaf)
    c21[:] = part
    c22 -= part
    part = strassen(a11, b12 - b22, leaf)
    c12[:] = part
    c22 += part
    part = strassen(a22, b21 - b11, leaf)
    c11 += part
    c21 += part
    part = strassen(a11 + a12, b22, leaf)
    c11 -= part
    c12 += part
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


class Heaps:
    """The ``size`` best (score, id) of each of n lists, in order; they merge in any grouping."""

    def __init__(self, n: int, size: int):
        self.scores = np.full((n, size), _LOW)
        self.ids = np.zeros((n, size), np.int64)
        self.full = np.zeros((n, size), bool)

    def merge(self, rows: slice, scores: np.ndarray, ids: np.ndarray, full: np.ndarray) -> None:
        size = self.scores.shape[1]
        s = np.concatenate([self.scores[rows], scores], axis=1)
        i = np.concatenate([self.ids[rows], ids], axis=1)
        f = np.concatenate([self.full[rows], full], axis=1)
        # best score first (~s reverses without overflow), then the smaller id, empty places last
        order = np.lexsort((i, ~s, ~f), axis=1)[:, :size]
        for own, merged in ((self.scores, s), (self.ids, i), (self.full, f)):
            own[rows] = np.take_along_axis(merged, order, axis=1)

    def push(self, rows: slice, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores of a tile whose columns are in order of ``ids``."""
        size = min(self.scores.shape[1], scores.shape[1])
        left, free, here = np.where(allowed, scores, _LOW), allowed.copy(), np.arange(len(scores))
        best = np.empty((len(scores), size), np.int64)
        ok = np.empty((len(scores), size), bool)
        for k in range(size):
            best[:, k] = at = left.argmax(1)  # the first maximum has the smallest id
            ok[:, k] = free[here, at]
            left[here, at], free[here, at] = _LOW, False
        # a true score of -2^63 could hide behind forbidden places; the overflow check excludes it
        self.merge(rows, np.take_along_axis(scores, best, axis=1), ids[best], ok)


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of int64, padded with zeros to the longest."""
    lists = vectors.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    starts = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of all rows of a with all rows of b."""
    k = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, k - x.shape[1]))) for x in (a, b))
    size = [max(int(x.max()), -int(x.min())) for x in (a, b)]
    if k * size[0] * size[1] >= 1 << 63:
        raise OverflowError("an inner product may not fit a long")
    return strassen(a, b.T)


def _tiles(m: int, n: int) -> Iterator[tuple[slice, slice]]:
    for i in range(0, m, _TILE[0]):
        for j in range(0, n, _TILE[1]):
            yield slice(i, min(m, i + _TILE[0])), slice(j, min(n, j + _TILE[1]))


def _sides(cell: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Anchors, and rows in order of their ids."""
    anchor = pc.is_valid(cell["anchor"])
    return cell.filter(anchor), cell.filter(pc.invert(anchor)).sort_by("id")


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _positive_heaps(keep: int):
    def of_cell(cell: pa.Table) -> pa.Table:
        """Heaps of the anchors' best rows with their own label, label by label."""
        anchors, rows = _sides(cell)
        out = []
        for label in pc.unique(anchors["label"]).to_pylist():
            a, r = (t.filter(pc.equal(t["label"], label)) for t in (anchors, rows))
            if not len(r):
                continue
            va, vr, ia, ir = _matrix(a["vector"]), _matrix(r["vector"]), _ints(a, "id"), _ints(r, "id")
            heaps = Heaps(len(a), keep)
            for i, j in _tiles(len(a), len(r)):
                heaps.push(i, _product(va[i], vr[j]), ia[i, None] != ir[None, j], ir[j])
            who = np.repeat(_ints(a, "anchor"), keep)[heaps.full.ravel()]
            out.append((who, heaps.ids[heaps.full], heaps.scores[heaps.full]))
        arrays = [np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(3)]
        return pa.table(dict(zip(("anchor", "id", "score"), arrays)))

    return of_cell


def _window_heaps(keep: int):
    def of_cell(cell: pa.Table) -> pa.Table:
        """For each anchor and positive, heaps of the rows of other labels inside the positive's window."""
        anchors, rows = _sides(cell)
        out = []
        if len(anchors) and len(rows):
            va, vr, ir = _matrix(anchors["vector"]), _matrix(rows["vector"]), _ints(rows, "id")
            la, lr = _ints(anchors, "label"), _ints(rows, "label")
            lists = anchors["positives"].combine_chunks()
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            starts = np.cumsum(sizes) - sizes
            for slot in range(int(sizes.max())):
                have = sizes > slot
                # a missing positive has an empty window
                at = np.where(have, starts + slot, 0)
                score = np.where(have, flat.field("score").to_numpy()[at], 0)
                low, high = -(-score // 2), np.where(have, score + (-score // 20), _LOW)
                out.append((Heaps(len(anchors), keep), np.full(len(anchors), slot), at, score, low, high))
            for i, j in _tiles(len(anchors), len(rows)):
                scores = _product(va[i], vr[j])
                other = la[i, None] != lr[None, j]
                for heaps, *_, low, high in out:
                    heaps.push(i, scores, other & (scores >= low[i, None]) & (scores <= high[i, None]), ir[j])
        names = ("anchor", "slot", "anchor_id", "positive_id", "positive_score", "id", "score")
        parts = [[np.zeros(0, np.int64)] for _ in names]
        for heaps, slot, at, score, _, _ in out:
            full = heaps.full.ravel()
            per_anchor = (_ints(anchors, "anchor"), slot, _ints(anchors, "id"), flat.field("id").to_numpy()[at], score)
            for part, values in zip(parts, per_anchor):
                part.append(np.repeat(values, keep)[full])
            parts[5].append(heaps.ids.ravel()[full])
            parts[6].append(heaps.scores.ravel()[full])
        return pa.table({n: np.concatenate(p) for n, p in zip(names, parts)})

    return of_cell


def integer_rows(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int = 256) -> DataFrame:
    """(id, label, vector) of the rows that take part, components floor(scale * x)."""
    v = col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    vector = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return (df.select(col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                      F.when(finite, vector).alias("vector"))
            .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").distinct())


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Every anchor and every row in the cells of its line of the grid."""
    high, wide = -(-n_anchors // ANCHORS) or 1, -(-n_rows // ROWS) or 1
    line = F.pmod(F.xxhash64("id", "vector"), F.lit(high))
    place = F.pmod(F.xxhash64("id", "vector"), F.lit(wide))
    a = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("column"), line.alias("line"), "*")
    r = rows.select(F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("line"), place.alias("column"), "*")
    both = a.unionByName(r, allowMissingColumns=True)
    return both.withColumn("cell", F.col("line") * wide + F.col("column")).drop("line", "column").groupBy("cell")


def hard_negatives(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (id, label, vector).

    Positives are an anchor's best other rows of its label; negatives the best rows of other labels that score
    from half to 95 % of the positive's score.
    """
    rows = via_table(rows, "negatives-rows")
    anchors = via_table(rows.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")
    size = anchors.count(), rows.count()
    best = [F.desc("score"), "id"]
    found = (_cells(anchors, rows, *size).applyInArrow(_positive_heaps(n_positives), "anchor long, id long, score long")
             .withColumn("n", F.row_number().over(Window.partitionBy("anchor").orderBy(*best)))
             .where(F.col("n") <= n_positives))
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("positives"))
    anchors = via_table(anchors.join(lists, "anchor"), "negatives-positives")
    schema = "anchor long, slot long, anchor_id long, positive_id long, positive_score long, id long, score long"
    own = Window.partitionBy("anchor", "slot").orderBy(*best)
    return (_cells(anchors, rows, *size).applyInArrow(_window_heaps(n_negatives), schema)
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every 50th row of ``embeddings``; every 7th row has its label moved by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_rows(embeddings, "vec_id", "embedding", moved), F.col("id") % 50 == 0)
