"""Trees on sums by cell: what grids and boosting of ``hist_trees`` do where rows outnumber the cells.

A cell is one combination of bins of all features, numbered by mixed radix.  A
tree that tries every feature needs of its rows only what they weigh and sum
up to in each cell, so tasks add their rows up once and trees grow whole, each
in one task, over the cells that hold rows.  Nothing is rounded or left out:
squared errors follow from the sums, and what does not (absolute errors, the
sum of positive residuals) is summed over all rows in one scan a round.

``radix_of`` says where this holds: at most ``MAX_CODES`` cells, so that a task
or the driver can hold a number for each.  Otherwise ``hist_trees`` goes level
by level over the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import hist_trees as H

#: Cells (times folds) for which a task or the driver holds numbers.
MAX_CODES = 1 << 22
#: Cells whose predictions by all trees are added up at a time.
BLOCK = 1 << 14


@dataclass
class Radix:
    """Cell numbers: the bins of a row as digits, the first feature's leading."""

    sizes: np.ndarray
    n_bins: int

    @property
    def steps(self) -> np.ndarray:
        return np.append(np.cumprod(self.sizes[:0:-1])[::-1], 1).astype(np.int64)

    def __len__(self) -> int:
        return int(np.prod(self.sizes))

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.int64) @ self.steps).astype(np.int32)

    def bins(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.int64)[:, None] // self.steps % self.sizes).astype(np.int16)


def radix_of(binning: H.Binning, rows: int, groups: int = 1) -> Radix | None:
    """The cells, if there are no more than rows, nor more than ``MAX_CODES`` in all groups of rows."""
    sizes = [len(c) + 2 for c in binning.cuts]
    n = float(np.prod(np.array(sizes, float)))
    return Radix(np.array(sizes, np.int64), binning.size) if n <= rows and n * groups <= MAX_CODES else None


def cell_rows(slim: DataFrame, binning: H.Binning, radix: Radix) -> DataFrame:
    """The columns of ``slim`` (see ``hist_trees.slim_rows``) with ``cell`` in place of the features."""
    n = len(slim.columns) - len(binning.cuts)
    names = [*slim.columns[:n], "cell"]
    schema = slim.select(*names[:-1], F.lit(0).alias("cell")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(radix.of(binning.of(batch, n)))], names=names)

    return slim.mapInArrow(run, schema)


def by_cell(rows: DataFrame) -> DataFrame:
    """Stored, the rows of a cell in one place and side by side, so that tasks sum different cells."""
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return H._stored(rows.repartition(n_parts, "cell").sortWithinPartitions("cell"), "cells")


def _spread(df: DataFrame) -> DataFrame:
    """Few input files must not mean few tasks."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


# ---------------------------------------------------------------- grids


def _fold_sums(rows: DataFrame, radix: Radix, folds: list[int], shift: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each fold, then for all other rows: (cells, rows, target sums, their squares), targets less ``shift``."""
    n_targets, size = len(shift), len(radix) * (len(folds) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((1 + 2 * n_targets, size))
        for batch in H._chunks(batches):
            at = group_of(batch, folds) * len(radix) + _numpy(batch, "cell")
            np.add.at(out[0], at, 1.0)
            y = H._columns(batch, "y", np.float64) - shift
            for c in range(n_targets):
                np.add.at(out[1 + c], at, y[:, c])
                np.add.at(out[1 + n_targets + c], at, y[:, c] ** 2)
        some = np.flatnonzero(out[0])
        for i in range(0, len(some), H.CHUNK):
            part = some[i:i + H.CHUNK]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *(pa.array(v[part]) for v in out)], names=names)

    sums = [f"s{i}" for i in range(1 + 2 * n_targets)]
    names = ["at", *sums]
    got = (rows.mapInArrow(run, "at int, " + ", ".join(f"{s} double" for s in sums)).groupBy("at")
           .agg(*[F.sum(s).alias(s) for s in sums]).toArrow())
    at = got.column("at").to_numpy()
    order = np.argsort(at)
    at, v = at[order], np.stack([got.column(s).to_numpy()[order] for s in sums], 1)
    bounds = np.searchsorted(at, np.arange(len(folds) + 2) * len(radix))
    return [((at[a:b] - g * len(radix)).astype(np.int32), v[a:b, 0], v[a:b, 1:1 + n_targets], v[a:b, 1 + n_targets:])
            for g, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]


def group_of(batch: pa.RecordBatch, folds: list[int]) -> np.ndarray:
    """The place of a row's fold among ``folds``; their number for any other fold or none."""
    fold = _numpy(batch, "fold")
    out = np.full(len(fold), len(folds))
    for g, f in enumerate(folds):
        out[fold == f] = g
    return out


def whole_tree(x: np.ndarray, w: np.ndarray, total: np.ndarray, depth: int, spec: H.Spec, n_bins: int) -> H.Trees:
    """A tree from cells with rows, their weights and target sums."""
    if not len(w):
        return H.Trees(1, total.shape[1])
    out = H._subtree(x, w, total / w[:, None], depth, spec, n_bins)
    out.rows[0][0], out.value[0][0] = w.sum(), total.sum(0) / w.sum()
    return out


_SAMPLES = "sample int, cells binary, w binary, y binary"
_GUESSES = "kind int, depth int, tree int, block int, guess binary"


def _samples(table: DataFrame, radix: Radix, wave: dict[int, tuple[int, int]], folds: list[int], n_targets: int) -> DataFrame:
    """Weights and target sums by cell of bootstrap samples (number -> (seed, place of the fold left out))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(wave), 1 + n_targets, len(radix)))
        for batch in H._chunks(batches):
            cell = _numpy(batch, "cell")
            order = np.argsort(cell, kind="stable")
            cell, keys = cell[order], _numpy(batch, "key")[order]
            group, y = group_of(batch, folds)[order], H._columns(batch, "y", np.float64)[order]
            of_group: dict[int, tuple] = {}
            for i, (seed, g) in enumerate(wave.values()):
                if g not in of_group:
                    mine = group != g
                    c = cell[mine]
                    starts = np.flatnonzero(np.diff(c, prepend=-1))
                    of_group[g] = keys[mine], np.ascontiguousarray(y[mine].T), starts, c[starts]
                k, t, starts, cells = of_group[g]
                if not len(k):
                    continue
                w = H._bootstrap(k, seed)
                out[i, 0, cells] += np.add.reduceat(w, starts)
                for j in range(n_targets):
                    out[i, 1 + j, cells] += np.add.reduceat(w * t[j], starts)
        for i, s in enumerate(wave):
            some = np.flatnonzero(out[i, 0])
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), *(pa.array([b], pa.binary()) for b in (
                        some.astype(np.int32).tobytes(), out[i, 0, some].tobytes(), out[i, 1:, some].tobytes()))],
                    names=["sample", "cells", "w", "y"])

    n_parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.mapInArrow(run, _SAMPLES).repartitionById(min(n_parts, len(wave)), F.col("sample"))


def score_grid(slim: DataFrame, binning: H.Binning, radix: Radix, folds: list[int], depths: list[int],
               min_leafs: list[int], sizes: list[int] | None, seed: int, shift: np.ndarray) -> DataFrame:
    """(leaf, depth, n_trees, n, error, sy, syy): sums over held-out rows; ``sy`` and ``syy`` less ``shift``.

    A kind of tree is a leaf size and a fold left out; kinds of one fold share its samples.
    """
    spark, n_targets = slim.sparkSession, len(shift)
    rows = cell_rows(slim if sizes else _spread(slim), binning, radix)
    table = by_cell(rows) if sizes else rows
    parts = _fold_sums(table, radix, folds, shift)
    held = spark.sparkContext.broadcast(parts)

    def guesses(sample: tuple[int, int], codes: np.ndarray, w: np.ndarray, total: np.ndarray, leafs: list[int]):
        """Held-out cells' predictions by the tree of every leaf size."""
        t, g = sample
        told = radix.bins(held.value[g][0])
        x = radix.bins(codes)
        for at in leafs:
            tree = whole_tree(x, w, total, max(depths), H.Spec(min_leafs[at]), radix.n_bins)
            node, above = 0, 0
            for d in sorted(set(depths)):
                node, above = tree.place(0, told, d - above, node), d
                guess = tree.value[0][node]
                for b in range(0, len(guess), BLOCK):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], pa.int32()) for v in (at * len(folds) + g, d, t, b)]
                        + [pa.array([guess[b:b + BLOCK].tobytes()], pa.binary())], names=["kind", "depth", "tree", "block", "guess"])

    def from_folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in batch.column("id").to_pylist():
                at, g = divmod(kind, len(folds))
                w, total = np.zeros(len(radix)), np.zeros((len(radix), n_targets))
                for i, (codes, n, s, _) in enumerate(held.value):
                    if i != g:
                        w[codes] += n
                        total[codes] += s + n[:, None] * shift
                codes = np.flatnonzero(w)
                yield from guesses((0, g), codes, w[codes], total[codes], [at])

    def from_samples(wave: dict[int, tuple[int, int]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list[tuple]] = {}
            for batch in batches:
                for s, *raw in zip(*(c.to_pylist() for c in batch.columns)):
                    found.setdefault(s, []).append(raw)
            while found:
                s, pieces = found.popitem()
                w, total = np.zeros(len(radix)), np.zeros((len(radix), n_targets))
                for codes, n, y in pieces:
                    codes = np.frombuffer(codes, np.int32)
                    w[codes] += np.frombuffer(n)
                    total[codes] += np.frombuffer(y).reshape(n_targets, -1).T
                codes = np.flatnonzero(w)
                yield from guesses((s // len(folds), s % len(folds)), codes, w[codes], total[codes], list(range(len(min_leafs))))
        return run

    if sizes:
        numbers = {t * len(folds) + g: (seed * 1000 + t, g) for t in range(max(sizes)) for g in range(len(folds))}
        each = max(1, H.MAX_CELLS // (len(radix) * (1 + n_targets)))
        waves = [dict(list(numbers.items())[i:i + each]) for i in range(0, len(numbers), each)]
        made = None
        for wave in waves:
            more = _samples(table, radix, wave, folds, n_targets).mapInArrow(from_samples(wave), _GUESSES)
            made = more if made is None else made.unionAll(more)
    else:
        kinds = spark.range(len(min_leafs) * len(folds)).repartitionById(len(min_leafs) * len(folds), F.col("id").cast("int"))
        made = kinds.mapInArrow(from_folds, _GUESSES)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], list[tuple]] = {}
        for batch in batches:
            for kind, d, t, b, raw in zip(*(c.to_pylist() for c in batch.columns)):
                found.setdefault((kind, d, b), []).append((t, raw))
        out = []
        while found:
            (kind, d, b), trees = found.popitem()
            _, n, s, ss = (v[b:b + BLOCK] for v in held.value[kind % len(folds)])
            total = np.zeros_like(s)
            for t, raw in sorted(trees):
                total += np.frombuffer(raw).reshape(total.shape)
                if t + 1 in (sizes or [1]):
                    off = total / (t + 1) - shift
                    error = (ss - 2 * off * s + n[:, None] * off ** 2).sum()
                    out.append((kind // len(folds), d, t + 1, n.sum(), error, s[:, 0].sum(), ss[:, 0].sum()))
        kinds = [pa.int32()] * 3 + [pa.float64()] * 4
        columns = zip(*out) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    names = ["leaf", "depth", "n_trees", "n", "error", "sy", "syy"]
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scored = made.repartition(n_parts, "kind", "depth", "block").mapInArrow(
        score, "leaf int, depth int, n_trees int, n double, error double, sy double, syy double")
    return scored.groupBy("leaf", "depth", "n_trees").agg(*[F.sum(c).alias(c) for c in names[3:]])


# ---------------------------------------------------------------- boosting


_ROUND = "model int, place int, cells binary, sums binary"


def boost(slim: DataFrame, binning: H.Binning, radix: Radix, settings: list[H.BoostSetting], n_trees: int,
          patience: int | None, min_gain: float) -> H.Boosted:
    """``hist_trees.boost`` with one scan and one job a round for all settings."""
    spark = slim.sparkSession
    table = by_cell(cell_rows(_spread(slim), binning, radix))
    first = _train_sums(table, radix)
    codes, w, sums = first
    base = float(sums.sum() / w.sum()) if len(w) else 0.0
    model = H.Boosted(binning, settings, base, [[] for _ in settings], [])
    known = spark.sparkContext.broadcast(first)
    # cells of held-out rows alone are told by the trees, too
    every = np.sort(table.select("cell").distinct().toArrow().column("cell").to_numpy())
    if not len(every):
        return model
    place = np.full(len(radix), -1, np.int32)
    place[every] = np.arange(len(every))
    shape = spark.sparkContext.broadcast((every, place, place[codes]))
    margins = np.full((len(settings), len(every)), base)
    live = list(range(len(settings)))
    best = [(np.inf, 0)] * len(settings)

    for n in range(n_trees + 1):
        wanted, grows = list(live), n < n_trees
        told = spark.sparkContext.broadcast({m: margins[m] for m in wanted})

        def residuals(batches: Iterator[pa.RecordBatch], wanted=wanted, told=told) -> Iterator[pa.RecordBatch]:
            errors = {m: np.zeros(12) for m in wanted}
            scaled = [m for m in wanted if settings[m].eta != 1]
            above = {m: np.zeros(len(shape.value[0])) for m in scaled}
            for batch in H._chunks(batches):
                at, y, hold = shape.value[1][_numpy(batch, "cell")], _numpy(batch, "y0"), _numpy(batch, "hold")
                order = np.argsort(hold, kind="stable")
                split = len(hold) - int(hold.sum())
                at, y = at[order], y[order]
                for m in wanted:
                    r = y - told.value[m][at]
                    errors[m] += _errors(r, split)
                    if m in above:
                        np.add.at(above[m], at[:split], np.maximum(r[:split], 0.0))
            for m in wanted:
                some = np.flatnonzero(above[m]) if m in above else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m], pa.int32()), pa.array([wanted.index(m)], pa.int32()), pa.array([some.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([np.concatenate([errors[m], above[m][some] if m in above else []]).tobytes()], pa.binary())],
                    names=["model", "place", "cells", "sums"])

        def grown(batches: Iterator[pa.RecordBatch], told=told, grows=grows) -> Iterator[pa.RecordBatch]:
            every, _, train = shape.value
            codes, w, sums = known.value
            found: dict[int, list[tuple[bytes, bytes]]] = {}
            for batch in batches:
                for m, _, *raw in zip(*(c.to_pylist() for c in batch.columns)):
                    found.setdefault(m, []).append(raw)
            for m, pieces in found.items():
                s, errors, above = settings[m], np.zeros(12), np.zeros(len(every))
                for some, raw in pieces:
                    v = np.frombuffer(raw)
                    errors += v[:12]
                    above[np.frombuffer(some, np.int32)] += v[12:]
                tree = H.Trees(1, 1)
                values = np.zeros(0)
                if grows:
                    total = sums - w * told.value[m][train] + (s.eta - 1) * above[train]
                    tree = whole_tree(radix.bins(codes), w, total[:, None], s.max_depth, H.Spec(s.min_leaf), radix.n_bins)
                    values = tree.predict(0, radix.bins(every))[:, 0]
                arrays = [errors, values, *(getattr(tree, c)[0] for c in _TREE)]
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)],
                                                 names=["model", "errors", "margins", *_TREE])

        got = (table.mapInArrow(residuals, _ROUND).repartitionById(len(wanted), F.col("place"))
               .mapInArrow(grown, "model int, errors binary, margins binary, " + ", ".join(f"{c} binary" for c in _TREE)).toArrow())
        rows = {r["model"]: r for r in got.to_pylist()}
        for m in wanted:
            loss = model.note(m, n, np.frombuffer(rows[m]["errors"]))
            if loss < best[m][0] * (1 - min_gain):
                best[m] = (loss, n)
            elif patience is not None and n - best[m][1] >= patience:
                live.remove(m)
                model.rounds[m] = model.rounds[m][:best[m][1]]
                continue
            if grows:
                margins[m] += settings[m].learning_rate * np.frombuffer(rows[m]["margins"])
                model.rounds[m].append((_tree_of(rows[m]), 0))
        told.destroy()
        if not live:
            break
    return model


def _errors(r: np.ndarray, split: int) -> np.ndarray:
    """``hist_trees._errors`` of residuals whose held-out rows come last."""
    size, square, held = np.abs(r), r * r, r[split:]
    under = held >= 0
    parts = []
    for a, b in ((size[:split], square[:split]), (size[split:], square[split:]),
                 (size[split:][under], square[split:][under]), (size[split:][~under], square[split:][~under])):
        parts += [len(a), a.sum(), b.sum()]
    return np.array(parts, np.float64)


_TREE = ("feature", "cut", "low", "rows", "gain", "value")


def _tree_of(row: dict) -> H.Trees:
    out = H.Trees(1, 1)
    for c in _TREE:
        own = getattr(out, c)
        own[0] = np.frombuffer(row[c], own[0].dtype).reshape(-1, *own[0].shape[1:])
    return out


def _train_sums(table: DataFrame, radix: Radix) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, rows, target sums) of the rows that are not held out."""
    got = (table.where("NOT hold").groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y0").alias("s"))
           .toArrow())
    cells, n, s = (got.column(c).to_numpy() for c in ("cell", "n", "s"))
    order = np.argsort(cells)
    return cells[order], n[order], s[order]
