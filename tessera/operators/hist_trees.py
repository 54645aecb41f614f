"""Regression and classification trees, forests and boosting on feature histograms.

Features are cut into bins once.  All trees of a call grow together.  Nodes of
many rows are split level by level: tasks add rows up into histograms (rows and
target sums by feature and bin), Spark sums them, and the best split of every
node is picked where its histogram lies.  A node of at most ``SMALL`` rows costs
less than its histograms: its rows are brought together once and the tree below
it is grown there, over cells that hold rows.  The driver sees one slim row per
node.

A tree's shallower versions are its prefixes and a forest's smaller versions
its first trees, so a grid over depth and size costs one forest; folds and
segments are only further trees of the same scan.

Rows with a null target take no part; a null or NaN feature has a bin of its own
below all values.  Ties go to the first feature and its lowest cut.  Leaves hold
the mean target (class shares for one-hot targets, where the gain is Gini's).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ordered import quantiles_of_counts
from tessera.session import cut_lineage, scratch_dir

#: Rounds of boosting between stored predictions; in between those of the last round are kept.
PENDING = 10
#: Segments that ``fit_segments`` accepts, and nodes of all trees that ``grow`` keeps on the driver.
MAX_SEGMENTS = 1000
MAX_NODES = 10_000_000
#: Numbers in the histograms that a task holds at a time; more open nodes take more scans.
MAX_CELLS = 1 << 23
#: A node of at most so many rows gets them into one task.
SMALL = 1 << 16
#: Rows a task turns into numbers at a time, and bytes of rows that a task gets.
CHUNK = 1 << 17
PART_BYTES = 1 << 25


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lookup(table: dict) -> Column | None:
    return F.create_map(*[F.lit(v) for kv in table.items() for v in kv]) if table else None


# ---------------------------------------------------------------- bins


@dataclass
class Binning:
    """Bin 0: null or NaN; else 1 + the number of cuts below the value (a value equal to a cut stays left of it)."""

    features: list[str]
    cuts: list[np.ndarray]

    @property
    def size(self) -> int:
        return 2 + max((len(c) for c in self.cuts), default=0)

    def of(self, batch: pa.RecordBatch, offset: int) -> np.ndarray:
        out = np.empty((batch.num_rows, len(self.cuts)), np.int16)
        for i, cut in enumerate(self.cuts):
            x = batch.column(offset + i).to_numpy(zero_copy_only=False).astype(np.float64)
            out[:, i] = np.where(np.isnan(x), 0, 1 + np.searchsorted(cut, x))
        return out


def fit_bins(df: DataFrame, features: list[str], bins: int = 64) -> Binning:
    """A bin for each value where there are at most ``bins``, else exact quantiles of the rows.

    Values are counted first, so a hot value is one row; only counts are sorted.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("_v"))
                                         for i, c in enumerate(features)])).alias("p")).select("p.f", "p._v")
    counts = cut_lineage(long.where("_v IS NOT NULL AND NOT isnan(_v)").groupBy("f", "_v").agg(F.count(F.lit(1)).alias("_n")))
    kinds = {r["f"]: r["k"] for r in counts.groupBy("f").agg(F.count(F.lit(1)).alias("k")).collect()}
    few = [f for f, k in kinds.items() if k <= bins]
    cuts = [np.zeros(0)] * len(features)
    for f, values in counts.where(F.col("f").isin(few)).groupBy("f").agg(F.collect_list("_v")).collect():
        cuts[f] = np.sort(np.array(values))[:-1]
    if len(few) < len(kinds):
        probs = [round(i / bins, 6) for i in range(1, bins)]
        for f, *q in quantiles_of_counts(counts.where(~F.col("f").isin(few)), probs, ["f"]).collect():
            cuts[f] = np.unique(np.array(q))
    return Binning(list(features), cuts)


def slim_rows(df: DataFrame, binning: Binning, key: Column, targets: list[Column], **extra: Column) -> DataFrame:
    """(key, extra.., y0.., f0..) of the rows whose targets are all there."""
    ys = [f"y{i}" for i in range(len(targets))]
    present = F.lit(True)
    for y in ys:
        present = present & F.col(y).isNotNull() & ~F.isnan(y)
    return df.select(key.cast("long").alias("key"), *[c.alias(n) for n, c in extra.items()],
                     *[t.cast("double").alias(y) for t, y in zip(targets, ys)],
                     *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(binning.features)]).where(present)


def binned_table(slim: DataFrame, binning: Binning) -> DataFrame:
    """The columns of ``slim_rows`` with bins b0.. in place of the features, stored once."""
    head = slim.select(*slim.columns[:len(slim.columns) - len(binning.cuts)]).schema
    schema = T.StructType([*head.fields, *[T.StructField(f"b{i}", T.ShortType()) for i in range(len(binning.cuts))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(head)
        for batch in batches:
            x = binning.of(batch, n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *(pa.array(x[:, i]) for i in range(x.shape[1]))],
                                             names=schema.names)

    # few input files must not mean few tasks in every later scan
    n_parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _stored(slim.repartition(n_parts).mapInArrow(run, schema), "binned")


def _columns(batch: pa.RecordBatch, prefix: str, kind: type) -> np.ndarray:
    names = [n for n in batch.schema.names if n[0] == prefix and n[1:].isdigit()]
    out = np.empty((batch.num_rows, len(names)), kind)
    for i in range(len(names)):
        out[:, i] = batch.column(f"{prefix}{i}").to_numpy(zero_copy_only=False)
    return out


# ---------------------------------------------------------------- trees


class Trees:
    """Trees as arrays by node: node 0 is the root, the children of a split stand side by side, the left one
    (values at most the cut) at an odd number.  ``low`` is the left child, 0 for a leaf."""

    def __init__(self, n: int, n_targets: int):
        self.n_targets = n_targets
        self.feature, self.cut, self.low = ([np.full(1, v, k) for _ in range(n)]
                                            for v, k in ((-1, np.int16), (0, np.int16), (0, np.int32)))
        self.rows, self.gain = ([np.zeros(1) for _ in range(n)] for _ in range(2))
        self.value = [np.zeros((1, n_targets)) for _ in range(n)]

    def __len__(self) -> int:
        return len(self.feature)

    def split(self, tree: int, nodes: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray,
              left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Split nodes of a tree; ``left`` and ``right`` are (rows, target sums..).  Returns the left children."""
        n, size = len(nodes), len(self.feature[tree])
        low = size + 2 * np.arange(n)
        self.feature[tree][nodes], self.cut[tree][nodes], self.gain[tree][nodes] = feature, cut, gain
        self.low[tree][nodes] = low
        parts = np.stack([left, right], 1).reshape(2 * n, -1)
        for of, more in ((self.feature, np.full(2 * n, -1)), (self.cut, np.zeros(2 * n)), (self.low, np.zeros(2 * n)),
                         (self.gain, np.zeros(2 * n)), (self.rows, parts[:, 0]),
                         (self.value, parts[:, 1:] / parts[:, :1])):
            of[tree] = np.concatenate([of[tree], more.astype(of[tree].dtype)])
        return low

    def graft(self, subtrees: pa.Table) -> None:
        """Put the trees of ``_grown`` in the place of the leaves they start from."""
        tree = subtrees.column("tree").to_numpy()
        order = np.argsort(tree, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(tree[order])) + 1):
            if not len(at):
                continue
            t, size = int(tree[at[0]]), len(self.feature[tree[at[0]]])
            more: dict[str, list[np.ndarray]] = {c: [] for c in ("feature", "cut", "low", "gain", "rows", "value")}
            for i in at.tolist():
                root = subtrees.column("node")[i].as_py()
                own = {c: np.frombuffer(subtrees.column(c)[i].as_py(), getattr(self, c)[t].dtype) for c in more}
                own["value"] = own["value"].reshape(-1, self.n_targets)
                own["low"] = np.where(own["low"] > 0, own["low"] + np.int32(size - 1), 0).astype(np.int32)
                for c in ("feature", "cut", "low", "gain"):
                    getattr(self, c)[t][root] = own[c][0]
                for c in more:
                    more[c].append(own[c][1:])
                size += len(own["low"]) - 1
            for c, parts in more.items():
                getattr(self, c)[t] = np.concatenate([getattr(self, c)[t], *parts])

    def place(self, tree: int, x: np.ndarray, depth: int | None = None, start: int | np.ndarray = 0) -> np.ndarray:
        """The node of each row, at most ``depth`` levels below ``start``."""
        node, here = np.zeros(len(x), np.int64) + start, np.arange(len(x))
        feature, cut, low = self.feature[tree], self.cut[tree], self.low[tree]
        steps = 0
        while depth is None or steps < depth:
            f, first = feature[node], low[node]
            if not first.any():
                break
            node = np.where(first == 0, node, first + (x[here, np.maximum(f, 0)] > cut[node]))
            steps += 1
        return node

    def predict(self, tree: int, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        return self.value[tree][self.place(tree, x, depth)]

    def importances(self, trees: list[int], n_features: int) -> np.ndarray:
        """Share of each feature in the gain of the trees' splits."""
        out = np.zeros(n_features)
        for t in trees:
            split = self.low[t] > 0
            np.add.at(out, self.feature[t][split], self.gain[t][split])
        return out / out.sum() if out.sum() else out


@dataclass
class Spec:
    """How a tree grows: fewest rows of a leaf, features tried per node (None: all), its draws, and its rows."""

    min_leaf: int = 1
    max_features: int | None = None
    seed: int = 0
    bootstrap: bool = False
    segment: int | None = None
    without_fold: int | None = None


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 12)])))
#: By the first 16 bits of a number in [0, 1): how many of the sums it reaches at least, and where more bits decide.
_REACHED = np.searchsorted(_POISSON, np.arange(1 << 16) / 2.0**16, "right").astype(np.uint8)
_UNSURE = _REACHED != np.searchsorted(_POISSON, np.arange(1, (1 << 16) + 1) / 2.0**16, "right")


def _bootstrap(keys: np.ndarray, seed: int) -> np.ndarray:
    """How often a row is drawn: Poisson(1) from a hash of its key and the tree's seed."""
    with np.errstate(over="ignore"):
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h += np.uint64(seed + 1) * np.uint64(0xBF58476D1CE4E5B9)
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(by)
    top = (h >> np.uint64(48)).astype(np.uint16)
    out = _REACHED[top].astype(np.float64)
    unsure = np.flatnonzero(_UNSURE[top])
    out[unsure] = np.searchsorted(_POISSON, (h[unsure] >> np.uint64(11)).astype(np.float64) / 2.0**53, "right")
    return out


def _best(hist: np.ndarray, min_leaf: int) -> tuple[int, int, float]:
    """(feature, cut, gain) of a histogram (feature, bin, 1 + targets); feature -1 if no split gains."""
    total = hist[0].sum(0)
    left = np.cumsum(hist, axis=1)[:, :-1]
    right = total - left
    ok = (left[..., 0] >= min_leaf) & (right[..., 0] >= min_leaf) & (left[..., 0] > 0.5) & (right[..., 0] > 0.5)
    if not ok.any():
        return -1, 0, 0.0
    score = ((left[..., 1:] ** 2).sum(-1) / np.maximum(left[..., 0], 1e-300)
             + (right[..., 1:] ** 2).sum(-1) / np.maximum(right[..., 0], 1e-300))
    base = (total[1:] ** 2).sum() / total[0]
    score = np.where(ok, score, -np.inf)
    at = int(score.argmax())
    gain = float(score.flat[at] - base)
    if gain <= 1e-9 * max(1.0, abs(base)):
        return -1, 0, 0.0
    return (*divmod(at, score.shape[1]), gain)


def _drawn(spec: Spec, nodes: np.ndarray, n_features: int) -> np.ndarray | None:
    """The features tried at each node in rising order; None for all."""
    if spec.max_features is None or spec.max_features >= n_features:
        return None
    return np.sort([np.random.default_rng([spec.seed, n]).choice(n_features, spec.max_features, replace=False)
                    for n in nodes.tolist()], axis=1)


def _quantum(w: np.ndarray, y: np.ndarray) -> float:
    """A power of two; sums of weighted targets in whole multiples of it are exact, in whatever order."""
    most = float((w[:, None] * np.abs(y)).sum(0).max(initial=0.0))
    return 2.0 ** (np.ceil(np.log2(most)) - 51) if most > 0 else 1.0


def _splits(x: np.ndarray, w: np.ndarray, y: np.ndarray, slot: np.ndarray, k: int, drawn: np.ndarray | None,
            min_leaf: int, n_bins: int, quantum: float) -> tuple[np.ndarray, ...]:
    """Best split of each of ``k`` nodes (all with rows): feature (-1 if no split gains), cut, gain, totals, left sums.

    Only cells that hold rows are kept.  ``y`` is in whole multiples of ``quantum``, so equal splits tie exactly.
    """
    n_tried = x.shape[1] if drawn is None else drawn.shape[1]
    v = x if drawn is None else np.take_along_axis(x, drawn[slot], 1)
    weights = (w, *(w * y[:, c] for c in range(y.shape[1])))
    if k * n_bins <= 8 * len(v):
        sums = [np.empty((k, n_tried, n_bins)) for _ in weights]
        first = slot * n_bins
        for f in range(n_tried):
            code = first + v[:, f]
            for of, c in zip(sums, weights):
                of[:, f] = np.bincount(code, c, k * n_bins).reshape(k, n_bins)
        sums = [s.ravel() for s in sums]
        names = np.flatnonzero(sums[0] > 0)
        sums = [s[names] for s in sums]
    else:
        code = ((slot[:, None] * n_tried + np.arange(n_tried)) * n_bins + v).ravel()
        names, at = np.unique(code, return_inverse=True)
        sums = [np.bincount(at, np.repeat(c, n_tried), len(names)) for c in weights]
    cells = np.stack(sums, 1).astype(np.int64)
    segment = names // n_bins
    node = segment // n_tried
    upto = np.cumsum(cells, axis=0)
    first = np.searchsorted(segment, np.arange(k * n_tried))
    before = upto[first] - cells[first]
    last = np.append(first[1:], len(names)) - 1
    unit = np.array([1.0] + [quantum] * y.shape[1])
    total = (upto[last] - before)[::n_tried] * unit
    left = (upto - before[segment]) * unit
    right = total[node] - left
    ok = (left[:, 0] >= min_leaf) & (right[:, 0] >= min_leaf) & (left[:, 0] > 0.5) & (right[:, 0] > 0.5)
    score = ((left[:, 1:] ** 2).sum(1) / np.maximum(left[:, 0], 1e-300)
             + (right[:, 1:] ** 2).sum(1) / np.maximum(right[:, 0], 1e-300))
    score = np.where(ok, score, -np.inf)
    best = np.maximum.reduceat(score, first[::n_tried])
    hits = np.flatnonzero(score == best[node])
    at = hits[np.searchsorted(node[hits], np.arange(k))]
    base = (total[:, 1:] ** 2).sum(1) / total[:, 0]
    gain = best - base
    splits = gain > 1e-9 * np.maximum(1.0, np.abs(base))
    feature = segment[at] % n_tried
    if drawn is not None:
        feature = drawn[np.arange(k), feature]
    return (np.where(splits, feature, -1), np.where(splits, names[at] % n_bins, 0), np.where(splits, gain, 0.0),
            total, np.where(splits[:, None], left[at], 0.0))


def _subtree(x: np.ndarray, w: np.ndarray, y: np.ndarray, depth: int, spec: Spec, n_bins: int) -> Trees:
    """The tree below a node, from all its rows; every feature is tried at every node."""
    out = Trees(1, y.shape[1])
    quantum = _quantum(w, y)
    y = np.rint(y / quantum)
    slot, nodes = np.zeros(len(x), np.int64), np.zeros(1, np.int64)
    for level in range(depth):
        feature, cut, gain, total, left = _splits(x, w, y, slot, len(nodes), None, spec.min_leaf, n_bins, quantum)
        splits = feature >= 0
        if not splits.any():
            break
        low = out.split(0, nodes[splits], feature[splits], cut[splits], gain[splits], left[splits], (total - left)[splits])
        kids = np.stack([left, total - left], 1)[splits][..., 0].ravel()
        # a node of fewer rows has no cut with a leaf on either side
        opened = kids >= max(2 * spec.min_leaf, 2)
        number = np.full(2 * len(nodes), -1)
        at = (2 * np.flatnonzero(splits)[:, None] + np.arange(2)).ravel()
        number[at[opened]] = np.arange(opened.sum())
        nodes = (low[:, None] + np.arange(2)).ravel()[opened]
        slot = number[2 * slot + (x[np.arange(len(x)), np.maximum(feature[slot], 0)] > cut[slot])]
        stay = slot >= 0
        x, w, y, slot = x[stay], w[stay], y[stay], slot[stay]
        if not len(nodes):
            break
    return out


#: (arrow batch, bins, wanted trees) -> for each of them: (tree, rows, weights, targets)
Members = Callable[[pa.RecordBatch, np.ndarray, dict], Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``CHUNK`` rows: what a tree costs once a batch is paid less often."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_PARTIAL = "tree int, node int, hist binary"


def _partials(table: DataFrame, trees: Trees, specs: list[Spec], open_nodes: dict[int, np.ndarray], members: Members,
              n_bins: int, sums: Callable | None = None) -> DataFrame:
    """Each task's histograms of the open nodes over the features they try; with ``sums``, also vectors to be
    summed (tree -1)."""
    n_targets = trees.n_targets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        totals: dict[int, np.ndarray] = {}
        tried: dict[int, np.ndarray | None] = {}
        for batch in _chunks(batches):
            x = _columns(batch, "b", np.int16)
            for t, rows, w, y in members(batch, x, open_nodes):
                nodes = open_nodes[t]
                if not len(rows):
                    continue
                if t not in tried:
                    tried[t] = _drawn(specs[t], nodes, x.shape[1])
                slot = np.full(len(trees.feature[t]), -1)
                slot[nodes] = np.arange(len(nodes))
                at = slot[trees.place(t, x[rows])]
                into = at >= 0
                v, at = x[rows[into]], at[into]
                if tried[t] is not None:
                    v = np.take_along_axis(v, tried[t][at], 1)
                code = ((at[:, None] * v.shape[1] + np.arange(v.shape[1])) * n_bins + v).ravel()
                size = len(nodes) * v.shape[1] * n_bins
                parts = [np.bincount(code, np.repeat(c[into], v.shape[1]), size)
                         for c in (w, *(w * y[:, c] for c in range(n_targets)))]
                hist = np.stack(parts, 1).reshape(len(nodes), v.shape[1], n_bins, -1)
                found[t] = found[t] + hist if t in found else hist
            if sums:
                for k, v in sums(batch, x):
                    totals[k] = totals[k] + v if k in totals else v
        rows = [(t, node, h.tobytes()) for t, hists in found.items()
                for node, h in zip(open_nodes[t].tolist(), hists) if h[..., 0].any()]
        rows += [(-1, k, v.tobytes()) for k, v in totals.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (
                pa.int32(), pa.int32(), pa.binary()))], names=["tree", "node", "hist"])

    return table.mapInArrow(run, _PARTIAL)


def _split_schema(n_targets: int) -> T.StructType:
    """One row per node; ``vector`` holds what ``sums`` gave (tree -1)."""
    ints = [T.StructField(c, T.IntegerType()) for c in ("tree", "node", "feature", "cut")]
    more = ["gain"] + [f"{p}{c}" for p in "tl" for c in range(1 + n_targets)]
    return T.StructType([*ints, *[T.StructField(c, T.DoubleType()) for c in more], T.StructField("vector", T.BinaryType())])


def _split_rows(out: list[tuple], n_targets: int) -> pa.RecordBatch:
    kinds = [pa.int32()] * 4 + [pa.float64()] * (1 + 2 * (1 + n_targets)) + [pa.binary()]
    columns = zip(*out) if out else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=_split_schema(n_targets).names)


def _merged(parts: DataFrame, specs: list[Spec], n_features: int, n_bins: int, n_targets: int, n_parts: int) -> DataFrame:
    """Sum the histograms by node and pick the best split of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for t, node, raw in zip(*(c.to_pylist() for c in batch.columns)):
                v = np.frombuffer(raw)
                whole[t, node] = whole[t, node] + v if (t, node) in whole else v
        out, none = [], [0.0] * (1 + n_targets)
        for (t, node), v in whole.items():
            if t < 0:
                out.append((t, node, -1, 0, 0.0, *none, *none, v.tobytes()))
                continue
            hist = v.reshape(-1, n_bins, 1 + n_targets)
            feature, cut, gain = _best(hist, specs[t].min_leaf)
            left = hist[feature, :cut + 1].sum(0).tolist() if feature >= 0 else none
            tried = _drawn(specs[t], np.array([node]), n_features)
            if feature >= 0 and tried is not None:
                feature = int(tried[0, feature])
            out.append((t, node, feature, cut, gain, *hist[0].sum(0).tolist(), *left, None))
        yield _split_rows(out, n_targets)

    return parts.repartition(n_parts, "tree", "node").mapInArrow(run, _split_schema(n_targets))


def _waves(open_nodes: dict[int, np.ndarray], cells: dict[int, int]) -> Iterator[dict[int, np.ndarray]]:
    """The open nodes in shares whose histograms have at most ``MAX_CELLS`` cells (one node at least)."""
    wave, left = {}, MAX_CELLS
    for t, nodes in open_nodes.items():
        while len(nodes):
            fit = left // cells[t]
            if not fit and wave:
                yield wave
                wave, left = {}, MAX_CELLS
                continue
            wave[t], nodes = nodes[:max(1, fit)], nodes[max(1, fit):]
            left -= cells[t] * len(wave[t])
    if wave:
        yield wave


# ---- rows of small nodes, each brought together once


_PIECES = "tree int, node int, x binary, w binary, y binary"


def _pieces(table: DataFrame, trees: Trees, nodes: dict[int, np.ndarray], members: Members, kind: type) -> DataFrame:
    """The rows of ``nodes`` as bytes, a piece for each node and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            x = _columns(batch, "b", np.int16)
            for t, rows, w, y in members(batch, x, nodes):
                wanted = np.zeros(len(trees.feature[t]), bool)
                wanted[nodes[t]] = True
                node = trees.place(t, x[rows])
                into = np.flatnonzero(wanted[node])
                into = into[np.argsort(node[into], kind="stable")]
                if not len(into):
                    continue
                ids, starts = np.unique(node[into], return_index=True)
                parts = [(t, int(n), x[rows[i]].astype(kind).tobytes(), w[i].astype(np.uint8).tobytes(),
                          np.ascontiguousarray(y[i], np.float64).tobytes())
                         for n, i in zip(ids, np.split(into, starts[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*parts), (
                    pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["tree", "node", "x", "w", "y"])

    return table.mapInArrow(run, _PIECES)


def _joined(pieces: DataFrame, n_parts: int) -> DataFrame:
    """One row per node with all its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[tuple]] = {}
        for batch in batches:
            for t, node, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                found.setdefault((t, node), []).append(parts)
        while found:
            (t, node), parts = found.popitem()
            whole = [b"".join(p) for p in zip(*parts)]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([node], pa.int32()),
                                              *(pa.array([b], pa.binary()) for b in whole)], names=["tree", "node", "x", "w", "y"])

    return pieces.repartition(n_parts, "tree", "node").mapInArrow(run, _PIECES)


def _rows_of(batch: pa.RecordBatch, n_targets: int, kind: type) -> Iterator[tuple]:
    for i in range(batch.num_rows):
        t, node, x, w, y = (c[i].as_py() for c in batch.columns)
        w = np.frombuffer(w, np.uint8).astype(np.float64)
        yield t, node, np.frombuffer(x, kind).reshape(len(w), -1).astype(np.int16), w, np.frombuffer(y).reshape(-1, n_targets)


_SUBTREES = "tree int, node int, feature binary, cut binary, low binary, gain binary, rows binary, value binary"


def _grown(joined: DataFrame, specs: list[Spec], left: dict[tuple[int, int], int], n_targets: int, n_bins: int,
           kind: type) -> DataFrame:
    """The tree below each node; ``left``: how many levels it may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, node, x, w, y in _rows_of(batch, n_targets, kind):
                s = _subtree(x, w, y, left[t, node], specs[t], n_bins)
                arrays = [getattr(s, c)[0].tobytes() for c in ("feature", "cut", "low", "gain", "rows", "value")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([node], pa.int32()), *(pa.array([a], pa.binary()) for a in arrays)],
                    names=["tree", "node", "feature", "cut", "low", "gain", "rows", "value"])

    return joined.mapInArrow(run, _SUBTREES)


def _level_splits(joined: DataFrame, trees: Trees, specs: list[Spec], open_nodes: dict[int, np.ndarray], n_bins: int,
                  kind: type) -> DataFrame:
    """Best splits of the open nodes, each of which has all its rows in one row of ``joined``."""
    n_targets = trees.n_targets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, root, x, w, y in _rows_of(batch, n_targets, kind):
                if t not in open_nodes:
                    continue
                number = np.full(len(trees.feature[t]), -1)
                number[open_nodes[t]] = np.arange(len(open_nodes[t]))
                at = number[trees.place(t, x, start=root)]
                into = at >= 0
                if not into.any():
                    continue
                quantum = _quantum(w, y)
                some, slot = np.unique(at[into], return_inverse=True)
                nodes = open_nodes[t][some]
                feature, cut, gain, total, left = _splits(
                    x[into], w[into], np.rint(y[into] / quantum), slot, len(nodes), _drawn(specs[t], nodes, x.shape[1]),
                    specs[t].min_leaf, n_bins, quantum)
                columns = [np.full(len(nodes), t), nodes, feature, cut, gain, *total.T, *left.T, [None] * len(nodes)]
                schema = _split_schema(n_targets)
                kinds = [pa.int32()] * 4 + [pa.float64()] * (len(columns) - 5) + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    return joined.mapInArrow(run, _split_schema(n_targets))


def grow(table: DataFrame, specs: list[Spec], depths: list[int], members: Members, n_bins: int, n_targets: int,
         sums: Callable | None = None) -> tuple[Trees, dict[int, list[float]]]:
    """All trees, and the vectors that ``sums`` gave, summed over all rows.

    Nodes of many rows are split level by level from histograms.  A node of at most ``SMALL`` rows has its rows
    brought together once: a tree that tries all features is finished there; one that draws them goes on level by
    level, as a node's number seeds its draw.  The trees stay on the driver: at most ``MAX_NODES`` nodes in all,
    else ValueError.
    """
    trees = Trees(len(specs), n_targets)
    n_features = sum(c[0] == "b" and c[1:].isdigit() for c in table.columns)
    most = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draws = [s.max_features is not None and s.max_features < n_features for s in specs]
    cells = {t: (s.max_features if draws[t] else n_features) * n_bins * (1 + n_targets) for t, s in enumerate(specs)}
    totals: dict[int, list[float]] = {}

    def split(found: pa.Table, level_of: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Apply the splits; for each tree its new nodes that may split and their rows."""
        names = found.column_names
        tree, node, feature, cut, gain = (found.column(c).to_numpy() for c in names[:5])
        total, left = (np.stack([found.column(f"{p}{c}").to_numpy() for c in range(1 + n_targets)], 1) for p in "tl")
        for i in np.flatnonzero(tree < 0):
            totals[int(node[i])] = np.frombuffer(found.column("vector")[int(i)].as_py()).tolist()
        opened = {}
        order = np.lexsort((node, tree))
        for at in np.split(order, np.flatnonzero(np.diff(tree[order])) + 1):
            if not len(at) or tree[at[0]] < 0:
                continue
            t = int(tree[at[0]])
            if node[at[0]] == 0:
                trees.rows[t][0], trees.value[t][0] = total[at[0], 0], total[at[0], 1:] / total[at[0], 0]
            at = at[feature[at] >= 0] if level_of[t] < depths[t] else at[:0]
            if not len(at):
                continue
            low = trees.split(t, node[at], feature[at], cut[at], gain[at], left[at], total[at] - left[at])
            kids = (low[:, None] + np.arange(2)).ravel()
            rows = np.stack([left[at, 0], total[at, 0] - left[at, 0]], 1).ravel()
            may = rows >= max(2 * specs[t].min_leaf, 2)
            if level_of[t] + 1 < depths[t] and may.any():
                opened[t] = kids[may], rows[may]
        if sum(map(len, trees.feature)) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: fewer trees or larger leaves")
        return opened

    open_nodes = {t: np.zeros(1, np.int64) for t in range(len(specs))}
    small: dict[int, list[np.ndarray]] = {}
    levels_left: dict[tuple[int, int], int] = {}
    level_of: dict[int, int] = {}
    n_rows, level = 0.0, 0
    while open_nodes:
        found = []
        for wave in _waves(open_nodes, cells):
            parts = _partials(table, trees, specs, wave, members, n_bins, sums if not level and not found else None)
            groups = sum(map(len, wave.values()))  # one key each; no more tasks than keys
            found.append(_merged(parts, specs, n_features, n_bins, n_targets, min(most, groups)).toArrow())
        opened, open_nodes = split(pa.concat_tables(found), dict.fromkeys(open_nodes, level)), {}
        level += 1
        for t, (nodes, rows) in opened.items():
            few = rows <= SMALL
            if depths[t] - level < 2 or draws[t] and not few.all():
                few = np.zeros(len(rows), bool)  # the last level needs sums only; a drawing tree stays in step
            if few.any():
                small.setdefault(t, []).append(nodes[few])
                levels_left |= {(t, n): depths[t] - level for n in nodes[few].tolist()}
                level_of[t] = level
                n_rows += float(rows[few].sum())
            if not few.all():
                open_nodes[t] = nodes[~few]

    kind = np.uint8 if n_bins <= 256 else np.int16
    row_bytes = n_features * np.dtype(kind).itemsize + 1 + 8 * n_targets
    for wanted in (False, True):
        nodes = {t: np.concatenate(n) for t, n in small.items() if draws[t] is wanted}
        if not nodes:
            continue
        n_parts = min(max(most, int(n_rows * row_bytes / PART_BYTES) + 1), sum(map(len, nodes.values())))
        joined = _joined(_pieces(table, trees, nodes, members, kind), n_parts)
        if not wanted:
            got = _grown(joined, specs, levels_left, n_targets, n_bins, kind).toArrow()
            trees.graft(got)
            if sum(map(len, trees.feature)) > MAX_NODES:
                raise ValueError(f"more than {MAX_NODES} nodes: fewer trees or larger leaves")
            continue
        joined = _stored(joined, "rows-by-node")
        open_nodes = nodes
        while open_nodes:
            found = _level_splits(joined, trees, specs, open_nodes, n_bins, kind).toArrow()
            opened = split(found, level_of)
            open_nodes = {t: n for t, (n, _) in opened.items()}
            for t in open_nodes:
                level_of[t] += 1
    return trees, totals


# ---------------------------------------------------------------- forests


def _forest_members(specs: list[Spec]) -> Members:
    def members(batch: pa.RecordBatch, x: np.ndarray, wanted: dict):
        y = _columns(batch, "y", np.float64)
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        names = batch.schema.names
        segment = batch.column("segment").to_numpy(zero_copy_only=False) if "segment" in names else None
        fold = batch.column("fold").to_numpy(zero_copy_only=False) if "fold" in names else None
        of_segment: dict[int | None, np.ndarray] = {}
        for t in wanted:
            s = specs[t]
            if s.segment not in of_segment:
                of_segment[s.segment] = np.arange(len(x)) if s.segment is None else np.flatnonzero(segment == s.segment)
            rows = of_segment[s.segment]
            if s.without_fold is not None:
                rows = rows[fold[rows] != s.without_fold]
            w = _bootstrap(keys[rows], s.seed) if s.bootstrap else np.ones(len(rows))
            drawn = w > 0
            yield t, rows[drawn], w[drawn], y[rows[drawn]]

    return members


@dataclass
class Forest:
    """Trees grown together, with the bins they were grown on; ``segments`` maps a value to its number."""

    binning: Binning
    trees: Trees
    specs: list[Spec]
    classes: list | None = None
    segment_col: str | None = None
    segments: dict = field(default_factory=dict)

    def importances(self) -> list[float]:
        return self.trees.importances(list(range(len(self.specs))), len(self.binning.features)).tolist()

    def transform(self, df: DataFrame, out: str = "prediction", share: str = "share") -> DataFrame:
        """Add the mean of the trees (of the row's segment; null for an unknown one), or for classes the one
        with the largest mean share (the first if equal) and that share."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        keep = df.columns
        schema = df.schema
        number = F.try_element_at(_lookup(self.segments), F.col(self.segment_col)) if self.segments else F.lit(0)
        given = df.select("*", number.cast("int").alias("_segment"),
                          *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(self.binning.features)])
        kind = T.DoubleType() if self.classes is None else T.IntegerType()
        schema = T.StructType([*schema.fields, T.StructField(out, kind)]
                              + ([T.StructField(share, T.DoubleType())] if self.classes else []))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: Forest = shared.value
            for batch in batches:
                x = own.binning.of(batch, len(keep) + 1)
                segment = batch.column(len(keep)).to_numpy(zero_copy_only=False).astype(np.float64)
                total = np.zeros((len(x), own.trees.n_targets))
                n = np.zeros(len(x))
                for t, s in enumerate(own.specs):
                    rows = np.flatnonzero(segment == (s.segment or 0)) if own.segments else np.arange(len(x))
                    total[rows] += own.trees.predict(t, x[rows])
                    n[rows] += 1
                mean = total / np.maximum(n, 1)[:, None]
                if own.classes is None:
                    more = [pa.array(mean[:, 0], mask=n == 0)]
                else:
                    best = mean.argmax(1)
                    more = [pa.array(best.astype(np.int32) + 1, mask=n == 0),
                            pa.array(mean[np.arange(len(x)), best], mask=n == 0)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *more], names=schema.names)

        scored = given.mapInArrow(run, schema)
        if self.classes is None:
            return scored
        return scored.withColumn(out, F.get(F.array(*[F.lit(c) for c in self.classes]), F.col(out) - 1))


def _targets(df: DataFrame, label: str, classes: list | None) -> list[Column]:
    if classes is None:
        return [F.col(label)]
    return [F.when(F.col(label).isNotNull(), (F.col(label) == F.lit(c)).cast("double")) for c in classes]


def fit_forest(df: DataFrame, features: list[str], label: str, key: str, n_trees: int = 10, max_depth: int = 6,
               min_leaf: int = 1, max_features: int | None = None, classes: list | None = None, seed: int = 1,
               bins: int = 64, bootstrap: bool = True) -> Forest:
    """Trees on rows drawn by a hash of ``key``; for ``classes`` (their list), of any number, by Gini."""
    binning = fit_bins(df, features, bins)
    targets = _targets(df, label, classes)
    table = binned_table(slim_rows(df, binning, F.col(key), targets), binning)
    specs = [Spec(min_leaf, max_features, seed * 1000 + t, bootstrap) for t in range(n_trees)]
    trees, _ = grow(table, specs, [max_depth] * n_trees, _forest_members(specs), binning.size, len(targets))
    return Forest(binning, trees, specs, classes)


def fit_segments(df: DataFrame, features: list[str], label: str, key: str, segment: str, n_trees: int = 9,
                 max_depth: int = 6, min_leaf: int = 1, seed: int = 1, bins: int = 64) -> Forest:
    """A forest for every value of ``segment`` (null: none), all grown by the same ``max_depth`` scans."""
    values = [r[0] for r in df.select(segment).where(F.col(segment).isNotNull()).distinct()
              .orderBy(segment).limit(MAX_SEGMENTS + 1).collect()]
    if len(values) > MAX_SEGMENTS:
        raise ValueError(f"more than {MAX_SEGMENTS} segments")
    numbers = {v: i for i, v in enumerate(values)}
    binning = fit_bins(df, features, bins)
    known = df.where(F.col(segment).isNotNull())
    number = F.try_element_at(_lookup(numbers), F.col(segment)) if numbers else F.lit(0)
    table = binned_table(slim_rows(known, binning, F.col(key), [F.col(label)], segment=number.cast("int")), binning)
    specs = [Spec(min_leaf, None, seed * 1000 + t, True, s) for s in range(len(values)) for t in range(n_trees)]
    trees, _ = grow(table, specs, [max_depth] * len(specs), _forest_members(specs), binning.size, 1)
    return Forest(binning, trees, specs, None, segment, numbers)


def forest_grid(df: DataFrame, features: list[str], label: str, key: str, fold: Column, n_folds: int,
                depths: list[int], min_leafs: list[int], sizes: list[int] | None = None,
                max_features: list[int | None] | None = None, classes: list | None = None, seed: int = 1,
                bins: int = 64, folds: list[int] | None = None) -> DataFrame:
    """(n_trees, max_depth, min_leaf, max_features, n, mse, r2 or accuracy): every setting over all folds
    (or those listed, [0] being one holdout).  The squared error of classes is that of their shares.

    Only leaf size, features per node and fold are trees of their own; depths and sizes are read off the same
    trees.  ``sizes`` None: single trees on all rows; else forests of that many bootstrapped trees.  Costs
    max(depths) scans to grow and one to score; where rows outnumber the cells (``cell_trees``) and numbers are
    told from all features, one scan adds rows up by cell and trees are neither kept nor sent to the driver.
    """
    from tessera.operators import cell_trees

    targets = _targets(df, label, classes)
    binning = fit_bins(df, features, bins)
    slim = slim_rows(df, binning, F.col(key), targets, fold=fold.cast("int"))
    tried = max_features or [None]
    if classes is None and tried == [None]:
        held = list(range(n_folds)) if folds is None else folds
        all_rows = slim.agg(F.count(F.lit(1)).alias("n"), F.avg("y0").alias("y")).first()
        radix = cell_trees.radix_of(binning, all_rows["n"], len(held) + 1)
        if radix:
            sums = cell_trees.score_grid(slim, binning, radix, held, depths, min_leafs, sizes, seed, np.array([all_rows["y"]]))
            kinds = df.sparkSession.createDataFrame(list(enumerate(min_leafs)), "leaf int, min_leaf int")
            named = kinds.join(sums.withColumnRenamed("depth", "max_depth"), "leaf")
            return _graded(named.withColumn("max_features", F.lit(None).cast("int")), classes)
    table = binned_table(slim, binning)
    per, boot = (max(sizes), True) if sizes else (1, False)
    kinds = [(leaf, m, f) for leaf in min_leafs for m in tried for f in (range(n_folds) if folds is None else folds)]
    specs = [Spec(leaf, m, seed * 1000 + t, boot, None, f) for leaf, m, f in kinds for t in range(per)]
    trees, _ = grow(table, specs, [max(depths)] * len(specs), _forest_members(specs), binning.size, len(targets))
    settings = [(n, d, leaf, m) for leaf in min_leafs for m in tried for d in depths for n in (sizes or [1])]
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        out = np.zeros((len(settings), 5))
        number = {s: i for i, s in enumerate(settings)}
        for batch in _chunks(batches):
            x, y = _columns(batch, "b", np.int16), _columns(batch, "y", np.float64)
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            for k, (leaf, m, f) in enumerate(kinds):
                rows = np.flatnonzero(folds == f)
                if not len(rows):
                    continue
                mine, told = x[rows], y[rows]
                totals = {d: np.zeros((len(rows), y.shape[1])) for d in depths}
                spread = [told[:, 0].sum(), (told[:, 0] ** 2).sum()]
                for t in range(per):
                    node, above = 0, 0
                    for d in sorted(totals):
                        node, above = own.place(k * per + t, mine, d - above, node), d
                        total = totals[d]
                        total += own.value[k * per + t][node]
                        n = t + 1
                        if n in (sizes or [1]):
                            error = ((told - total / n) ** 2).sum()
                            right = (total.argmax(1) == told.argmax(1)).sum()
                            out[number[n, d, leaf, m]] += [len(rows), error, right, *spread]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(settings))), *(pa.array(out[:, i]) for i in range(5))],
                                         names=["s", "n", "error", "right", "sy", "syy"])

    scored = (table.mapInArrow(run, "s long, n double, error double, right double, sy double, syy double")
              .groupBy("s").agg(*[F.sum(c).alias(c) for c in ("n", "error", "right", "sy", "syy")]))
    names = df.sparkSession.createDataFrame([(i, *s) for i, s in enumerate(settings)],
                                            "s long, n_trees int, max_depth int, min_leaf int, max_features int")
    return _graded(names.join(scored, "s"), classes)


def _graded(sums: DataFrame, classes: list | None) -> DataFrame:
    """What ``forest_grid`` returns, from sums over held-out rows."""
    mse = F.col("error") / F.col("n")
    spread = F.col("syy") / F.col("n") - (F.col("sy") / F.col("n")) ** 2
    score = (F.col("right") / F.col("n")).alias("accuracy") if classes else F.when(spread > 0, 1 - mse / spread).alias("r2")
    return sums.where("n > 0").select("n_trees", "max_depth", "min_leaf", "max_features",
                                      F.col("n").cast("long").alias("n"), mse.alias("mse"), score)


# ---------------------------------------------------------------- boosting


@dataclass
class BoostSetting:
    """Squared loss, positive residuals (under-estimates) times ``eta`` before each tree."""

    max_depth: int = 3
    eta: float = 1.0
    learning_rate: float = 0.1
    min_leaf: int = 1


@dataclass
class Boosted:
    """One model per setting: base, its trees in order, and errors after each number of rounds."""

    binning: Binning
    settings: list[BoostSetting]
    base: float
    rounds: list[list[tuple[Trees, int]]]
    history: list[tuple]

    def history_frame(self, spark) -> DataFrame:
        """(model, max_depth, eta, round, train_mae, train_rmse, mae, rmse, mae_under, mae_over) on held-out rows."""
        return spark.createDataFrame(self.history, "model int, max_depth int, eta double, round int, train_mae double, "
                                     "train_rmse double, mae double, rmse double, mae_under double, mae_over double")

    def note(self, model: int, n: int, errors: np.ndarray) -> float:
        """Add a line of history from sums of residuals (see ``_errors``); returns the loss that early stopping follows."""
        tn, ta, ts, hn, ha, hs, un, ua, us, on, oa, os = errors
        share = lambda a, b: float(a / b) if b else None
        s = self.settings[model]
        self.history.append((model, s.max_depth, float(s.eta), n, share(ta, tn), float(np.sqrt(ts / tn)) if tn else None,
                             share(ha, hn), float(np.sqrt(hs / hn)) if hn else None, share(ua, un), share(oa, on)))
        return np.sqrt((s.eta * us + os) / hn) if hn else np.sqrt(ts / tn) if tn else np.inf

    def margins(self, model: int, x: np.ndarray, start: int = 0) -> np.ndarray:
        out = np.zeros(len(x))
        for trees, t in self.rounds[model][start:]:
            out += trees.predict(t, x)[:, 0]
        return self.settings[model].learning_rate * out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Add ``<out>_<model>`` for every setting."""
        shared = df.sparkSession.sparkContext.broadcast(self)
        keep = df.columns
        given = df.select("*", *[F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(self.binning.features)])
        schema = T.StructType([*df.schema.fields, *[T.StructField(f"{out}_{m}", T.DoubleType())
                                                    for m in range(len(self.settings))]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own: Boosted = shared.value
            for batch in batches:
                x = own.binning.of(batch, len(keep))
                more = [pa.array(own.base + own.margins(m, x)) for m in range(len(own.settings))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *more], names=schema.names)

        return given.mapInArrow(run, schema)


def _errors(r: np.ndarray, hold: np.ndarray) -> np.ndarray:
    """Sums of a model's residuals: training rows, held-out rows, and those under- and over-estimated."""
    parts = []
    for of in (~hold, hold):
        parts += [of.sum(), np.abs(r[of]).sum(), (r[of] ** 2).sum()]
    for of in (hold & (r >= 0), hold & (r < 0)):
        parts += [of.sum(), np.abs(r[of]).sum(), (r[of] ** 2).sum()]
    return np.array(parts, np.float64)


def boost(df: DataFrame, features: list[str], label: str, settings: list[BoostSetting], n_trees: int = 400,
          holdout: Column | None = None, patience: int | None = None, min_gain: float = 0.0,
          bins: int = 64) -> Boosted:
    """Boosting from the mean; all settings share each scan.

    A round costs as many scans as the deepest tree has levels, or one where rows outnumber the cells
    (``cell_trees``).  Rows where ``holdout`` is true only measure.
    With ``patience``, a setting ends when its held-out loss (the root of the mean square, under-estimates times
    eta) has not fallen by more than the share ``min_gain`` in so many rounds, and keeps its trees up to the best.
    """
    from tessera.operators import cell_trees

    hold = F.coalesce(holdout, F.lit(False)) if holdout is not None else F.lit(False)
    binning = fit_bins(df.where(~hold), features, bins)
    slim = slim_rows(df, binning, F.lit(0), [F.col(label)], hold=hold)
    radix = cell_trees.radix_of(binning, slim.count())
    if radix:
        return cell_trees.boost(slim.drop("key"), binning, radix, settings, n_trees, patience, min_gain)
    table = binned_table(slim, binning)
    base = table.where("NOT hold").agg(F.avg("y0")).first()[0] or 0.0
    model = Boosted(binning, settings, float(base), [[] for _ in settings], [])
    live = list(range(len(settings)))
    stored = [0] * len(settings)
    best = [(np.inf, 0)] * len(settings)
    spent = None

    def told(own: Boosted, batch: pa.RecordBatch, m: int) -> np.ndarray:
        name = f"m{m}"
        return batch.column(name).to_numpy(zero_copy_only=False) if name in batch.schema.names else np.full(batch.num_rows, own.base)

    def residuals(own: Boosted, batch: pa.RecordBatch, x: np.ndarray, wanted: list[int], start: list[int]):
        y = batch.column("y0").to_numpy(zero_copy_only=False)
        for m in wanted:
            yield m, y - told(own, batch, m) - own.margins(m, x, start[m])

    def with_margins(own: Boosted, wanted: list[int], start: list[int]) -> DataFrame:
        fields = [f for f in table.schema.fields if f.name[0] != "m"]
        schema = T.StructType([*fields, *[T.StructField(f"m{m}", T.DoubleType()) for m in wanted]])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _columns(batch, "b", np.int16)
                more = [pa.array(told(own, batch, m) + own.margins(m, x, start[m])) for m in wanted]
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), *more], names=schema.names)

        return table.mapInArrow(run, schema)

    for n in range(n_trees + 1):
        slim = Boosted(binning, settings, model.base, [r[s:] for r, s in zip(model.rounds, stored)], [])
        zero, wanted = [0] * len(settings), list(live)

        def members(batch, x, trees, own=slim, wanted=wanted, zero=zero):
            rows = np.flatnonzero(~batch.column("hold").to_numpy(zero_copy_only=False))
            here = list(trees)
            for i, (m, r) in zip(here, residuals(own, batch, x, [wanted[i] for i in here], zero)):
                scaled = np.where(r > 0, own.settings[m].eta * r, r)
                yield i, rows, np.ones(len(rows)), scaled[rows, None]

        def sums(batch, x, own=slim, wanted=wanted, zero=zero):
            hold_rows = batch.column("hold").to_numpy(zero_copy_only=False)
            for i, (m, r) in enumerate(residuals(own, batch, x, wanted, zero)):
                yield i, _errors(r, hold_rows)

        depths = [settings[m].max_depth if n < n_trees else 0 for m in wanted]
        specs = [Spec(settings[m].min_leaf) for m in wanted]
        trees, totals = grow(table, specs, depths, members, binning.size, 1, sums)
        if spent is not None:
            spent.unpersist()
        for i, m in enumerate(wanted):
            if i not in totals:
                live.remove(m)  # no rows at all
                continue
            loss = model.note(m, n, totals[i])
            if loss < best[m][0] * (1 - min_gain):
                best[m] = (loss, n)
            elif patience is not None and n - best[m][1] >= patience:
                live.remove(m)
                model.rounds[m] = model.rounds[m][:best[m][1]]
                continue
            if n < n_trees:
                model.rounds[m].append((trees, i))
        if not live or n == n_trees:
            break
        slim = Boosted(binning, settings, model.base, [r[s:] for r, s in zip(model.rounds, stored)], [])
        told_now = with_margins(slim, list(live), [0] * len(settings))
        spent, table = table, _stored(told_now, "margins") if (n + 1) % PENDING == 0 else told_now.persist()
        stored = [len(r) for r in model.rounds]
    table.unpersist()
    return model
