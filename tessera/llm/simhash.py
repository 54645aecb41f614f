"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of 22, 21 and 21 bits.
Each segment, with zeros in front, is a word of the perfect binary Golay code
(23 bits, 4096 codewords, every word within 3 bits of exactly one codeword).
The fuzzy keys of a segment are the codewords of the word itself and of its
one-bit changes.  Two segments at distance 2 or less share a key: change the
first in one of the two bits and the second in the other, and both become the
same word.  A segment has about five keys.

Of at most 4 differing bits, let a <= b <= c be the numbers per segment.

* c <= 2: all three segments share a key, so the fingerprints share a triple
  of codeword indices (36 bits).
* c >= 3: a + b <= 1, so one segment is equal and another one shares a key;
  the pair (segment, codeword index) is shared (33 or 34 bits).

Rows with a common key are compared in full (at most 4 bits differ), so the
links found are exactly those of the definition.  A key that more than
``MAX_BUCKET`` fingerprints have is not expanded into pairs.  Its members take
the exact way for dense places: two fingerprints are at most 4 bits apart if
and only if some point is at most 2 bits from both, and all fingerprints
around one point are linked with each other, so the members of the ball are
tied to the smallest one.  That work is linear in the number of members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import (col, cut_lineage, fresh_name, map_arrow, text_slices, via_table,
                                with_fields)

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Keys with more fingerprints take the exact way for dense places.
MAX_BUCKET = 32
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY_POLY = 0b101011100011


# --- fingerprints -----------------------------------------------------------

def shingle_hashes(text: str, n_words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every word shingle, repeats included; bytes.lower and bytes.split
    know ASCII only, which is what the definition asks for."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= n_words:
        return [digest(line, HASH_SEED)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [digest(line[a:b], HASH_SEED)
            for a, b in zip(starts[:len(words) - n_words + 1].tolist(), ends[n_words - 1:].tolist())]


def majority_bits(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One uint64 per run of hashes: a bit is set if over half of the run has it."""
    out = np.zeros(len(lengths), np.uint64)
    some = np.flatnonzero(lengths)
    if len(some):
        starts = (np.cumsum(lengths) - lengths)[some]
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        set_ = (2 * ones > lengths[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint",
                      n_words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the SimHash of the text as a long; a null or empty text has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in text_slices(batch, text_col):
                part = batch.slice(at, n)
                each = [shingle_hashes(t, n_words) if t else [] for t in part.column(text_col).to_pylist()]
                lengths = np.fromiter(map(len, each), np.int64, n)
                flat = np.fromiter((h for x in each for h in x), np.uint64, int(lengths.sum()))
                got = majority_bits(flat, lengths).view(np.int64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got)], names=[*part.schema.names, out])

    return map_arrow(df, run, with_fields(df.schema, (out, T.LongType())))


# --- Golay keys -------------------------------------------------------------

@lru_cache(1)
def golay_index() -> np.ndarray:
    """Index of the nearest codeword for each of the 2^23 words."""
    def remainder(w: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            w = np.where(w >> bit & 1, w ^ GOLAY_POLY << (bit - 11), w)
        return w

    errors = np.array([sum(1 << b for b in c) for k in range(4) for c in combinations(range(23), k)])
    leader = np.zeros(2048, np.int64)  # the code is perfect: 2048 errors of weight <= 3, 2048 syndromes
    leader[remainder(errors)] = errors
    out = np.empty(1 << 23, np.int16)
    for a in range(0, 1 << 23, 1 << 18):
        w = np.arange(a, a + (1 << 18), dtype=np.int32)
        out[a:a + (1 << 18)] = (w ^ leader[remainder(w)]) >> 11
    return out


def segment_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """Distinct codeword indices of each word and its one-bit changes; -1 fills the rows."""
    index = golay_index()
    got = np.stack([index[words], *(index[words ^ (1 << b)] for b in range(bits))], axis=1)
    got.sort(axis=1)
    got[:, 1:][got[:, 1:] == got[:, :-1]] = -1
    got[:, ::-1].sort(axis=1)
    # a word at distance 3 of its codeword touches 5 others, a nearer one none
    return got[:, :6].astype(np.int64)


def fuzzy_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the fingerprint, key) for all keys of all fingerprints."""
    raw = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [segment_keys(w, n) for w, (_, n) in zip(raw, SEGMENTS)]
    who, keys = [], []

    def add(key: np.ndarray, good: np.ndarray) -> None:
        where = np.nonzero(good)
        who.append(where[0])
        keys.append(key[where])

    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    add(a << 24 | b << 12 | c, (a >= 0) & (b >= 0) & (c >= 0))
    for i in range(3):
        for j in range(3):
            if i != j:  # the segment i as it is; above the triples, a range for each (i, j)
                add(raw[i][:, None] << 12 | near[j] | (1 + 3 * i + j) << 40, near[j] >= 0)
    return np.concatenate(who), np.concatenate(keys)


# --- links ------------------------------------------------------------------

_KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())])
_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_fps = batch.column("fp").to_numpy()
        for at in range(0, len(all_fps), 2000):
            fps = all_fps[at:at + 2000]
            who, keys = fuzzy_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[who])], names=["key", "fp"])


def _bucket_links(batches: Iterator[pa.RecordBatch], max_bucket: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> verified links (a < b), or (fp, fp) for members of a full bucket."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        run = np.cumsum(new) - 1
        size = np.bincount(run)[run]
        full = fps[size > max_bucket]
        keep = (size > 1) & (size <= max_bucket)
        keys, fps = keys[keep], fps[keep]
        left, right = [np.unique(full)], [np.unique(full)]
        at = np.arange(len(keys))
        for d in range(1, max_bucket):
            at = at[at < len(keys) - d]
            at = at[keys[at] == keys[at + d]]
            if not len(at):
                break
            x, y = fps[at], fps[at + d]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_BITS
            left.append(np.minimum(x, y)[near])
            right.append(np.maximum(x, y)[near])
        pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on in the next batch
        if held and not cut and held[-1][0][-1] != keys[-1]:
            yield links(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
            held = []
        if cut:
            held.append((keys[:cut], fps[:cut]))
            yield links(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))
            held = []
        tail = keys[cut:], fps[cut:]
        if held and sum(len(k) for k, _ in held) > 2 * max_bucket:
            # an over-full run: its members are marked as they come, a remnant keeps it over-full
            yield pa.RecordBatch.from_arrays([pa.array(tail[1]), pa.array(tail[1])], names=["a", "b"])
        else:
            held.append(tail)
    if held:
        yield links(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))


def _ball_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every point at most two bits from a fingerprint."""
    bits = [1 << b for b in range(64)]
    masks = np.array([0, *bits, *(x | y for x, y in combinations(bits, 2))], np.uint64).view(np.int64)
    for batch in batches:
        fps = batch.column("fp").to_numpy()
        for at in range(0, len(fps), 64):
            part = fps[at:at + 64]
            points = (part[:, None] ^ masks).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(points), pa.array(np.repeat(part, len(masks)))], names=["key", "fp"])


def fingerprint_links(fps: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints (one long column ``fp``).

    The transitive closure of the links is that of all pairs at most 4 bits
    apart.  Within a full bucket members are tied by a star per ball instead
    of by all pairs.
    """
    keyed = map_arrow(fps, _key_rows, _KEYED)
    found = via_table(map_arrow(keyed.repartition("key").sortWithinPartitions("key"),
                                partial(_bucket_links, max_bucket=max_bucket), _LINKS), "simhash-links")
    dense = found.where("a = b").select(F.col("a").alias("fp")).distinct()
    ball = map_arrow(dense.repartition("fp"), _ball_rows, _KEYED)
    # points with one fingerprint around them tie nothing; the partial sums leave each task once a point
    stars = (ball.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("m"))
             .where("a < m").select("key", "a"))
    tied = ball.join(stars.hint("merge"), "key").where("fp > a").select("a", F.col("fp").alias("b"))
    return found.where("a < b").unionAll(tied).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without a link are absent.

    Alternating large-star and small-star steps: every step keeps the
    components, and all links end as stars around the smallest node.  Each
    round is checkpointed; minima are aggregated before the shuffle, so a hub
    with very many links is not gathered in one task.
    """
    edges, seen = cut_lineage(links.select("a", "b")), None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima as a table of their own: the joins then shuffle both sides and AQE splits a hub
        low = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = cut_lineage(both.join(low.hint("merge"), "a").where("b > a").select(F.col("m").alias("a"), "b").distinct())
        # every edge now runs from the smaller to the larger node
        root = cut_lineage(large.groupBy("b").agg(F.min("a").alias("m")))
        small = (large.join(root.hint("merge"), "b")
                 .select(F.explode(F.array(F.struct(F.col("m").alias("a"), "b"),
                                           F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a < b").distinct())
        edges = cut_lineage(small)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint of (doc_id, fp)."""
    # copies collapse here: from now on one row per distinct fingerprint
    distinct = via_table(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected(fingerprint_links(distinct.select("fp")))
    named = cut_lineage(distinct.join(roots.hint("merge"), distinct.fp == roots.node, "left")
                        .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    least = cut_lineage(named.groupBy("root").agg(F.min("low").alias("component_id")))
    return via_table(named.join(least.hint("merge"), "root").select("fp", "root", "component_id"), "simhash-classes")


def _prints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    slim = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return via_table(with_fingerprints(slim).select("doc_id", F.col("fingerprint").alias("fp")), "simhash-prints")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    fingerprint: 16 lower-case hex digits.  component_id: the smallest id
    reachable over links of at most 4 differing bits, the row's own included.
    A null, empty or blank text has fingerprint zero and is linked like any
    other.  Repeated rows come out as often as they came in; a null id is
    never a component's id unless all its ids are null (then null).  An empty
    table gives no rows; other columns are not read.
    """
    prints = _prints(df, id_col, text_col)
    return prints.join(_classes(prints).select("fp", "component_id").hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keep one row of each component: the one with its smallest id.

    All columns are kept.  Of rows that repeat this id, the one with the
    smallest text hash stays (any of fully equal rows).  A component whose
    rows all lack an id keeps one of them.
    """
    prints = _prints(df, id_col, text_col)
    classes = _classes(prints)
    names = df.columns
    key, rank, fp = (fresh_name(df, x) for x in ("_kept_id", "_rank", "_fingerprint"))
    kept = via_table(classes.where("component_id is not null")
                     .select(F.col("component_id").alias(key)).distinct(), "simhash-kept")
    with_id = df.join(kept, col(id_col).cast("long") == F.col(key))
    one = Window.partitionBy(key).orderBy(F.xxhash64(col(text_col)))
    with_id = with_id.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).select(*map(col, names))

    root = fresh_name(names + [fp], "_root")
    lone = classes.where("component_id is null").select(F.col("fp").alias(fp), F.col("root").alias(root))
    without = with_fingerprints(df.where(col(id_col).isNull()), text_col, fp)
    without = without.join(lone, fp).dropDuplicates([root]).select(*map(col, names))
    return with_id.unionAll(without)
