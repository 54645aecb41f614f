"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An item of L words is held by a text if the best local alignment of their words
scores at least R = max(L, min(2L, 8)), half of a full copy's 2L (items of up to
four words must be there in full).  The search misses no such text:

* Let an alignment have m matches and e changed, added or missing words, so
  2m - e >= R.  Of its m - 1 pairs of successive matches, at most e / 2 have two
  errors or more between them.  So at least T = ceil(R / 2) - 1 pairs have one at
  most: their two words stand at a distance of 1 or 2 in the item and in the text.
* The seeds of an item are such pairs of words (2L - 3 of them).  As T must be
  there, half of T (k, rounded up) are among its 2L - 3 - T + k rarest: only those
  are joined, and a passage meets an item on k of them at least.  Rarity is that
  over the distinct test items, so a stock phrase is left out first.
* An alignment spans at most 2L words, so the k seeds come that close.

The rare seeds and their items travel to the documents in blocks of about
``MAX_SEEDS`` seeds (one block for a usual benchmark): each block is one pass in
which every task looks up the word pairs of its whole texts, first in a Bloom
filter, then in the sorted seeds, and aligns the passages that meet an item
with it, many at a time.  Nothing of the documents is shuffled but what is found,
and no seed, however frequent, gathers its passages or items anywhere.

Whether a document meets an item depends on these two alone; all else only
decides how many pairs are looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, fresh_name, map_arrow, text_slices, via_table

SEGMENT_WORDS, SEGMENT_STEP = 256, 128
MATCH, MISMATCH, GAP = 2, -1, -1
#: An item counts as held from this share of a full copy's score on, and from so many words (or all it has).
MIN_SCORE, MIN_WORDS = 0.5, 4
#: Seeds of the items that travel to the tasks at a time, with 64 bits each in the filter (some 40 MB in all).
MAX_SEEDS = 500_000
_PROBES = 4
#: Pairs that are aligned at a time.
_PAIRS = 256
#: Scripts written without spaces: each character is a word.
_SINGLE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
_WORD, _PLAIN, _UNSPACED = re.compile(f"[{_SINGLE}]|[^\\W{_SINGLE}]+"), re.compile(r"\w+"), re.compile(f"[{_SINGLE}]")
_REMEMBERED = 500_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores of the lower-cased text; one character each in scripts without spaces."""
    return (_WORD if _UNSPACED.search(text) else _PLAIN).findall(text.lower()) if text else []


def needed_score(words: int) -> int:
    """R: the alignment score from which on an item of so many words is held."""
    return max(math.ceil(MIN_SCORE * MATCH * words), min(MATCH * words, MATCH * MIN_WORDS))


def needed_seeds(words: int) -> int:
    """T: seeds that every such alignment has."""
    return max(1, -(-needed_score(words) // MATCH) - 1)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), np.uint64)
    for h in (a, b):
        out = (out ^ h) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def word_hashes(words: list[str], hashes: _WordHashes) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def seed_hashes(h: np.ndarray) -> np.ndarray:
    """The seeds of an item: its word pairs at a distance of 1 and 2, or its only word."""
    if len(h) == 1:
        return _mixed(h, np.zeros(1, np.uint64))
    return np.concatenate([_mixed(h[:-1], h[1:]), _mixed(h[:-2], h[2:])])


def _probe_bits(grams: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bit numbers of each n-gram in a filter of ``bits`` (a power of two)."""
    step = (grams >> np.uint64(32)) | np.uint64(1)
    for k in range(_PROBES):
        yield (grams + step * np.uint64(k)) & np.uint64(bits - 1)


_SEGMENTS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("rare", T.IntegerType()),
    T.StructField("least", T.IntegerType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("grams", T.ArrayType(T.LongType()))])


def item_segments(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Words and seeds of each item, long items in overlapping segments;
    ``rare``: of so many rarest seeds any text that holds the segment has ``least`` or more.

    Items without a word are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - SEGMENT_WORDS + SEGMENT_STEP), SEGMENT_STEP):
                    part = words[at:at + SEGMENT_WORDS]
                    if part:
                        grams = seed_hashes(word_hashes(part, hashes))
                        seeds = needed_seeds(len(part))
                        least = -(-seeds // 2)
                        rows.append((item, len(grams) - seeds + least, least, part, grams.view(np.int64).tolist()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=_SEGMENTS.names)

    slim = items.select(col(id_col).cast("long").alias("item_id"), col(text_col).alias("text"))
    return map_arrow(slim, run, _SEGMENTS)


class ItemBlock:
    """Some of the items: their rare seeds in order, each with its segments, and a Bloom filter before them."""

    def __init__(self, segments: list, seeds: list):
        """``segments``: rows (segment, item_id, least, words); ``seeds``: rows (segment, gram, times)."""
        self.items = [r["item_id"] for r in segments]
        self.words = [r["words"] for r in segments]
        self.least = np.array([r["least"] for r in segments])
        number = {r["segment"]: i for i, r in enumerate(segments)}
        gram = np.array([r["gram"] for r in seeds], np.int64).view(np.uint64)
        order = np.argsort(gram, kind="stable")
        self.owner = np.array([number[r["segment"]] for r in seeds], np.int64)[order]
        self.times = np.array([r["times"] for r in seeds], np.int64)[order]
        self.grams, first = np.unique(gram[order], return_index=True)
        self.starts = np.append(first, len(gram))
        self.single = any(len(w) == 1 for w in self.words)
        by_owner = np.argsort(self.owner, kind="stable")
        cuts = np.cumsum(np.bincount(self.owner, minlength=len(segments)))[:-1]
        self.own_grams = np.split(np.searchsorted(self.grams, gram[order][by_owner]), cuts)
        bits = 1 << max(12, (64 * len(self.grams)).bit_length())
        self.bits = np.zeros(bits // 64, np.uint64)
        for b in _probe_bits(self.grams, bits):
            np.bitwise_or.at(self.bits, (b >> np.uint64(6)).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))

    def lookup(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the grams that are seeds, their numbers)."""
        places = _in_filter(grams, self.bits)
        number = np.searchsorted(self.grams, grams[places])
        number[number == len(self.grams)] = 0
        found = self.grams[number] == grams[places]
        return places[found], number[found]

    def met(self, numbers: np.ndarray) -> np.ndarray:
        """The segments of which a text with these seeds has enough."""
        numbers = np.unique(numbers)
        sizes = self.starts[numbers + 1] - self.starts[numbers]
        at = np.repeat(self.starts[numbers] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        segments, which = np.unique(self.owner[at], return_inverse=True)
        return segments[np.bincount(which, self.times[at], len(segments)) >= self.least[segments]]


def _in_filter(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the grams that the filter has; each probe looks only at those that passed the one before."""
    places = np.arange(len(grams))
    step = (grams >> np.uint64(32)) | np.uint64(1)
    for k in range(_PROBES):
        b = (grams[places] + step[places] * np.uint64(k)) & np.uint64(64 * len(bits) - 1)
        places = places[(bits[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)) == 1]
    return places


def _dense(places: np.ndarray, seeds: int, span: int) -> list[tuple[int, int]]:
    """(first, last) of the runs in which ``seeds`` of the sorted places come within ``span`` words,
    runs closer than two spans joined."""
    if len(places) < seeds:
        return []
    first, last = places[:len(places) - seeds + 1], places[seeds - 1:]
    near = last - first <= span
    first, last = first[near], last[near]
    if not len(first):
        return []
    cut = np.flatnonzero(first[1:] - last[:-1] > 2 * span) + 1
    return [(int(f[0]), int(e[-1])) for f, e in zip(np.split(first, cut), np.split(last, cut))]


# --- alignment --------------------------------------------------------------

def best_alignments(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, item words, passage words up to the end) of the best local alignment of each row of ``passages``
    (word numbers, negative where the item has no such word); the earliest end wins."""
    n, length = passages.shape
    slope = -GAP * np.arange(length + 1, dtype=np.int32)
    before = np.zeros((n, length + 1), np.int32)
    score, used, end = (np.zeros(n, np.int32) for _ in range(3))
    here = np.arange(n)
    for i, w in enumerate(item):
        now = np.zeros_like(before)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where(passages == w, np.int32(MATCH), np.int32(MISMATCH)),
                                before[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        # a run of gaps along the passage costs GAP a word: a running maximum along that slope
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.argmax(1)
        better = now[here, top] > score
        score[better], used[better], end[better] = now[here, top][better], i + 1, top[better]
        before = now
    return score, used, end


def align_many(item: list[str], passages: list[list[str]]) -> list[tuple[int, int, int]]:
    """(score, first, end) of the passage words that hold the item, for each passage."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(item))}
    own = np.array([ids[w] for w in item], np.int32)
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(passages)
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(passages):
        by_size.setdefault(len(p).bit_length(), []).append(i)
    for places in by_size.values():
        width = max(len(passages[i]) for i in places)
        table = np.full((len(places), width), -1, np.int32)
        for k, i in enumerate(places):
            table[k, :len(passages[i])] = [ids.get(w, -1) for w in passages[i]]
        score, used, end = best_alignments(own, table)
        for u in np.unique(used[score > 0]).tolist():  # backwards from the end: the same score, and the start
            rows = np.flatnonzero((used == u) & (score > 0))
            back = np.full((len(rows), int(end[rows].max())), -1, np.int32)
            for k, r in enumerate(rows):
                back[k, :end[r]] = table[r, :end[r]][::-1]
            again, _, length = best_alignments(own[:u][::-1], back)
            assert (again == score[rows]).all()
            for r, n in zip(rows.tolist(), length.tolist()):
                out[places[r]] = (int(score[r]), int(end[r]) - n, int(end[r]))
    return out


def align(item: list[str], passage: list[str]) -> tuple[float, int, int]:
    """(score between 0 and 1, first, end) of the passage words that hold the item."""
    score, first, end = align_many(item, [passage])[0]
    return score / (MATCH * len(item)), first, end


_FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType())])


def _search(docs: DataFrame, block: ItemBlock) -> DataFrame:
    """The aligned passages of all documents with the items of a block."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def passages(texts: list[list[str]], hashes: _WordHashes, own: ItemBlock) -> Iterator[tuple[int, int, int, int]]:
        """(text, segment, first, end): where a text may hold a segment."""
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        h = word_hashes([w for t in texts for w in t], hashes)
        text = np.repeat(np.arange(len(texts)), sizes)
        found = []
        for d in (1, 2):
            inside = np.flatnonzero(text[:-d] == text[d:])
            places, numbers = own.lookup(_mixed(h[inside], h[inside + d]))
            found.append((inside[places], numbers))
        if own.single:
            found.append(own.lookup(_mixed(h, np.zeros(len(h), np.uint64))))
        place, number = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(place, kind="stable")
        place, number = place[order], number[order]
        for i in np.unique(text[place]).tolist():
            base = int(ends[i] - sizes[i])
            a, b = np.searchsorted(place, [base, int(ends[i])])
            for segment in own.met(number[a:b]).tolist():
                span = 2 * len(own.words[segment])
                at = place[a:b][np.isin(number[a:b], own.own_grams[segment])] - base
                # an alignment has each of its seeds at a place of its own
                for first, last in _dense(at, int(own.least[segment]), span):
                    yield i, segment, max(0, first - span), last + 2 + span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashes = shared.value, _WordHashes()
        for batch in batches:
            for at, size in text_slices(batch, "text"):
                part = batch.slice(at, size)
                ids, keys = (part.column(c).to_pylist() for c in ("doc_id", "text_hash"))
                texts = [words_of(t) for t in part.column("text").to_pylist()]
                by_item: dict[int, list[tuple]] = {}
                if any(texts):
                    for i, segment, first, end in passages(texts, hashes, own):
                        by_item.setdefault(segment, []).append((i, first, texts[i][first:end]))
                rows = []
                for segment, given in by_item.items():
                    item = own.words[segment]
                    need = needed_score(len(item))
                    # too few words to match: the score can't be reached
                    kept = [g for g in given if MATCH * sum(map(set(g[2]).__contains__, item)) >= need]
                    for k in range(0, len(kept), _PAIRS):
                        share = kept[k:k + _PAIRS]
                        for (i, start, _), (score, first, end) in zip(share, align_many(item, [g[2] for g in share])):
                            if score >= need:
                                rows.append((ids[i], keys[i], own.items[segment], score / (MATCH * len(item)),
                                             start + first, start + end))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                                 names=_FOUND.names)

    return map_arrow(docs, run, _FOUND)


def _rare_seeds(segments: DataFrame) -> DataFrame:
    """(segment, gram, times): the ``rare`` rarest seeds of each segment, rarity counted over distinct items."""
    grams = segments.select("segment", "rare", F.explode("grams").alias("gram"))
    texts = segments.select(F.explode(F.array_distinct("grams")).alias("gram"), F.xxhash64("words").alias("text"))
    often = texts.distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("often"))
    place = F.row_number().over(Window.partitionBy("segment").orderBy("often", "gram"))  # 2 x 256 rows at most
    return (grams.join(often, "gram").withColumn("place", place).where(F.col("place") <= F.col("rare"))
            .groupBy("segment", "gram").agg(F.count(F.lit(1)).alias("times")))


def _matches(docs: DataFrame, items: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, text_hash, item_id, score, first_word, end_word) for each aligned passage."""
    spark: SparkSession = docs.sparkSession
    # segments are named by a number of their own: item ids may be null or repeated
    segments = via_table(item_segments(items, item_id, item_text)
                         .withColumn("segment", F.monotonically_increasing_id()), "decontaminate-items")
    seeds = via_table(_rare_seeds(segments), "decontaminate-seeds")
    slim = docs.select(col(doc_id).cast("long").alias("doc_id"), F.xxhash64(col(doc_text)).alias("text_hash"),
                       col(doc_text).alias("text"))
    blocks = -(-seeds.count() // MAX_SEEDS)
    found = spark.createDataFrame([], _FOUND)
    for b in range(blocks):
        own = F.pmod(F.xxhash64("segment"), F.lit(blocks)) == b
        found = found.unionByName(_search(slim, ItemBlock(
            segments.where(own).select("segment", "item_id", "least", "words").orderBy("segment").collect(),
            seeds.where(own).orderBy("gram", "segment").collect())))
    return found


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word): documents that hold a test item.

    One row per document id and item, for its best passage (of equal ones the
    first).  score: from 0.5 to 1 (a full copy); items of up to four words must
    be there in full.  The words are numbered from 0.  Null and empty texts hold
    nothing, an item without a word is held nowhere; very long texts are read
    whole, very long items in overlapping segments; repeated rows of a document
    give one row; null ids are a value like any other; empty tables give no
    rows.  Other columns are not read.
    """
    found = _matches(docs, items, doc_id, doc_text, item_id, item_text)
    best = F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("first_word"), -F.col("end_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    found = _matches(docs, items, "doc_id", "text", "item_id", "text")
    bad_id, bad_text = fresh_name(docs, "_bad_id"), fresh_name(docs, "_bad_text")
    bad = via_table(found.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_text)).distinct(),
                    "decontaminate-found")
    same = col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(col("text")) == F.col(bad_text))
    return docs.join(bad, same, "left_anti")
