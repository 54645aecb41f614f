"""Alignment of two tokenizers by pointer jumping over byte ranges.

A byte-level BPE (A) cuts space + text, a SentencePiece model (B) cuts the text;
both give the same bytes.  All tokens of a slice of texts lie on one line of
bytes.  Every token points to the token of the other side that reaches farthest
to the right among those it overlaps; a token of A whose end is an end of B too
points to itself.  Doubling all pointers at once, until nothing changes, takes
every token to the last one of its group, which labels the group.

Links are the pairs of an A token and a B token that share a byte.  Per
document the distinct pairs of ids and their numbers are kept, counted over
documents by a Spark aggregation, and the counts brought back: the most
frequent pairs (at most ``HEAD``) by broadcast, the others by a join.

Defined results: a text that is null or empty, or whose tokens' bytes differ
from space + text (for example by the mark U+2581), has no tokens: zeros and ''.
Repeated rows are documents of their own, a null ``doc_id`` stays null.  Texts
are handled whole; a very long one is a slice by itself.  Equal counts of an A
id's pairs are all the highest.  An empty table gives no rows; other columns don't
matter.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_arrow, text_slices, via_table, with_fields
from tessera.llm.pieces import MARK, default_model

#: Pairs whose counts are broadcast (17 bytes each); any number gives the same result.
HEAD = 262_144
#: An id pair as one number: A id * WIDTH + B id.
_WIDTH = 1 << 24
_PAIRS = (("pairs", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType())))


def default_bytes() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    characters of Latin-1 for themselves, the other bytes in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: How a byte-level file cuts a text before merging, when it does it in the usual way (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """A byte-level BPE file: ids of texts, and the bytes of each id.

    A file of the usual kind, whose ids are in the order of its merges and whose entries all come out
    of the merges, gives the same ids by ranks, which takes a fifth of the time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        alphabet = _byte_alphabet()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        own = {e: i for e, i in vocabulary.items() if all(c in alphabet for c in e)}
        for entry, i in own.items():
            self.bytes[i] = bytes(alphabet[c] for c in entry)
        self.ranks = None
        merges = [m if isinstance(m, str) else " ".join(m) for m in file["model"]["merges"]]
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        added = {t["content"] for t in file.get("added_tokens", [])}
        cut = file["pre_tokenizer"] or {}
        if (usual.items() <= cut.items() and file["normalizer"] is None and not file["model"].get("ignore_merges")
                and [own.get(m.replace(" ", "")) for m in merges] == list(range(256, 256 + len(merges)))
                and all([x.id for x in self.tokenizer.model.tokenize(e)] == [i] for e, i in own.items() if e not in added)):
            import tiktoken

            ranks = {self.bytes[i]: i for e, i in own.items() if e not in added}
            self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.ranks:
            return [self.ranks.encode_ordinary(" " + t) for t in texts]
        return self.file_ids(texts)

    def file_ids(self, texts: list[str]) -> list[list[int]]:
        """By the file's own library."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class PieceTokens:
    """A SentencePiece file: ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(map(m.id_to_piece, range(m.get_piece_size())))]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last A token of the group of each A token and of each B token.

    Both sides cover one line of bytes without gaps; no token is empty.
    """
    n = len(ends_a)
    # the token of the other side that holds the last byte reaches farthest
    to_b = np.searchsorted(ends_b, ends_a)
    to_a = np.searchsorted(ends_a, ends_b)
    follow = np.concatenate([np.where(ends_b[to_b] == ends_a, np.arange(n), n + to_b), to_a])
    while True:
        farther = follow[follow]
        if (farther == follow).all():
            return follow[:n], follow[n:]
        follow = farther


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all pairs that share a byte, by A token."""
    starts_a = np.concatenate([[0], ends_a[:-1]])
    first, last = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(ends_b, ends_a)
    sizes = last - first + 1
    a = np.repeat(np.arange(len(ends_a)), sizes)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


@dataclass
class Alignment:
    """Of a slice of texts: tokens per text, one line of tokens of all, their groups and links."""

    n_a: np.ndarray
    n_b: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in s.bytes]) for s in (self.a, self.b))
        # the text of an id with what follows it: inside a side, at its end
        self.words = [f"{i}{mark}" for marks, side in ((",|", self.a), (",;", self.b))
                      for i in range(len(side.bytes)) for mark in marks]

    def align(self, texts: list[str | None]) -> Alignment:
        tokens_a, tokens_b = [[] for _ in texts], [[] for _ in texts]
        places = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in places]
        for i, t, a, b in zip(places, given, self.a.ids(given), self.b.ids(given)):
            data = b" " + t.encode()
            if b"".join(map(self.a.bytes.__getitem__, a)) == data == b"".join(map(self.b.bytes.__getitem__, b)):
                tokens_a[i], tokens_b[i] = a, b
        n_a, n_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (tokens_a, tokens_b))
        ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *map(np.array, filter(None, t))]).astype(np.int64)
                        for t in (tokens_a, tokens_b))
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        return Alignment(n_a, n_b, ids_a, ids_b, ends_a, ends_b, *jump(ends_a, ends_b), *overlaps(ends_a, ends_b))

    def group_texts(self, x: Alignment) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text: ids of the groups in order."""
        last_a = np.append(x.group_a[1:] != x.group_a[:-1], True)[:len(x.ids_a)]
        last_b = np.append(x.group_b[1:] != x.group_b[:-1], True)[:len(x.ids_b)]
        codes = np.concatenate([2 * x.ids_a + last_a, 2 * (len(self.sizes_a) + x.ids_b) + last_b])
        # groups in order of their last token, A before B; sorting is stable
        order = np.argsort(np.concatenate([2 * x.group_a, 2 * x.group_b + 1]), kind="stable")
        words = self.words
        line = [words[c] for c in codes[order].tolist()]
        cuts = np.cumsum(np.concatenate([[0], x.n_a + x.n_b])).tolist()
        return ["".join(line[i:j])[:-1] for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _per_text(flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[np.cumsum(np.concatenate([[0], sizes]))])


def _pairs(x: Alignment) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of the texts, distinct id pairs of each, their numbers, links of each text)."""
    n = len(x.n_a)
    text = np.repeat(np.arange(n), x.n_a)[x.link_a]
    key = x.ids_a[x.link_a] * _WIDTH + x.ids_b[x.link_b]
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]))[:len(key)])
    offsets = np.searchsorted(text[first], np.arange(n + 1))
    return offsets, key[first], np.diff(np.append(first, len(key))), np.bincount(text, minlength=n)


def align_texts(df: DataFrame, text_col: str, keep: list[str], path_a: str, path_b: str,
                with_groups: bool = False) -> DataFrame:
    """The ``keep`` columns with n_a, n_b, n_groups, n_links, groups_sha256, pairs (A id * 2^24 + B id) and
    how often each pair is linked; with ``with_groups``, the groups' text instead of its digest."""
    slim = df.select(*keep, text_col)
    numbers = [(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    schema = with_fields(slim.select(*keep).schema, *numbers,
                         ("groups" if with_groups else "groups_sha256", T.StringType()), *_PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            for at, n in text_slices(batch, text_col):
                part = batch.slice(at, n)
                x = aligner.align(part.column(text_col).to_pylist())
                groups = aligner.group_texts(x)
                if not with_groups:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                offsets, keys, times, links = _pairs(x)
                ends = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(x.n_a), pa.array(x.n_b),
                     pa.array(_per_text(x.group_a == np.arange(len(x.group_a)), x.n_a)), pa.array(links, pa.int64()),
                     pa.array(groups, pa.string()), pa.ListArray.from_arrays(ends, pa.array(keys, pa.int64())),
                     pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))], names=schema.names)

    return map_arrow(slim, run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents an id pair is linked, and whether no pair of its A id is in more."""
    docs = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    docs = via_table(docs, "token-pairs").withColumn("a", F.shiftright("pair", _WIDTH.bit_length() - 1))
    most = docs.groupBy("a").agg(F.max("docs").alias("most"))  # one row for each id of the vocabulary at most
    return via_table(docs.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")),
                     "token-counts")


def _head(counts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``size`` most frequent pairs in order: pairs, counts, whether best."""
    rows = counts.orderBy(F.desc("docs"), "pair").limit(size).toArrow().sort_by("pair")
    return tuple(rows[c].to_numpy() for c in ("pair", "docs", "best"))


def link_scores(aligned: DataFrame, counts: DataFrame, row: str, head: int = HEAD) -> DataFrame:
    """(row, n_best, count_sum) of the rows that have links."""
    shared = aligned.sparkSession.sparkContext.broadcast(_head(counts, head))
    slim = aligned.select(row, "pairs", "times")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            sizes = np.diff(lists.offsets.to_numpy())
            pair, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(keys, pair)
            at[at == len(keys)] = 0
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            n_best, count = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
            n_best[hit], count[hit] = best[at[hit]] * times[hit], docs[at[hit]] * times[hit]
            ends = np.concatenate([[0], np.cumsum(~hit)])[np.concatenate([[0], np.cumsum(sizes)])]
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), pa.array(_per_text(n_best, sizes)), pa.array(_per_text(count, sizes)),
                 pa.ListArray.from_arrays(ends, pa.array(pair[~hit])),
                 pa.ListArray.from_arrays(ends, pa.array(times[~hit].astype(np.int32)))],
                names=[row, "n_best", "count_sum", "pairs", "times"])

    schema = with_fields(slim.select(row).schema, ("n_best", T.LongType()), ("count_sum", T.LongType()), *_PAIRS)
    probed = via_table(map_arrow(slim, probe, schema), "token-links")
    tail = probed.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    tail = tail.select(row, "p.pairs", "p.times").withColumnRenamed("pairs", "pair").join(counts, "pair")
    rest = tail.select(row, F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
                       (F.col("docs") * F.col("times")).alias("count_sum"))
    return (probed.select(row, "n_best", "count_sum").unionByName(rest)
            .groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
                    head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of all documents."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = via_table(align_texts(slim, "text", ["row", "doc_id"], path_a or default_bytes(), path_b or default_model()),
                        "token-aligned")
    scores = link_scores(aligned, pair_counts(aligned), "row", head)
    return aligned.drop("pairs", "times").join(scores, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
