"""SentencePiece encoding and decoding by a batched numpy Viterbi.

The distinct pre-tokens of a slice are grouped by length, so that words of a
group advance together, one character at a time.  Prefix hashes give the hash
of every substring of up to the longest piece; sorted piece keys, one array
per length, are probed for all words and places at once.  At each place the
best start is a vectorised maximum, kept as a backpointer.  A task remembers
the ids of pre-tokens it has met, up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh_name, map_arrow, text_slices, with_fields
from tessera.llm.pieces import PieceVocabulary, default_model

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Characters that are probed at a time, and pre-tokens a task remembers: they bound memory, no result.
_PLACES = 60_000
_REMEMBERED = 800_000


def _prefix_hashes(codes: np.ndarray) -> np.ndarray:
    """Rolling hash of each prefix, modulo 2^64; row by row."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    # codes are spread first, so that neighbouring characters don't give related hashes
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + mixed[:, i]
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), -1)


class ViterbiEncoder:
    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary = v = vocabulary
        self.width = v.max_chars
        self.powers = np.cumprod(np.array([1] + [int(_BASE)] * self.width, np.uint64))
        self.tables = {}
        for n in range(1, self.width + 1):
            own = [p for p in v.scores if len(p) == n]
            if own:
                keys = _prefix_hashes(_codes(own))[:, -1]
                order = np.argsort(keys)
                if (np.diff(keys[order]) == 0).any():
                    raise ValueError("two pieces have one hash")
                self.tables[n] = (keys[order], np.array([v.scores[p] for p in own])[order],
                                  np.array([v.ids[p] for p in own], np.int32)[order])

    def _probe(self, codes: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that end at first + 1 .. last; by end and start (earliest first)."""
        n, w = len(codes), self.width
        low = max(0, first + 1 - w)
        hashes = _prefix_hashes(codes[:, low:last])
        scores = np.full((n, last - first, w), -np.inf)
        ids = np.full((n, last - first, w), -1, np.int32)
        for size, (keys, score, piece) in self.tables.items():
            start = max(first + 1 - size, 0)  # of the first end that this size reaches
            if start + size > last:
                continue
            a = hashes[:, start - low:last - size - low + 1]
            b = hashes[:, start + size - low:]
            wanted = b - a * self.powers[size]
            at = np.searchsorted(keys, wanted)
            at[at == len(keys)] = 0
            hit = keys[at] == wanted
            place = start + size - first - 1
            scores[:, place:, w - size] = np.where(hit, score[at], -np.inf)
            ids[:, place:, w - size] = np.where(hit, piece[at], -1)
        missing = ids[:, :, w - 1] < 0
        scores[:, :, w - 1][missing] = self.vocabulary.unknown_score
        return scores, ids

    def _encode_group(self, words: list[str]) -> list[np.ndarray]:
        codes = _codes(words)
        n, length = codes.shape
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, length + 1), np.int32)
        took = np.zeros((n, length + 1), np.int32)
        rows, w = np.arange(n), self.width
        for first in range(0, length, _PLACES):
            last = min(length, first + _PLACES)
            scores, ids = self._probe(codes, first, last)
            for end in range(first + 1, last + 1):
                m = min(end, w)
                options = best[:, end - m:end] + scores[:, end - first - 1, w - m:]
                which = options.argmax(1)  # the first maximum: the earliest start
                best[:, end] = options[rows, which]
                back[:, end] = m - which
                took[:, end] = ids[rows, end - first - 1, which + w - m]
        place = np.full(n, length)
        steps, live = [], rows
        while len(live):
            steps.append((live, took[live, place[live]], place[live]))
            place[live] -= back[live, place[live]]
            live = live[place[live] > 0]
        who = np.concatenate([s[0] for s in reversed(steps)])
        ids = np.concatenate([s[1] for s in reversed(steps)])
        ends = np.concatenate([s[2] for s in reversed(steps)])
        order = np.argsort(who, kind="stable")
        who, ids, ends = who[order], ids[order], ends[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(who)) + 1, [len(who)]])
        out = [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for row in np.unique(who[ids < 0]).tolist():  # characters that no piece covers
            word, spread = words[row], []
            for i, e in zip(out[row].tolist(), ends[cuts[row]:cuts[row + 1]].tolist()):
                spread += [i] if i >= 0 else self.vocabulary.uncovered(word[e - 1])
            out[row] = np.array(spread, np.int32)
        return out

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word (none may be empty)."""
        out: list[np.ndarray] = [None] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            size = max(1, _PLACES // length)
            for a in range(0, len(places), size):
                part = places[a:a + size]
                for i, ids in zip(part, self._encode_group([words[i] for i in part])):
                    out[i] = ids
        return out


class _Numbers(dict):
    """pre-token -> its number; new ones are queued."""

    def __init__(self):
        super().__init__()
        self.queue: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = n = len(self)
        self.queue.append(unit)
        return n


class TextEncoder:
    def __init__(self, vocabulary: PieceVocabulary):
        self.vocabulary, self.viterbi = vocabulary, ViterbiEncoder(vocabulary)
        self.numbers = _Numbers()
        self.flat, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _trim(self) -> None:
        """Forget the later half; the pre-tokens met first, which are the frequent ones, stay."""
        n = _REMEMBERED // 2
        kept = _Numbers()
        kept.update(islice(self.numbers.items(), n))
        self.numbers, self.flat = kept, self.flat[:self.starts[n]].copy()
        self.starts, self.lengths = self.starts[:n].copy(), self.lengths[:n].copy()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, offsets of the texts)."""
        if len(self.numbers) > _REMEMBERED:
            self._trim()
        split, number = self.vocabulary.pre_tokens, self.numbers.__getitem__
        each = [np.fromiter(map(number, split(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        if queue := self.numbers.queue:
            new = self.viterbi.encode(queue)
            lengths = np.fromiter(map(len, new), np.int64, len(new))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.flat = np.concatenate([self.flat, *new])
            queue.clear()
        units = np.concatenate(each) if each else np.zeros(0, np.int64)
        sizes = self.lengths[units]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[units] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        per_text = np.cumsum([0, *map(len, each)])
        return ids, np.concatenate([[0], ends])[per_text]


def decode_ids(ids: list[int], piece_bytes: list[bytes]) -> str:
    """The text of a sequence of ids; bytes that are no UTF-8 become U+FFFD."""
    data = b"".join(map(piece_bytes.__getitem__, ids))
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _checked(df: DataFrame, *names: str) -> None:
    for name in names:
        if fresh_name(df, name) != name:
            raise ValueError(f"the frame already has a column {name}")


def encode(df: DataFrame, model: str | None = None, text_col: str = "text", out: str = "token_ids",
           check: str | None = None) -> DataFrame:
    """Add the ids of each whole text (array of int): null for a null text, empty for an empty one.

    With ``check``, a boolean column of this name says whether decoding the
    ids gives the text again; it does unless the text has the mark U+2581 or
    lone surrogates.  Rows are handled one by one, repeated or not; other
    columns stay; an empty table gives no rows.  A frame that already has a
    new column raises ValueError.
    """
    _checked(df, out, *[check] * bool(check))
    shared = df.sparkSession.sparkContext.broadcast(PieceVocabulary.load(model or default_model()))
    fields = [(out, T.ArrayType(T.IntegerType()))] + [(check, T.BooleanType())] * bool(check)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(shared.value)
        table = shared.value.piece_bytes()
        for batch in batches:
            for at, n in text_slices(batch, text_col):
                part = batch.slice(at, n)
                texts = part.column(text_col).to_pylist()
                ids, offsets = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()),
                                                 mask=pa.array([t is None for t in texts]))
                more = [lists]
                if check:
                    cut = offsets.tolist()
                    more.append(pa.array([t is None or decode_ids(ids[a:b].tolist(), table) == t
                                          for t, a, b in zip(texts, cut, cut[1:])]))
                yield pa.RecordBatch.from_arrays([*part.columns, *more],
                                                 names=[*part.schema.names, *(f for f, _ in fields)])

    return map_arrow(df, run, with_fields(df.schema, *fields))


def decode(df: DataFrame, model: str | None = None, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the text of each array of ids: null for null; an id outside the vocabulary raises."""
    _checked(df, out)
    shared = df.sparkSession.sparkContext.broadcast(PieceVocabulary.load(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.piece_bytes()
        for batch in batches:
            texts = [None if x is None else decode_ids(x, table) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, out])

    return map_arrow(df, run, with_fields(df.schema, (out, T.StringType())))


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, token_ids, n_tokens, round_trip) of all documents."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode(slim, model, check="round_trip").select(
        "doc_id", "token_ids", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"), "round_trip")
