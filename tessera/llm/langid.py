"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training sums, per language, how often each of ``buckets`` n-gram hashes
occurs: every task counts its own rows with numpy and sends one row per
language and bucket it met; Spark adds them up.  The matrix of
log-probabilities has ``max_languages`` x ``buckets`` numbers at most, a bound
that is checked before it is broadcast.  Scoring gathers, for all n-grams of
a slice of texts at once, their columns of the matrix and adds them up by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh_name, map_arrow, text_slices, with_fields

BUCKETS = 1 << 14
ORDERS = (2, 3)
MAX_LANGUAGES = 512
SMOOTHING = 0.5
UNDETERMINED = "und"


def gram_buckets(texts: list[str | None], buckets: int, orders: tuple[int, ...] = ORDERS
                 ) -> tuple[list[np.ndarray], np.ndarray]:
    """([bucket of each n-gram], end of each text) for lower-cased texts.

    Texts are laid end to end with a space after each; every position starts
    one n-gram of each order, so each order gives len(text) + 1 buckets a text.
    N-grams that would reach into the next text all go to bucket 0.
    """
    joined = "".join([(t or "").lower() + " " for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len((t or "").lower()) + 1 for t in texts])
    letters = np.where(codes < 65, 32, codes).astype(np.uint32)  # digits, marks and white space are one sign
    step = np.uint32(0x9E3779B1)
    out, h = [], np.zeros(len(letters), np.uint32)
    for n in range(1, max(orders) + 1):
        following = np.full(len(letters), 32, np.uint32)
        following[:len(letters) - n + 1] = letters[n - 1:]
        h = (h ^ following) * step
        h ^= h >> np.uint32(15)
        if n in orders:
            out.append((h & np.uint32(buckets - 1)).astype(np.int32))
            for k in range(1, n):
                out[-1][ends - k] = 0
    return out, ends


@dataclass
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray  # buckets x languages
    log_priors: np.ndarray
    orders: tuple[int, ...]

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Log joint score of each text and language."""
        each, ends = gram_buckets(texts, len(self.log_probs), self.orders)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        total = np.tile(self.log_priors, (len(texts), 1))
        for grams in each:
            total += np.add.reduceat(self.log_probs[grams], starts, axis=0, dtype=np.float64)
        return total


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", buckets: int = BUCKETS,
          orders: tuple[int, ...] = ORDERS, max_languages: int = MAX_LANGUAGES) -> LanguageModel:
    """Fit on all rows that have a text and a label.  No row at all gives a model of no language."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("lang")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}  # the last place holds the number of documents
        for batch in batches:
            for at, n in text_slices(batch, "text"):
                part = batch.slice(at, n)
                texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
                for lang in set(langs):
                    own = [t for t, x in zip(texts, langs) if x == lang]
                    if lang not in sums:
                        if len(sums) >= max_languages:
                            raise ValueError(f"more than {max_languages} languages")
                        sums[lang] = np.zeros(buckets + 1, np.int64)
                    for grams in gram_buckets(own, buckets, orders)[0]:
                        sums[lang][:buckets] += np.bincount(grams, minlength=buckets)
                    sums[lang][buckets] += len(own)
        for lang, c in sums.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some.astype(np.int32)), pa.array(c[some])],
                names=["lang", "bucket", "n"])

    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("n", T.LongType())])
    # one row per language: at most max_languages x (buckets + 1) numbers reach the driver
    sums = (map_arrow(rows, count, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("n").alias("ns")))
    found = sums.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    found.sort(key=lambda r: r["lang"])
    counts = np.zeros((len(found), buckets + 1))
    for row, r in zip(counts, found):
        row[r["buckets"]] = r["ns"]
    grams, docs = counts[:, :buckets] + SMOOTHING, counts[:, buckets]
    return LanguageModel([r["lang"] for r in found],
                         np.log(grams / grams.sum(1, keepdims=True)).T.astype(np.float32).copy(),
                         np.log(np.maximum(docs, 1) / max(docs.sum(), 1)), orders)


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """Add the language of the largest posterior and that posterior.

    A null text, a text without a letter, and any text where no language was
    learned get ``und`` and 0.  Ties go to the first language in
    alphabetical order.  Only the text is looked at; repeated rows and other
    columns stay as they are; an empty table gives no rows.  A frame that already
    has one of the new columns raises ValueError.
    """
    for name in (pred_col, score_col):
        if fresh_name(df, name) != name:
            raise ValueError(f"the frame already has a column {name}")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for at, n in text_slices(batch, text_col):
                part = batch.slice(at, n)
                texts = part.column(text_col).to_pylist()
                known = np.array([bool(own.languages) and t is not None and any(map(str.isalpha, t)) for t in texts])
                names, scores = np.full(n, UNDETERMINED, object), np.zeros(n)
                where = np.flatnonzero(known)
                if len(where):
                    joint = own.score([texts[i] for i in where])
                    best = joint.argmax(1)
                    names[where] = np.array(own.languages, object)[best]
                    scores[where] = 1 / np.exp(joint - joint.max(1, keepdims=True)).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names.tolist(), pa.string()), pa.array(scores)],
                    names=[*part.schema.names, pred_col, score_col])

    return map_arrow(df, run, with_fields(df.schema, (pred_col, T.StringType()), (score_col, T.DoubleType())))


def is_held_out(id_col: str = "doc_id"):
    """The fold that training never sees; a null id belongs to training."""
    fold = F.crc32(F.col(id_col).cast("string")) % 4
    return F.coalesce(fold == 2, F.lit(False))


def predict_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside the held-out fold, predict all."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("lang"))
    model = train(slim.where(~is_held_out()))
    rows = slim.select("doc_id", is_held_out().alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Drop documents whose language can't be told: ``und`` or a posterior below ``min_score``."""
    model = train(docs.where(~is_held_out()))
    pred = fresh_name(docs, "_lang_pred")
    score = fresh_name(docs, "_lang_score")
    scored = predict(docs, model, pred_col=pred, score_col=score)
    return scored.where((F.col(pred) != UNDETERMINED) & (F.col(score) >= min_score)).drop(pred, score)
