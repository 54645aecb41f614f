"""Token counts by dynamic programming shared in a trie.

The unigram forward score of a position (the best sum of scores of pieces that
end there) depends only on the prefix before it.  Distinct pre-tokens are put
into a trie; a node stands for a prefix and gets its forward score, with the
number of tokens of that best path, once, when it is made.  A pre-token's
count is then read at its terminal node, and a text's count is a sum of
lookups.  Each task keeps a trie of its own, replanted at ``MAX_NODES``, and
remembers terminal counts up to ``MAX_COUNTS``, so memory is bounded and
nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fresh_name, map_arrow, text_slices, with_fields
from tessera.llm.pieces import PieceVocabulary, default_model

#: Nodes a task holds before it starts a new trie, and counts it remembers; only speed depends on them.
MAX_NODES = 500_000
MAX_COUNTS = 500_000


def reversed_pieces(vocabulary: PieceVocabulary) -> dict:
    """The pieces from their last character back: nested dicts, a piece's score at ''."""
    root: dict = {}
    for piece, score in vocabulary.scores.items():
        at = root
        for char in reversed(piece):
            at = at.setdefault(char, {})
        at[""] = score
    return root


class CountTrie(dict):
    """pre-token -> number of tokens; a missing one is inserted into the trie."""

    def __init__(self, vocabulary: PieceVocabulary):
        super().__init__()
        self.vocabulary, self.tails = vocabulary, reversed_pieces(vocabulary)
        self._plant()

    def _plant(self) -> None:
        self.children: dict[int, int] = {}  # node and character, packed -> node
        self.forward, self.tokens = [0.0], [0]

    def trim(self) -> None:
        """Bound the memory; the counts met first, which are the frequent ones, stay."""
        if len(self.forward) > MAX_NODES:
            self._plant()
        if len(self) > MAX_COUNTS:
            first = list(islice(self.items(), MAX_COUNTS // 2))
            self.clear()
            self.update(first)

    def __missing__(self, unit: str) -> int:
        children, forward, tokens, tails = self.children, self.forward, self.tokens, self.tails
        node, path = 0, [0]
        for end, char in enumerate(unit):
            step = node << 21 | ord(char)
            below = children.get(step)
            if below is None:
                best, count, tail = float("-inf"), 0, tails
                # pieces that end here, by growing length; the earliest start wins a tie
                for start in range(end, -1, -1):
                    tail = tail.get(unit[start])
                    if tail is None:
                        break
                    if "" in tail and (total := forward[path[start]] + tail[""]) >= best:
                        best, count = total, tokens[path[start]] + 1
                if char not in self.vocabulary.scores and forward[node] + self.vocabulary.unknown_score > best:
                    best = forward[node] + self.vocabulary.unknown_score
                    count = tokens[node] + len(self.vocabulary.uncovered(char))
                below = children[step] = len(forward)
                forward.append(best)
                tokens.append(count)
            node = below
            path.append(node)
        self[unit] = tokens[node]
        return tokens[node]


def with_token_counts(df: DataFrame, model: str | None = None, text_col: str = "text",
                      out: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of each whole text (long); null and empty texts have 0.

    ``model`` is the path of a SentencePiece file on the driver.  Rows are
    counted one by one, repeated or not; other columns stay as they are; an
    empty table gives no rows.  A frame that already has the new column raises
    ValueError.
    """
    if fresh_name(df, out) != out:
        raise ValueError(f"the frame already has a column {out}")
    # the size of a vocabulary file, whatever the number of rows
    shared = df.sparkSession.sparkContext.broadcast(PieceVocabulary.load(model or default_model()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        counts = CountTrie(vocabulary)
        for batch in batches:
            for at, n in text_slices(batch, text_col):
                part = batch.slice(at, n)
                got = []
                for text in part.column(text_col).to_pylist():
                    got.append(sum(map(counts.__getitem__, vocabulary.pre_tokens(text))) if text else 0)
                    counts.trim()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.int64())],
                                                 names=[*part.schema.names, out])

    return map_arrow(df, run, with_fields(df.schema, (out, T.LongType())))


def count_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of all documents."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_token_counts(slim, model).select("doc_id", "n_tokens")
