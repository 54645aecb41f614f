"""Main text of web pages with a suffix array over each host.

Structure tells an article (or, without one, a main element) from what stands
beside it: menus, headers, footers, adverts, forms and comments.  The text beside
the articles of a host's distinct pages goes into the host's suffixes, too: a run
that at least half of these pages, and three of them, set beside the article is
a menu or notice of the host, and a block of an article that such runs cover
whole goes with them, unless little of the article would be left.  An article
keeps all else, also what it shares with other articles.

All text that structure leaves open, such as the whole body of a page without
those elements, is decided by the host's other pages: the blocks of a
host's distinct pages form one token stream, with a mark that is never equal
to anything between pages and a block mark between blocks; runs of ``MIN_RUN``
or more tokens that occur on several distinct pages, be it in their articles,
beside them or in open text, are boilerplate and their tokens go from open
text; unique runs stay.

The suffix array of a stream orders its suffixes so that suffixes with a
common start are neighbours.  Only starts of MIN_RUN tokens matter here, so
suffixes are grouped by the hash of their first MIN_RUN tokens instead of
being sorted to the end: equal starts meet in one group, every neighbour pair
with a common prefix of MIN_RUN tokens is found, and no host has to lie in
one task.  A longer common substring is the union of the starts it covers.

Near copies of one page must not delete each other.  A page that would lose more
than ``NEAR`` of its words is a near copy (or little but boilerplate): it loses
only runs that an open page of the other kind has as well, that a page sets beside
its text, or that at least half of the host's distinct pages have, and three of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_arrow, text_slices, via_table
from tessera.llm.html_blocks import ARTICLE, BESIDE, MAIN, OPEN, blocks_of

#: Tokens (words and block marks) of a repeated run, and pages it must be on.
MIN_RUN, MIN_PAGES = 8, 2
#: A page that would lose more than this share of its words is a near copy.
NEAR = 0.8
_BLOCK = "\n"

_PARSED = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()),
    T.StructField("known", T.BooleanType()), T.StructField("open", T.ArrayType(T.StringType())),
    T.StructField("beside", T.ArrayType(T.StringType())), T.StructField("content", T.LongType())])


def host_of(url: Column) -> Column:
    """Lower-case host name of an absolute address, else an empty string."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def _parse(pages: DataFrame) -> DataFrame:
    """One row per page: the blocks of its best part, if structure knows that as the article, and those beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in text_slices(batch, "html"):
                part = batch.slice(at, n)
                known, owns, besides, contents = [], [], [], []
                for html in part.column("html").to_pylist():
                    blocks = blocks_of(html, beside=True)
                    best = min((p for p, _ in blocks if p != BESIDE), default=OPEN)
                    own = [t for p, t in blocks if p == best]
                    known.append(best in (ARTICLE, MAIN) or not own)
                    owns.append(own)
                    besides.append([t for p, t in blocks if p == BESIDE])
                    contents.append(xxhash.xxh64_intdigest("\n".join(own).encode("utf-8", "surrogatepass")) - (1 << 63))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), pa.array(known, pa.bool_()),
                     pa.array(owns, pa.list_(pa.string())), pa.array(besides, pa.list_(pa.string())),
                     pa.array(contents, pa.int64())], names=_PARSED.names)

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        host_of(F.col("url")).alias("host"), F.col("html"))
    return map_arrow(slim, run, _PARSED)


def stream_of(blocks: list[str]) -> list[str]:
    """The token stream of a page: words, with a mark after each block."""
    return [t for b in blocks for t in (*b.split(" "), _BLOCK)]


def _starts(tokens: list[str], min_run: int) -> list[int]:
    """Hash of the first ``min_run`` tokens of each suffix that has so many."""
    data = [t.encode("utf-8", "surrogatepass") for t in tokens]
    return [xxhash.xxh64_intdigest(b" ".join(data[i:i + min_run])) - (1 << 63) for i in range(len(data) - min_run + 1)]


def _covered(tokens: list[str], at: list[int], min_run: int) -> np.ndarray:
    """Whether a repeated run that starts at one of ``at`` covers each token."""
    edges = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(edges, np.array(at, np.int64), 1)
    np.add.at(edges, np.minimum(np.array(at, np.int64) + min_run, len(tokens)), -1)
    return np.cumsum(edges)[:-1] > 0


def remove_runs(blocks: list[str], at: list[int], firm: list[bool], min_run: int) -> str:
    """The blocks without the tokens that the repeated starts ``at`` cover; of a near copy, only the firm ones."""
    tokens = stream_of(blocks)
    covered = _covered(tokens, at, min_run)
    if is_near(tokens, covered):
        covered = _covered(tokens, [a for a, f in zip(at, firm) if f], min_run)
    return " ".join(t for t, c in zip(tokens, covered.tolist()) if not c and t != _BLOCK)


def is_near(tokens: list[str], covered: np.ndarray) -> bool:
    words = np.array([t != _BLOCK for t in tokens], bool)
    return bool((covered & words).sum() > NEAR * words.sum())


_SUFFIXES = T.StructType([T.StructField("host", T.StringType()), T.StructField("content", T.LongType()),
                          T.StructField("start", T.LongType()), T.StructField("at", T.IntegerType())])


def decided_starts(parsed: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(host, content, start, beside): the runs of articles, and those beside any text, on hosts with open pages."""
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("content", T.LongType()),
                           T.StructField("start", T.LongType()), T.StructField("beside", T.BooleanType())])

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("host", "content", "known", "open", "beside")
        for batch in batches:
            for host, content, known, own, beside in zip(*(batch.column(c).to_pylist() for c in names)):
                for blocks, aside in ((own if known else [], False), (beside, True)):
                    starts = set(_starts(stream_of(blocks), min_run))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host] * len(starts), pa.string()), pa.array([content] * len(starts), pa.int64()),
                         pa.array(starts, pa.int64()), pa.array([aside] * len(starts), pa.bool_())], names=schema.names)

    hosts = via_table(parsed.where(~F.col("known")).select("host").distinct(), "html-open-hosts")
    rows = parsed.where(F.col("known") | (F.size("beside") > 0)).select("host", "content", "known", "open", "beside")
    return map_arrow(rows.join(hosts, "host").select(*rows.columns), suffixes, schema)


def repeated_starts(streams: DataFrame, min_run: int = MIN_RUN, min_pages: int = MIN_PAGES,
                    decided: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """(host, content, at, firm): places in distinct page contents where a repeated run of ``min_run`` tokens starts;
    ``firm`` if near copies lose it too.  ``decided`` (see ``decided_starts``) counts, too; ``pages`` are the (host, content)
    of all pages, those of the streams by default."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, content, blocks in zip(*(batch.column(c).to_pylist() for c in ("host", "content", "open"))):
                starts = _starts(stream_of(blocks), min_run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(starts), pa.string()), pa.array([content] * len(starts), pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(range(len(starts)), pa.int32())], names=_SUFFIXES.names)

    table = via_table(map_arrow(streams.select("host", "content", "open"), suffixes, _SUFFIXES), "suffixes")
    # a start counts once a page; sums leave each task once a start
    once = table.select("host", "start", "content").distinct()
    if decided is not None:
        # only starts that open text has, too, are of use
        decided = via_table(decided.join(table.select("host", "start").distinct(), ["host", "start"], "left_semi").distinct(),
                            "suffixes-decided")
        once = once.unionByName(decided.select("host", "start", "content")).distinct()
    shared = (once.groupBy("host", "start").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
              .select("host", "start", "n"))
    places = via_table(table.join(via_table(shared, "suffixes-shared"), ["host", "start"]), "suffixes-places")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = []
            for blocks, at in zip(batch.column("open").to_pylist(), batch.column("at").to_pylist()):
                tokens = stream_of(blocks)
                kinds.append(is_near(tokens, _covered(tokens, at, min_run)))
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("content"), pa.array(kinds, pa.bool_())],
                                             names=["host", "content", "near"])

    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("content", T.LongType()),
                           T.StructField("near", T.BooleanType())])
    # a list of places is as long as its page's stream at most
    lists = places.groupBy("host", "content").agg(F.collect_list("at").alias("at"))
    kinds = via_table(map_arrow(streams.join(lists, ["host", "content"]).select("host", "content", "open", "at"), near, schema),
                      "suffixes-kinds")
    sizes = (streams if pages is None else pages.distinct()).groupBy("host").agg(F.count("*").alias("pages"))
    own = (places.select("host", "start", "content", "n").distinct().join(kinds, ["host", "content"])
           .groupBy("host", "start").agg(F.max("n").alias("n"), F.bool_or(~F.col("near")).alias("other")))
    firm = own.join(sizes, "host").select("host", "start", (F.col("other") | (
        (F.col("n") >= 3) & (2 * F.col("n") >= F.col("pages")))).alias("firm"))
    if decided is not None:
        aside = decided.where("beside").select("host", "start").distinct().withColumn("aside", F.lit(True))
        firm = firm.join(aside, ["host", "start"], "left").select(
            "host", "start", (F.col("firm") | F.coalesce("aside", F.lit(False))).alias("firm"))
    return places.join(via_table(firm, "suffixes-firm"), ["host", "start"]).select("host", "content", "at", "firm")


def host_notices(parsed: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(host, notices): hashes of the runs that at least half of a host's distinct pages, and three, have beside the article.

    A page has each run once, so the lists of a host hold at most twice the mean number of runs beside its articles.
    """
    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("content", T.LongType()),
                           T.StructField("start", T.LongType())])

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, content, blocks in zip(*(batch.column(c).to_pylist() for c in ("host", "content", "beside"))):
                starts = set(_starts(stream_of(blocks), min_run))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(starts), pa.string()), pa.array([content] * len(starts), pa.int64()),
                     pa.array(starts, pa.int64())], names=schema.names)

    sizes = parsed.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages")).where("pages >= 3")
    # hosts of fewer pages have no notices
    large = via_table(sizes, "html-hosts")
    rows = parsed.where(F.size("beside") > 0).select("host", "content", "beside").join(large.select("host"), "host")
    seen = map_arrow(rows, suffixes, schema).distinct().groupBy("host", "start").agg(F.count("*").alias("n"))
    return (seen.where("n >= 3").join(large, "host").where(2 * F.col("n") >= F.col("pages"))
            .groupBy("host").agg(F.collect_list("start").alias("notices")))


def without_notices(blocks: list[str], notices: set[int], min_run: int) -> list[str]:
    """The blocks of an article without those that the host's notices cover whole; all, if they cover most of its words."""
    tokens = stream_of(blocks)
    covered = _covered(tokens, [i for i, start in enumerate(_starts(tokens, min_run)) if start in notices], min_run)
    if is_near(tokens, covered):
        return blocks
    kept, at = [], 0
    for block in blocks:
        end = at + block.count(" ") + 1
        if not covered[at:end].all():
            kept.append(block)
        at = end + 1  # the block mark
    return kept


def main_text(pages: DataFrame, min_run: int = MIN_RUN, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for every row.

    text: the article of the whole page with its blocks joined by one space;
    empty for a null or empty page or one without text.  Pages of equal open
    content are one page when repeats are counted, and near copies keep what only
    they have, so copies don't delete each other.  A page is read whole, however
    long.  A null address belongs to the host with the empty name.
    Every row has its result, repeated or not; an empty table gives no rows;
    other columns are not read.
    """
    parsed = via_table(_parse(pages), "html-parsed")
    open_pages = parsed.where(~F.col("known"))
    streams = via_table(open_pages.groupBy("host", "content").agg(F.first("open").alias("open")), "html-streams")
    found = repeated_starts(streams, min_run, min_pages, decided_starts(parsed, min_run), parsed.select("host", "content"))
    places = found.groupBy("host", "content").agg(
        F.collect_list(F.struct("at", "firm")).alias("runs"))
    places = places.select("host", "content", F.col("runs.at").alias("at"), F.col("runs.firm").alias("firm"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [remove_runs(b, a or [], f or [], min_run) for b, a, f in
                     zip(*(batch.column(c).to_pylist() for c in ("open", "at", "firm")))]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("content"),
                                              pa.array(texts, pa.string())], names=["host", "content", "cut"])

    schema = T.StructType([T.StructField("host", T.StringType()), T.StructField("content", T.LongType()),
                           T.StructField("cut", T.StringType())])
    # a list of places is as long as its page's stream at most
    cuts = via_table(map_arrow(streams.join(places, ["host", "content"], "left"), cut, schema), "html-cuts")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [" ".join(without_notices(b, set(n), min_run) if n else b) for b, n in
                     zip(*(batch.column(c).to_pylist() for c in ("open", "notices")))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    result = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                           T.StructField("text", T.StringType())])
    notices = via_table(host_notices(parsed, min_run), "html-notices")
    known = parsed.where("known").select("page_id", "url", "host", "open").join(notices, "host", "left")
    decided = map_arrow(known.select("page_id", "url", "open", "notices"), strip, result)
    opened = open_pages.join(cuts, ["host", "content"]).select("page_id", "url", F.col("cut").alias("text"))
    return decided.unionAll(opened).withColumn("n_chars", F.length("text").cast("long"))
