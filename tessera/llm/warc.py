"""WARC archives: writing, the monolithic gzip normaliser, reading by offset.

``write_archives`` lets Spark's text writer produce ordinary whole-file gzip
WARC archives (CR LF CR LF, which must follow each record, is the line
separator), one per partition, on any file system that Spark knows.

``normalise`` is for archives that were compressed as one stream, where no
record can be reached without inflating all before it.  Spark's text reader
inflates each file once, as a stream cut at CR LF CR LF; the pieces in order
are the stream itself again, so memory holds one record, never a file.  Each
record is rewritten as a gzip member of its own and its place goes to an
offset index: a sidecar file beside every archive, and a table.

Tasks write archives under names of their own attempt.  Only archives named
in the finished index table count, so retried and speculative tasks and lost
executors do no harm.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_arrow, scratch_path, via_table

BREAK = "\r\n\r\n"
MIN_REVISIT_BYTES = 1000
#: Bytes of an archive that are inflated at a time.
PIECE_BYTES = 1 << 20
_PAGE_URN = "urn:page:"

INDEX = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("record_id", T.StringType()),
    T.StructField("record_type", T.StringType())])

RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


# --- records ----------------------------------------------------------------

def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): the page that holds an equal payload, or null.

    Of rows with equal payloads of at least ``min_bytes`` those with the
    largest page_id hold it; a null page_id counts as the smallest.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("digest"),
                        F.octet_length(html).cast("long").alias("bytes"))
    # sums leave each task once a payload; as a table its size decides how it is joined
    holders = via_table(rows.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
                        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
                        .where("n > 1 and holder is not null").drop("n"), "warc-holders")
    older = F.col("page_id").isNull() | (F.col("page_id") < F.col("holder"))
    return rows.join(holders, ["digest", "bytes"], "left").select(
        "page_id", "url", "html", "digest", "bytes", F.when(older, F.col("holder")).alias("refers_to"))


def _record(rows: DataFrame) -> Column:
    """The text of a WARC record without the break that ends it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(BREAK))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page = lambda c: F.concat(F.lit(f"<{_PAGE_URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    # a header value can't hold control characters; null has no header at all
    url = F.regexp_replace("url", r"[\x00-\x1F\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page(F.col("page_id"))),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", page(F.col("refers_to"))))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        block_bytes.cast("string"), F.lit(BREAK), http, F.when(revisit, F.lit("")).otherwise(F.col("html")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row of (page_id, url, html) to whole-file gzip archives below ``path``."""
    rows = with_revisits(pages, min_bytes)
    (rows.select(_record(rows).alias("value")).write.option("lineSep", BREAK)
     .option("compression", "gzip").text(path))


# --- streams ----------------------------------------------------------------

class RecordStream:
    """Cuts a byte stream into (header, block) by Content-Length; holds one record and one piece.

    A block must be followed by two line ends; more between records are passed over.
    """

    def __init__(self, name: str):
        self.name, self.held, self.size = name, [], 0
        self.header, self.need = None, 0

    def feed(self, data: bytes) -> Iterator[tuple[bytes, bytes]]:
        self.held.append(data)
        self.size += len(data)
        mark = BREAK.encode()
        if self.header is not None and self.size < self.need + len(mark):
            return
        data, at = b"".join(self.held), 0
        while True:
            if self.header is None:
                while data[at:at + 1] in (b"\r", b"\n"):
                    at += 1
                if not b"WARC/".startswith(data[at:at + 5]):
                    raise ValueError(f"no WARC record at this place of {self.name}: {data[at:at + 40]!r}")
                end = data.find(mark, at)
                if end < 0:
                    break
                self.header = data[at:end]
                self.need = int(headers(self.header)["content-length"])
                at = end + len(mark)
            end = at + self.need
            if len(data) < end + len(mark):
                break
            if data[end:end + len(mark)] != mark:
                raise ValueError(f"a record of {self.name} is longer or shorter than it says")
            yield self.header, data[at:end]
            self.header, at = None, end + len(mark)
        self.held = [data[at:]]
        self.size = len(data) - at

    def end(self) -> None:
        if self.header is not None or b"".join(self.held).strip():
            raise ValueError(f"the last record of {self.name} is cut off")


def headers(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _inflated(uri: str) -> Iterator[bytes]:
    """The content of a file in pieces; one that ends in .gz is inflated, whatever members it has."""
    files, path = _file_system(uri)
    with files.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as stream:
        while piece := stream.read(PIECE_BYTES):
            yield piece


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite the archives below ``source`` with a gzip member per record.

    Writes ``<name>.warc.gz`` and its sidecar ``<name>.warc.gz.idx`` (offset,
    length, record id and type, tab-separated) below ``target``, a URI of a
    file system that tasks and Spark share.  Returns the index as a table
    (INDEX), which is also kept below ``target``/index.  No archives give an
    empty index; a source that isn't a whole record at its end raises.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(target)
        for batch in batches:
            for source_file in batch.column("file").to_pylist():
                own = f"{uuid.uuid4().hex}.warc.gz"
                files.create_dir(root, recursive=True)
                stream, at = RecordStream(source_file), 0
                with files.open_output_stream(f"{root}/{own}", compression=None) as out, \
                        files.open_output_stream(f"{root}/{own}.idx", compression=None) as sidecar:
                    for piece in _inflated(source_file):
                        rows = []
                        for head, block in stream.feed(piece):
                            pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                            member = b"".join([pack.compress(head + BREAK.encode()), pack.compress(block),
                                               pack.compress(BREAK.encode()), pack.flush()])
                            out.write(member)
                            h = headers(head)
                            place = (at, len(member), h.get("warc-record-id"), h.get("warc-type"))
                            sidecar.write(("\t".join(map(str, place)) + "\n").encode())
                            rows.append((f"{target}/{own}", *place))
                            at += len(member)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[i] for r in rows], t) for i, t in
                             enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=INDEX.names)
                    stream.end()

    # only the names are read here; an archive is one stream and goes to one task
    pieces = spark.read.format("binaryFile").load(source).select(F.col("path").alias("file"))
    map_arrow(pieces, rewrite, INDEX).write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


def _digest_fits(stated: str, sha1: str) -> bool:
    """Whether a stated digest (SHA-1 in hex or base 32; others are not checked) is that of the payload."""
    kind, _, value = stated.lower().partition(":")
    return kind != "sha1" or value in (sha1, base64.b32encode(bytes.fromhex(sha1)).decode().lower())


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Fetch the members that the index names and parse them (RECORDS).

    A record that has not the length or the payload digest that it states raises.
    Digest and size of a response are those of the payload as read; a revisit
    has no payload of its own and states them in its headers.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != name:
                    files, path = _file_system(archive)
                    name, handle = archive, files.open_input_file(path)
                data = zlib.decompress(handle.read_at(length, offset), 31)
                head, _, block = data.partition(BREAK.encode())
                h = headers(head)
                if len(block) != int(h["content-length"]) + len(BREAK):
                    raise ValueError(f"the record at {offset} of {archive} has not the length that it states")
                http, _, payload = block[:-len(BREAK)].partition(BREAK.encode())
                page, refers = (_page(h.get(x)) for x in ("warc-record-id", "warc-refers-to"))
                kind = h["warc-type"]
                if kind == "revisit":
                    size, digest = int(headers(http)["content-length"]), h["warc-payload-digest"].partition(":")[2]
                else:
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    if not _digest_fits(h.get("warc-payload-digest", ""), digest):
                        raise ValueError(f"the record at {offset} of {archive} has not the payload that it states")
                rows.append((page, h.get("warc-target-uri"), kind, refers, size, digest,
                             payload if with_payload and kind != "revisit" else None))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=RECORDS.names)

    return map_arrow(index.select("archive", "offset", "length"), fetch, RECORDS)


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix(f"<{_PAGE_URN}").removesuffix(">")
    return int(digits) if digits else None


def archive_round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages to archives, normalise them, read them back: a row per page.

    (page_id, payload_bytes, payload_digest, record_type, refers_to).  A null
    html is an empty payload.  Rows of one page_id and payload are records of
    their own: those with the largest page_id are responses, all others with
    an equal payload of ``min_bytes`` or more revisit it; a null page_id counts as the
    smallest.  An empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    source, target = scratch_path(spark, "warc-streams"), scratch_path(spark, "warc-members")
    write_archives(pages, source, min_bytes)
    return read_records(normalise(spark, source, target), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
