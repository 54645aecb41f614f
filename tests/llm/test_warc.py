import gzip
import hashlib
import os

import pytest

from tessera.llm import warc as W


def brute(rows):
    data = [(p, (h or "").encode()) for p, h in rows]
    out = []
    for p, x in data:
        same = [q for q, y in data if y == x and q is not None]
        top = max(same, default=None)
        again = len(x) >= 1000 and top is not None and (p is None or p < top)
        out.append((p, len(x), hashlib.sha1(x).hexdigest(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(p, f"http://x/{p}", h) for p, h in rows], "page_id long, url string, html string")
    return sorted((tuple(r) for r in W.archive_round_trip(df).collect()), key=str)


def test_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert sorted((tuple(r) for r in W.archive_round_trip(pages).collect()), key=str) == brute(rows)


def test_breaks_nulls_ties_and_long_payloads(spark):
    tricky = ["\r\n\r\n", "a\r\n", "a\r\n\r", "\r\n\r\n\r\n\r\nx", "\r\n\r\r\n\r\n\r\n\r", "WARC/1.1\r\nContent-Length: 3\r\n\r\n", "é\0\n",
              None, "", "x" * 1000, "x" * 1000, "x" * 999, "x" * 999, "\r\n" * 3_000_000]
    rows = list(enumerate(tricky)) + [(9, "x" * 1000), (None, "x" * 1000), (None, "y" * 2000), (None, "y" * 2000), (3, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_files_and_sidecar(spark, tmp_path):
    rows = [(i, f"u{i}\nv", ("page %d " % i) * (i + 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    W.write_archives(df, src)
    index = W.normalise(spark, src, dst)
    got = {r["page_id"]: r for r in W.read_records(index).collect()}
    assert {k: r["payload"].decode() for k, r in got.items()} == {i: h for i, _, h in rows}
    assert got[3]["url"] == "u3%20v"
    archives = [f for f in os.listdir(dst) if f.endswith(".warc.gz")]
    whole = sorted(gzip.open(f"{src}/{f}").read() for f in os.listdir(src) if f.endswith(".gz"))
    assert sorted(gzip.open(f"{dst}/{f}").read() for f in archives) == [x for x in whole if x]
    for f in archives:
        raw = open(f"{dst}/{f}", "rb").read()
        end = 0
        for line in open(f"{dst}/{f}.idx"):
            at, n, rid, kind = line.rstrip("\n").split("\t")
            assert int(at) == end and gzip.decompress(raw[end:end + int(n)]).startswith(b"WARC/1.1") and kind == "response"
            end += int(n)
        assert end == len(raw)


def test_cut_off_archive(spark, tmp_path):
    os.makedirs(f"{tmp_path}/src")
    with gzip.open(f"{tmp_path}/src/a.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nContent-Length: 90\r\n\r\nshort")
    with pytest.raises(Exception, match="cut off"):
        W.normalise(spark, f"{tmp_path}/src", f"{tmp_path}/dst")


@pytest.mark.parametrize("lost", range(0, 13))
def test_archives_that_lost_their_last_bytes(spark, tmp_path, lost):
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 39\r\n\r\nHTTP/1.1 200 OK\r\n\r\nABCDEFGHIJKLMNOPQRST\r\n\r\n"
    whole = record * 3
    os.makedirs(f"{tmp_path}/src")
    with gzip.open(f"{tmp_path}/src/a.gz", "wb") as f:
        f.write(whole[:len(whole) - lost])
    if lost:
        with pytest.raises(Exception, match="cut off"):
            W.normalise(spark, f"{tmp_path}/src", f"{tmp_path}/dst")
    else:
        got = W.read_records(W.normalise(spark, f"{tmp_path}/src", f"{tmp_path}/dst")).collect()
        assert [bytes(r["payload"]) for r in got] == [b"ABCDEFGHIJKLMNOPQRST"] * 3


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_pieces_of_any_size(size):
    blocks = [b"", b"x", b"\r\n\r\n", b"WARC/1.1\r\n\r\n", b"y" * 300]
    data = b"".join(b"WARC/1.1\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(b), b) for b in blocks)
    stream = W.RecordStream("a")
    assert [b for i in range(0, len(data), size) for _, b in stream.feed(data[i:i + size])] == blocks
    stream.end()


def test_wrong_digest_or_length(spark, tmp_path):
    sha = "sha1:" + "0" * 40
    for name, record in (("d", f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: {sha}\r\nContent-Length: 5\r\n\r\nA\r\n\r\n\r\n\r\n"),
                         ("l", "WARC/1.1\r\nContent-Length: 2\r\n\r\nABCD\r\n\r\n")):
        os.makedirs(f"{tmp_path}/{name}")
        with gzip.open(f"{tmp_path}/{name}/a.gz", "wb") as f:
            f.write(record.encode())
        with pytest.raises(Exception, match="states|than it says"):
            W.read_records(W.normalise(spark, f"{tmp_path}/{name}", f"{tmp_path}/{name}-out")).collect()
    assert W._digest_fits("sha1:" + "2jmj7l5rSW0yVb/vlWAYkK/YBwk=", "x" * 0 + "00" * 20) is False
    assert W._digest_fits("sha1:AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "00" * 20) and W._digest_fits("md5:1", "00" * 20)
