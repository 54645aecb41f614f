"""Token groups, links and counts against plain loops over bytes."""

import hashlib
import random

import numpy as np
import pytest

from tessera.llm.pieces import default_model
from tessera.llm.token_alignment import (Aligner, ByteTokens, PieceTokens, align_documents, align_texts,
                                         default_bytes, jump, overlaps)

TEXTS = [None, "", " ", "a", "Hello world", "  two  spaces\n\n and\ttabs ", "naïve café — “quoted”", "日本語のテキスト",
         "<|endoftext|> is text", "<s> </s> <unk> <0x41>", "a mark ▁ inside", "emoji 👩‍👩‍👧 family", "́ alone",
         "x" * 300, "1234567890 12.5%", "don't can't won't", "\r\n\r\n", " nbsp", "Ⅷ ﬁ ½", "tail \n"]


@pytest.fixture(scope="module")
def sides():
    return ByteTokens(default_bytes()), PieceTokens(default_model())


def brute(texts, a, b):
    """Rows without doc_id, from byte positions one by one."""
    docs = []
    for t in texts:
        ta, tb = ([], []) if not t else (a.ids([t])[0], b.ids([t])[0])
        data = b" " + (t or "").encode()
        if not t or b"".join(a.bytes[i] for i in ta) != data or b"".join(b.bytes[i] for i in tb) != data:
            docs.append(([], [], [], []))
            continue
        ranges = []
        for ids, table in ((ta, a.bytes), (tb, b.bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i])))
                at += len(table[i])
            ranges.append(out)
        links = [(x, y) for x, (s, e) in zip(ta, ranges[0]) for y, (u, v) in zip(tb, ranges[1]) if s < v and u < e]
        groups, ga, gb = [], [], []
        ends = {e for _, e in ranges[0]} & {e for _, e in ranges[1]}
        for e in sorted(ends):
            ga = [i for i, r in zip(ta, ranges[0]) if r[1] <= e][sum(len(g[0]) for g in groups):]
            gb = [i for i, r in zip(tb, ranges[1]) if r[1] <= e][sum(len(g[1]) for g in groups):]
            groups.append((ga, gb))
        docs.append((ta, tb, groups, links))
    counts = {}
    for *_, links in docs:
        for p in set(links):
            counts[p] = counts.get(p, 0) + 1
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(n, top.get(x, 0))
    rows = []
    for ta, tb, groups, links in docs:
        line = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append((len(ta), len(tb), len(groups), len(links), sum(counts[p] == top[p[0]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return rows


@pytest.mark.parametrize("head", [0, 7, 1 << 18])
def test_texts_of_all_kinds(make_docs, sides, head):
    texts = TEXTS + TEXTS[3:8]
    got = {r[0]: tuple(r[1:]) for r in align_documents(make_docs(list(enumerate(texts))), head=head).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, *sides)


def test_ranks_give_the_ids_of_the_file(sides, documents):
    """Every code point in four surroundings, all short texts of the table, long runs."""
    assert sides[0].ranks
    points = [chr(c) for c in [*range(0x3000), *range(0x3000, 0xD800, 7), *range(0xE000, 0x110000, 61)]]
    texts = [shape.replace("%s", c) for c in points for shape in ("a%sb 1%s2 .%s, %s%s \n%s x%s", "%s %sa%s1%s.%s'%ss")]
    texts += [r["text"] for r in documents.collect() if r["text"]][:300] + [c * 50_000 for c in "x ^\n"]
    assert sides[0].ids(texts) == sides[0].file_ids(texts)


def test_table(documents, sides):
    rows = documents.select("doc_id", "text").collect()
    got = {r[0]: tuple(r[1:]) for r in align_documents(documents, head=500).collect()}
    assert len(got) == len(rows)
    short = [r for r in rows]
    expected = brute([r["text"] for r in short], *sides) if sum(len(r["text"] or "") for r in short) < 200_000 else None
    if expected is None:  # quadratic in a text's tokens: groups and links of the short ones, counts from all
        short = [r for r in rows if len(r["text"] or "") < 2000]
        expected = brute([r["text"] for r in short], *sides)
        assert [got[r["doc_id"]][:4] + got[r["doc_id"]][6:] for r in short] == [e[:4] + e[6:] for e in expected]
    else:
        assert [got[r["doc_id"]] for r in short] == expected


def test_pointers_against_components():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 40)
        cut = [np.array(sorted(rng.sample(range(1, n), rng.randrange(n)) + [n])) for _ in range(2)]
        la, lb = jump(*cut)
        common = sorted(set(cut[0].tolist()) & set(cut[1].tolist()))
        last = {e: int(np.searchsorted(cut[0], e)) for e in common}
        for ends, labels in zip(cut, (la, lb)):
            assert [last[min(c for c in common if c >= e)] for e in ends.tolist()] == labels.tolist()
        a, b = overlaps(*cut)
        s, t = (np.concatenate([[0], c[:-1]]) for c in cut)
        assert list(zip(a.tolist(), b.tolist())) == [(i, j) for i in range(len(cut[0])) for j in range(len(cut[1]))
                                                     if s[i] < cut[1][j] and t[j] < cut[0][i]]


def test_a_long_chain_takes_few_doublings():
    n = 200_000
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    assert (jump(a, b)[0] == n - 1).all()


def test_groups_text(make_docs, sides):
    aligner = Aligner(default_bytes(), default_model())
    x = aligner.align(["Hello world"])
    line = aligner.group_texts(x)[0]
    assert [bytes().join(sides[0].bytes[int(i)] for i in g.split("|")[0].split(",")) for g in line.split(";")] == \
        [bytes().join(sides[1].bytes[int(i)] for i in g.split("|")[1].split(",")) for g in line.split(";")]
    out = align_texts(make_docs([(1, "Hello world")]), "text", ["doc_id"], default_bytes(), default_model(), True)
    assert out.first()["groups"] == line


def test_empty_table_repeats_and_clashing_columns(spark, make_docs):
    assert align_documents(make_docs([])).collect() == []
    df = spark.createDataFrame([(1, "same text", 1, "x"), (1, "same text", 2, "y"), (None, "other", 3, "z")],
                               "doc_id long, text string, pairs int, `row` string")
    rows = sorted((tuple(r) for r in align_documents(df).collect()), key=str)
    assert len(rows) == 3 and rows[0] == rows[1] and rows[2][0] is None
