"""Exact duplicates against grouping of the normalised texts in plain Python."""

import hashlib
import random
import re

import pytest

from tessera.llm.block_names import drop_exact_duplicates, exact_groups, mark_duplicates, name_documents


def brute(rows):
    """rows (doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for norm, held in groups.items():
        best = min(held)
        for h in held:
            out.append((rows[h[3]][0], rows[best[3]][0], len(held), h == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def check(make_docs, rows, **kw):
    marked = mark_duplicates(make_docs(rows), carry=["doc_id"], **kw)
    assert found(marked.select("carry.doc_id", "keep_id", "group_size", "kept", "text_sha256")) == brute(rows)


EDGES = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b "), (7, "ab"), (7, "ab"),
         (None, "ab"), (None, "lone"), (8, "a b"), (9, "é"), (10, "é"), (11, "x" * 64), (12, "x" * 65),
         (13, "x " * 64), (14, " z"), (15, "z")]


@pytest.mark.parametrize("size", [1, 3, 8, 4096])
def test_edges(make_docs, size):
    check(make_docs, EDGES, block_bytes=size)


@pytest.mark.parametrize("bits", [1, 5, 64])
def test_clashing_keys_are_told_apart(make_docs, bits):
    rng = random.Random(bits)
    words = ["".join(rng.choice("ab é\n") for _ in range(rng.randrange(60))) for _ in range(60)]
    check(make_docs, [(i, rng.choice(words)) for i in range(200)], block_bytes=4, key_bits=bits)


def test_one_differing_block(make_docs):
    base = "".join(chr(97 + i % 26) for i in range(5000))
    rows = [(0, base), (1, base)]
    rows += [(10 + i, base[:i * 700] + "#" + base[i * 700 + 1:]) for i in range(7)]
    rows += [(20, base[:-1]), (21, base + "a"), (22, base[4096:] + base[:4096]), (23, " ".join(base))]
    check(make_docs, rows, block_bytes=64)


def test_hot_group_and_order_of_rows(make_docs):
    rows = [(i, "copy of all" if i % 3 else f"own {i}") for i in range(300)]
    check(make_docs, rows, block_bytes=4)
    assert found(exact_groups(make_docs(rows[::-1]).repartition(5))) == brute(rows)


def test_identity_is_equal_only_for_equal_texts(make_docs):
    texts = ["aa" * n for n in range(1, 40)] * 2
    named = name_documents(make_docs(list(enumerate(texts))), block_bytes=2).collect()
    groups = {}
    for r in named:
        groups.setdefault((r["level"], r["name"]), set()).add(r["carry"]["text"])
    assert len(groups) == 39 and all(len(g) == 1 for g in groups.values())


def test_empty_table_and_clashing_columns(make_docs, spark):
    assert exact_groups(make_docs([])).collect() == []
    df = spark.createDataFrame([(1, "a", 5, 6, 7), (2, "a ", 8, 9, 10)],
                               "doc_id long, text string, name int, `level` int, `held.x` int")
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [(2, "a ", 8, 9, 10)]
