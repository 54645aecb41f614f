import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tessera.llm import simhash as S


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fp -> smallest fp reachable."""
    fps = np.array(sorted(set(fps)), np.uint64)
    root = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    while True:
        new = np.array([root[near[i]].min() for i in range(len(fps))])
        if (new == root).all():
            return {int(f): int(fps[r]) for f, r in zip(fps, root)}
        root = new


def test_golay_table_is_perfect():
    index = S.golay_index()
    assert (np.bincount(index, minlength=4096) == 2048).all()
    words = np.random.default_rng(0).integers(0, 1 << 23, 200)
    for a in range(23):
        assert len(np.intersect1d(S.segment_keys(words, 23)[0], S.segment_keys(words ^ (1 << a), 23)[0])) > 0


def test_all_links_share_a_key():
    rng = np.random.default_rng(1)
    for k in range(5):
        x = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        y = x.copy()
        for i in range(300):
            for b in rng.choice(64, k, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        (wx, kx), (wy, ky) = S.fuzzy_keys(x), S.fuzzy_keys(y)
        for i in range(300):
            assert set(kx[wx == i].tolist()) & set(ky[wy == i].tolist())


@pytest.mark.parametrize("full", [1, 3, 32])
def test_components_of_dense_and_sparse_places(spark, full):
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    cloud = [int(fps[0]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in range(80)]
    chain = [int(fps[1])]
    for i in range(10):
        chain.append(chain[-1] ^ sum(1 << b for b in range(6 * i, 6 * i + 4)))
    every = sorted({*map(int, fps), *cloud, *chain})
    as_long = [int(np.uint64(f).view(np.int64)) for f in every]
    df = spark.createDataFrame([(f,) for f in as_long], "fp long")
    found = S.connected(S.fingerprint_links(df, full)).collect()
    got = {r["node"]: r["root"] for r in found}
    want = brute_components(every)
    for a, b in combinations(every, 2):
        la, lb = (int(np.uint64(x).view(np.int64)) for x in (a, b))
        assert (want[a] == want[b]) == (got.get(la, la) == got.get(lb, lb))


def test_bucket_runs_across_batches():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 40, 600))
    fps = rng.permutation(600)
    want, dense = set(), set()
    for k in np.unique(keys):
        run = fps[keys == k]
        if len(run) > S.MAX_BUCKET:
            dense |= set(run.tolist())
        else:
            want |= {(min(a, b), max(a, b)) for a, b in combinations(run.tolist(), 2) if bin(a ^ b).count("1") <= 4}
    for size in (1, 7, 40, 600):
        out = S._bucket_links(iter([pa.RecordBatch.from_arrays(
            [pa.array(keys[i:i + size]), pa.array(fps[i:i + size])], names=["key", "fp"]) for i in range(0, 600, size)]), S.MAX_BUCKET)
        rows = {(r["a"], r["b"]) for b in out for r in b.to_pylist()}
        assert {r for r in rows if r[0] != r[1]} == want and {a for a, b in rows if a == b} == dense


def test_documents_against_brute_force(documents):
    src = [(r["doc_id"], r["text"]) for r in documents.collect()]
    prints = {i: brute_print(t) for i, t in src}
    comp = brute_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[comp[f]] = min(i, least.get(comp[f], i))
    rows = S.simhash_components(documents).collect()
    assert len(rows) == len(src)
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == least[comp[prints[r["doc_id"]]]]
    kept = {r["doc_id"] for r in S.drop_near_duplicates(documents).collect()}
    assert kept == set(least.values())


def test_nulls_repeats_empty_and_long(make_docs):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(5, None), (7, ""), (6, " \n\t"), (1, "a b c d e"), (1, "a b c d e"), (9, "A B c D e"), (None, "x y"),
            (None, "x y"), (2, long), (3, long + " w30000")]
    got = S.simhash_components(make_docs(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert len(got) == len(rows)
    assert by == {5: {5}, 7: {5}, 6: {5}, 1: {1}, 9: {1}, None: {None}, 2: {2}, 3: {2}}
    kept = [r["doc_id"] for r in S.drop_near_duplicates(make_docs(rows)).collect()]
    assert sorted(kept, key=str) == [1, 2, 5, None]
    assert S.simhash_components(make_docs([])).count() == 0
    assert S.drop_near_duplicates(make_docs([])).count() == 0
