import time
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm.sharding import (_draw_large, block_sizes, matrix_row, shard_report,
                                  shuffle_shards, split_counts)


def check_law(rows, n_shards):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(n_shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_report_on_documents(documents):
    src = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = shard_report(documents).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(src))
    check_law(rows, 8)
    for r in rows:
        data = (src[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(data) + 1, zlib.crc32(data), "rows", None)


def test_small_blocks_and_repeated_rows(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("id % 3 as k", "if(id % 5 = 0, null, 'x') as v")
    rows = shuffle_shards(df, 6, block_rows=10).collect()
    check_law(rows, 6)
    assert Counter((r["k"], r["v"]) for r in rows) == Counter((r["k"], r["v"]) for r in df.collect())


def test_nulls_empty_table_and_clashing_names(spark, make_docs):
    rows = shard_report(make_docs([(None, None), (1, ""), (1, ""), (2, "é" * 5000)])).collect()
    check_law(rows, 8)
    assert sorted(r["size"] for r in rows) == [1, 1, 1, 10001]
    assert shard_report(make_docs([])).count() == 0
    odd = spark.createDataFrame([(1, 2, 3)], "_origin int, _block int, `a.b` int")
    assert shuffle_shards(odd, 2).columns == ["_origin", "_block", "a.b", "shard", "slot"]
    with pytest.raises(ValueError):
        shuffle_shards(spark.createDataFrame([(1,)], "Slot int"), 2)


def test_matrix_has_exact_margins():
    counts = np.array([5, 0, 17, 30, 1], np.int64)
    _, _, sizes = block_sizes(int(counts.sum()), 4, 6)
    m = np.array([matrix_row(counts, sizes, p, 3) for p in range(5)])
    assert (m.sum(1) == counts).all() and (m.sum(0) == sizes).all() and (m >= 0).all()


def test_uniform(spark):
    """Each row lands in each shard about equally often over many seeds."""
    counts, sizes = np.array([4, 8], np.int64), np.array([6, 6], np.int64)
    got = np.mean([matrix_row(counts, sizes, 0, s)[0] for s in range(4000)])
    assert abs(got - 2.0) < 0.06  # mean 4 * 6 / 12, standard error 0.013
    var = np.var([matrix_row(counts, sizes, 0, s)[0] for s in range(4000)])
    assert abs(var - 4 * .5 * .5 * 8 / 11) < 0.06


def test_large_populations():
    rng = np.random.default_rng(1)
    draws = [_draw_large(rng, 3_000_000_000, 7_000_000_000, 1_000_000) for _ in range(400)]
    assert abs(np.mean(draws) - 300_000) < 150 and 350 < np.std(draws) < 570
    got = split_counts(rng, np.array([2_000_000_000, 5, 0, 1_000_000_000]), 1_500_000_000)
    assert got.sum() == 1_500_000_000 and got[1] <= 5


def test_large_populations_are_halved():
    """Few draws for any number of colors, exact margins, the right mean and spread."""
    rng = np.random.default_rng(4)
    colors = np.full(3000, 1_000_000)
    for take in (0, 1, 1_234_567_890, int(colors.sum()) - 1, int(colors.sum())):
        got = split_counts(rng, colors, take)
        assert got.sum() == take and (got >= 0).all() and (got <= colors).all()
    n, take = int(colors.sum()), 1_200_000_000
    got = split_counts(rng, colors, take)
    spread = np.sqrt(1_000_000 * 0.4 * 0.6 * (n - 1_000_000) / (n - 1))
    assert abs(got.mean() - 400_000) < 1e-6 and 0.93 < got.std() / spread < 1.07
    zeros = np.array([0, 0, 2_000_000_000, 0, 0])
    assert split_counts(rng, zeros, 7).tolist() == [0, 0, 7, 0, 0]


def test_task_row_of_ten_billion_rows_is_quick():
    counts = np.full(10_000, 1_000_000)
    _, _, sizes = block_sizes(int(counts.sum()), 8, 1 << 16)
    began = time.process_time()
    assert matrix_row(counts, sizes, 3333, 42).sum() == 1_000_000
    assert time.process_time() - began < 5
