import math
import re
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import quality as Q


def brute_stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = defaultdict(list)
    for k in range(len(w) - 2):
        where[tuple(w[k:k + 3])].append(k)
    cover = {k + i for v in where.values() if len(v) > 1 for k in v for i in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover),
            len(lines))


def vector(s):
    n, chars, sym, dup, rep, lines = s
    n = max(n, 1)
    return [math.log(max(chars, 1) / n), math.sqrt(sym / n), math.sqrt(dup / max(lines, 1)), math.sqrt(rep / n)]


FLOOR = np.diag([s * s for _, s in Q.STATISTICS])


def cut_half(d):
    b = np.floor(np.log(d + 1e-9) * 200)
    return b <= np.sort(b)[math.ceil(Q.HALF * len(b)) - 1]


def brute_mcd(x):
    g = lambda v: np.sort(np.floor(v * 1000 + 0.5))[math.ceil(len(v) / 2) - 1] / 1000
    med = np.array([g(c) for c in x.T])
    mad = np.array([g(np.abs(c - m)) for c, m in zip(x.T, med)]) * 1.4826
    z = (x - med) ** 2 / (mad ** 2 + np.diag(FLOOR))
    fits = []
    for d in (z.sum(1), z.max(1)):
        for _ in range(Q.C_STEPS + 1):
            near = x[cut_half(d)]
            m = near.mean(0)
            s = np.cov(near.T, bias=True) * Q.CONSISTENCY + FLOOR
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
        fits.append((np.linalg.slogdet(s)[1], m, s))
    return min(fits, key=lambda f: f[0])


def brute(rows, min_group=Q.MIN_GROUP):
    stats = [brute_stats(t) for _, t, _, _ in rows]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    groups = defaultdict(list)
    for (_, _, lang, source), s, bad in zip(rows, stats, failed):
        if not bad:
            for key in ((2, lang, source), (1, lang, None), (0, None, None)):
                groups[key].append(vector(s))
    fit = {k: brute_mcd(np.array(v)) for k, v in groups.items() if len(v) >= min_group}
    out = []
    for (i, _, lang, source), s, bad in zip(rows, stats, failed):
        f = next((fit[k] for k in ((2, lang, source), (1, lang, None), (0, None, None)) if k in fit), None)
        d = 0.0
        if f is not None:
            x = np.array(vector(s)) - f[1]
            d = x @ np.linalg.inv(f[2]) @ x
        out.append((i, *s[:5], bad, not bad and d <= Q.chi2_quantile(Q.CUT, 4), d))
    return out


def test_chi2():
    assert Q.chi2_quantile(0.95, 4) == pytest.approx(9.487729, abs=1e-5)
    assert Q.chi2_cdf(5.0, 6) == pytest.approx(0.4561869, abs=1e-6)


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    want = {r[0]: r for r in brute(rows)}
    got = Q.judge_documents(docs).collect()
    assert len(got) == len(rows)
    for g in got:
        w = want[g["doc_id"]]
        assert tuple(g)[:7] == w[:7]
        if abs(w[8] - Q.chi2_quantile(Q.CUT, 4)) > 1e-6:
            assert g["kept"] == w[7], (tuple(g), w)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    kept = {g["doc_id"]: g["kept"] for g in got}
    passed = {g["doc_id"] for g in got if not g["base_failed"]}
    good = [kept[r["doc_id"]] for r in labels if r["quality"] == 1 and r["doc_id"] in passed]
    junk = [kept[r["doc_id"]] for r in labels if r["quality"] == 0 and r["doc_id"] in passed]
    assert np.mean(good) > 0.99 and np.mean(junk) < 0.05
    stage = Q.keep_good(docs)
    assert stage.columns == docs.columns
    assert sorted(r["doc_id"] for r in stage.collect()) == sorted(i for i, k in kept.items() if k)


def test_native_plan(spark, documents):
    text = Q.judge_documents(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_edges(spark, make_docs):
    rep = "a b c " * 100
    rows = [(1, None), (2, ""), (None, " \n\t "), (3, rep, "en"), (3, rep, "en"), (4, "a\n\na\n \nb\r\nb\r\n\x0bb", None, "s"),
            (5, "é# $x|<> 𝔘", "fr", "s"), (6, "w" * 500_000), (7, " ".join(f"w{i}" for i in range(30_000)))]
    df = make_docs(rows).withColumn("stats", Q.F.lit(1)).withColumn("Kept", Q.F.lit(1)).withColumn("a.b", Q.F.lit(1))
    full = [(r + (None,) * 4)[:4] for r in rows]
    key = lambda r: str(tuple(r)[:8])
    assert sorted((tuple(g) for g in Q.judge_documents(df).collect()), key=key) == sorted((r[:8] for r in brute(full)), key=key)
    stage = Q.keep_good(df)
    assert stage.columns == df.columns and [r["doc_id"] for r in stage.collect()] == [7]
    assert Q.judge_documents(make_docs([])).count() == 0 and Q.keep_good(make_docs([])).count() == 0


def test_windows_that_overlap(make_docs):
    texts = ["x x x x", "a b c a b c", "a b a b a b a", "a b c d a b c e b c d", "x x x", "x x", "a b c x y z c a b c"]
    df = make_docs(list(enumerate(texts)))
    got = {r["doc_id"]: r["n_repeat_words"] for r in Q.judge_documents(df).collect()}
    assert got == {i: brute_stats(t)[4] for i, t in enumerate(texts)}
