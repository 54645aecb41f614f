import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import langid as L


def brute(rows, texts):
    """Counts by plain loops, one text at a time."""
    counts, docs = defaultdict(Counter), Counter()
    for t, lang in rows:
        if t is None or lang is None:
            continue
        docs[lang] += 1
        for grams in L.gram_buckets([t], L.BUCKETS)[0]:
            counts[lang].update(grams.tolist())
    langs = sorted(docs)
    out = []
    for t in texts:
        if t is None or not any(c.isalpha() for c in t):
            out.append(("und", 0.0))
            continue
        joint = []
        for x in langs:
            total = sum(counts[x].values()) + L.SMOOTHING * L.BUCKETS
            s = np.log(docs[x] / sum(docs.values()))
            for grams in L.gram_buckets([t], L.BUCKETS)[0]:
                s += sum(np.log((counts[x][g] + L.SMOOTHING) / total) for g in grams.tolist())
            joint.append(s)
        joint = np.array(joint)
        out.append((langs[int(joint.argmax())], 1 / np.exp(joint - joint.max()).sum()))
    return out


def test_buckets_do_not_depend_on_the_batch():
    texts = ["Hello there", None, "", "Ñandú ß 12", "İstanbul"]
    for order in (0, 1):
        whole, ends = L.gram_buckets(texts, 1 << 14)
        parts = np.split(whole[order], ends[:-1])
        for t, p in zip(texts, parts):
            assert p.tolist() == L.gram_buckets([t], 1 << 14)[0][order].tolist()


def test_against_brute_force(documents):
    rows = documents.collect()
    fold = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}
    want = brute([(r["text"], r["lang"]) for r in rows if not fold[r["doc_id"]]], [r["text"] for r in rows])
    got = {r["doc_id"]: r for r in L.predict_documents(documents).collect()}
    right = []
    for r, (lang, score) in zip(rows, want):
        g = got[r["doc_id"]]
        assert g["held_out"] == fold[r["doc_id"]] and g["lang_pred"] == lang
        assert g["score"] == pytest.approx(score, abs=1e-3) and 0 <= g["score"] <= 1
        if fold[r["doc_id"]]:
            right.append(lang == r["lang"])
    assert np.mean(right) >= 0.95


def test_edges(spark, make_docs):
    rows = [(1, "the cat sat", "en"), (2, "der hund lief", "de"), (3, None, "en"), (4, "", "en"), (5, "12 34 !", None),
            (None, "the cat", "en"), (6, "the cat sat", None), (6, "the cat sat", None), (7, "x" * 200_000, "en")]
    got = L.predict_documents(make_docs(rows).withColumn("a.b", L.F.lit(1))).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[6]["lang_pred"] == "en" and by[2]["lang_pred"] == "de"
    for i in (3, 4, 5):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[None]["held_out"] is False
    assert L.predict_documents(make_docs([])).count() == 0
    assert {r["lang_pred"] for r in L.predict_documents(make_docs([(1, "abc", None)])).collect()} == {"und"}
    kept = L.keep_identified(make_docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {3, 4, 5}.isdisjoint({r["doc_id"] for r in kept.collect()})
    with pytest.raises(ValueError):
        L.predict(spark.createDataFrame([("a", 1)], "text string, Score int"), L.train(make_docs(rows)))


def test_labels_are_no_input(documents, make_docs):
    model = L.train(documents)
    a = L.predict(documents.select("doc_id", "text"), model).collect()
    b = L.predict(documents.select("doc_id", "text", L.F.lit("zz").alias("lang")), model).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in a} == {(r["doc_id"], r["lang_pred"]) for r in b}


def test_too_many_languages(make_docs):
    with pytest.raises(Exception, match="more than 2 languages"):
        L.train(make_docs([(i, "abc", f"l{i}") for i in range(5)]), max_languages=2)
