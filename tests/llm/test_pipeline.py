import os
import zlib

import corpus_pipeline as P
from tessera.llm import decontaminate as D
from tessera.llm import langid as L
from tests.llm import test_langid, test_quality, test_simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_brute_force(spark, sf, documents):
    assert [n for n, _ in P.STAGES] == ["quality", "language", "near_duplicates", "benchmark", "encoding"]
    docs, rows = documents, [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]
    keep = {}

    judged = test_quality.brute(rows)
    keep["quality"] = {r[0] for r in judged if r[7]}
    for name, stage in P.STAGES:
        docs = P.via_table(stage(spark, docs, sf), name)
        got = docs.collect()
        if name == "encoding":
            assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
            assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got)
            break
        if name == "language":
            fold = {r[0]: zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows}
            pred = test_langid.brute([(t, lang) for i, t, lang, _ in rows if not fold[i]], [r[1] for r in rows])
            keep[name] = {r[0] for r, (lang, s) in zip(rows, pred) if lang != "und" and s >= 0.5}
        elif name == "near_duplicates":
            prints = {r[0]: test_simhash.brute_print(r[1]) for r in rows}
            comp = test_simhash.brute_components(prints.values())
            least = {}
            for i, f in prints.items():
                least[comp[f]] = min(i, least.get(comp[f], i))
            keep[name] = set(least.values())
        elif name == "benchmark":
            items = [D.words_of(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            bad = {r[0] for r in rows for item in items
                   if len(set(item) & set(w := D.words_of(r[1]))) >= 0.4 * len(set(item))
                   and D.align(item, w)[0] >= D.MIN_SCORE}
            keep[name] = {r[0] for r in rows} - bad
        assert docs.columns == COLUMNS
        assert sorted(r["doc_id"] for r in got) == sorted(keep[name]), name
        rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in got]


def test_clean_documents_stay(spark, sf):
    """Of labelled good documents, only copies, test items and base failures go."""
    docs = P.read_table(spark, sf, "documents")
    good = {r["doc_id"] for r in P.read_table(spark, sf, "labels").collect() if r["quality"] == 1}
    judged = {r["doc_id"]: r for r in test_quality.Q.judge_documents(docs).collect()}
    lost = [i for i in good if not judged[i]["kept"] and not judged[i]["base_failed"]]
    assert len(lost) <= 0.01 * len(good)
    kept = {r["doc_id"] for r in P.language(spark, docs, sf).collect()}
    assert len(good - kept) <= 0.01 * len(good)


def test_edges(spark, sf, make_docs, tmp_path):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "short"), (4, " ".join(f"word{i} and" for i in range(60)), "en", "s")]
    rows.append((4, rows[-1][1], "en", "s"))
    for data, want in ((rows, [4]), ([], [])):
        out = str(tmp_path / f"t{len(data)}")
        os.makedirs(out)
        make_docs(data).withColumn("lang_pred", L.F.lit("x")).write.parquet(f"{out}/documents.parquet")
        spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
        assert [r["doc_id"] for r in P.run(spark, out).collect()] == want
