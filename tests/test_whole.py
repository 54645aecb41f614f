"""Queries that return the whole job over whole tables (sf0.001)."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import text as X
from tessera.plans.catalog import load_all

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

REG = load_all()


def test_whole_id_sequences(spark):
    """No document loses its tail: as many ids as words, equal words with equal ids."""
    tokens = {r["doc_id"]: r["n_keras"] for r in REG["text_tokens"].fn(spark, SF).collect()}
    got = {r["doc_id"]: r for r in REG["text_ids"].fn(spark, SF).collect()}
    padded = {r["doc_id"]: r["ids"].split(" ") for r in REG["text_ids_padded"].fn(spark, SF).collect()}
    assert set(got) == set(tokens) and max(tokens.values()) > 200
    for i, r in got.items():
        ids = r["ids"].split()
        assert len(ids) == r["n_ids"] == tokens[i]
        assert ids == [x for x in padded[i] if x != "0"] and len(padded[i]).bit_count() == 1


@pytest.mark.parametrize("head", [0, 2, 1000])
def test_rare_words_are_looked_up_once_a_document(spark, monkeypatch, head):
    monkeypatch.setattr(X, "HEAD_IDS", head)
    docs = spark.createDataFrame([(1, ["b", "x", "a", "c", "b", "d", "c"]), (2, []), (3, None), (1, ["d", "d"]), (4, ["x", "x"]), (5, ["a"])],
                                 "doc_id long, tokens array<string>").repartition(3)
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "word string, id long")
    got = sorted((r["doc_id"], r["ids"]) for r in X.texts_to_ids(docs, "doc_id", "tokens", vocab).collect())
    assert got == [(1, [2, 1, 3, 2, 4, 3]), (1, [4, 4]), (2, []), (3, []), (4, []), (5, [1])]


def test_whole_flattened_vectors(spark):
    """Each token of each document has the vector that DuckDB finds for its word, at its place."""
    from tests.oracle_compare import duck
    from tessera.plans.text_plans import _KTOK_SQL
    want = {(a, b): c for a, b, c in duck(SF).execute(f"""
        WITH {_KTOK_SQL}
        SELECT r.doc_id, r.pos, e.embedding FROM rows r JOIN vocab v ON r.word = v.word
        LEFT JOIN embeddings e ON v.id = e.vec_id * 3""").fetchall()}
    got = REG["flattened_doc_vectors_whole"].fn(spark, SF)
    held = got.withColumn("vector", F.when(F.exists("vector", lambda x: x != 0) | (F.size("vector") != 64), F.col("vector")))
    rows = held.collect()
    assert len(rows) == len(want) and max(r["pos"] for r in rows) > 200
    for r in rows:
        v = want[r["doc_id"], r["pos"]]
        assert r["vector"] == (list(v) if v is not None else None)


@pytest.mark.parametrize("head", [1, 20])
def test_token_vectors_of_rare_words(spark, monkeypatch, head):
    monkeypatch.setattr(X, "HEAD_WORDS", head)
    docs = spark.createDataFrame([(1, ["b", "x", "a", "c", "b"]), (2, [])], "doc_id long, tokens array<string>")
    vecs = spark.createDataFrame([("a", 1, [1.0, -2.0]), ("b", 2, [3.0, 4.0])], "word string, id long, vector array<float>")
    got = X.token_vectors(X.token_rows(docs, "doc_id", "tokens"), vecs, 2).orderBy("pos").collect()
    assert [(r["doc_id"], r["pos"], r["vector"]) for r in got] == [
        (1, 0, [3.0, 4.0]), (1, 1, [0.0, 0.0]), (1, 2, [1.0, -2.0]), (1, 3, [0.0, 0.0]), (1, 4, [3.0, 4.0])]


def test_whole_vector_discriminants(spark):
    """LDA and QDA on all 64 slots against numpy."""
    e = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x, y = np.array([r["embedding"] for r in e], float), np.array([r["label"] for r in e])
    classes = sorted(set(y.tolist()))
    mean = {c: x[y == c].mean(0) for c in classes}
    pooled = sum(np.cov(x[y == c].T) * ((y == c).sum() - 1) for c in classes) / (len(y) - len(classes))

    lda = np.stack([np.log((y == c).mean()) - 0.5 * np.einsum("ij,jk,ik->i", x - mean[c], np.linalg.inv(pooled), x - mean[c])
                    for c in classes])

    def on_span(c):
        """By the singular values of the centred rows: most classes have fewer rows than slots."""
        of = x[y == c] - mean[c]
        _, s, v = np.linalg.svd(of, full_matrices=False)
        var, v = (s ** 2 / (len(of) - 1))[s > 1e-5 * s[0]], v[s > 1e-5 * s[0]]
        return np.log(len(of) / len(y)) - 0.5 * np.log(var).sum() - 0.5 * (((x - mean[c]) @ v.T) ** 2 / var).sum(1)

    qda = np.stack([on_span(c) for c in classes])
    got = {r["vec_id"]: r for r in REG["clf_discriminant_whole"].fn(spark, SF).collect()}
    assert len(got) == len(e) and x.shape[1] == 64
    for name, score in (("lda", lda), ("qda", qda)):
        assert [got[r["vec_id"]][name] for r in e] == [classes[k] for k in score.argmax(0)]
    # two classes of more rows than slots: the usual formula
    y2 = (y > 4).astype(int)
    two = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(y2, x))],
                                "id long, label int, v array<double>").repartition(5)
    m = C.vector_discriminant_fit(two, "label", "v", quadratic=True)
    full = np.stack([np.log(len(p) / len(y)) - 0.5 * np.linalg.slogdet(np.cov(p.T))[1]
                     - 0.5 * np.einsum("ij,jk,ik->i", x - p.mean(0), np.linalg.inv(np.cov(p.T)), x - p.mean(0))
                     for p in (x[y2 == 0], x[y2 == 1])])
    pred = {r["id"]: r["qda"] for r in C.vector_discriminant_predict(two, {"qda": m}, "id", "v").collect()}
    assert [pred[i] for i in range(len(y))] == full.argmax(0).tolist()


def test_rows_of_a_slice_are_bounded(spark, monkeypatch):
    """A task turns a bounded number of tokens into arrays at a time, whatever the batch; ids are the same."""
    import pyarrow as pa
    monkeypatch.setattr(X, "SLICE_TOKENS", 3)
    lists = pa.array([["a"], ["b", "c"], [], ["d"] * 7, None, ["e"], ["f"] * 3])
    for arr in (lists, lists.slice(2, 4)):
        got = list(X._row_slices(arr))
        assert [x for at, n in got for x in arr.slice(at, n).to_pylist()] == arr.to_pylist()
        assert all(n == 1 or len(arr.slice(at, n).flatten()) <= 3 for at, n in got)
    docs = spark.createDataFrame([(1, ["b", "x", "a", "c", "b"]), (2, []), (3, None), (4, ["c", "a"]), (5, ["q"])],
                                 "doc_id long, tokens array<string>").coalesce(1)
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "word string, id long")
    for head in (0, 2, 9):
        monkeypatch.setattr(X, "HEAD_IDS", head)
        got = sorted((r["doc_id"], r["ids"]) for r in X.texts_to_ids(docs, "doc_id", "tokens", vocab).collect())
        assert got == [(1, [2, 1, 3, 2]), (2, []), (3, []), (4, [3, 1]), (5, [])]


@pytest.mark.parametrize("head", [0, 2, 9])
def test_rows_of_frequent_words_stay_where_they_are(spark, monkeypatch, head):
    """Only rows that the head does not know take part in the shuffled join; results do not depend on the head."""
    monkeypatch.setattr(X, "HEAD_WORDS", head)
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "zz"), (4, None), (None, "d"), (5, "c")], "doc_id long, word string")
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "word string, id long")
    inner = [(1, "a", 1), (1, "a", 1), (2, "b", 2), (5, "c", 3), (None, "d", 4)]
    key = lambda r: tuple(map(str, r))
    joined = X.by_word(rows, table)
    assert sorted(map(tuple, joined.collect()), key=key) == sorted(inner, key=key)
    assert "LeftAnti" in joined._jdf.queryExecution().optimizedPlan().toString()
    left = [tuple(r) for r in X.by_word(rows, table, "left").collect()]
    assert sorted(left, key=key) == sorted([*inner, (3, "zz", None), (4, None, None)], key=key)
    ids = spark.createDataFrame([(7, 1), (7, 4), (8, 0), (9, None)], "doc_id long, id long")
    got = sorted(map(tuple, X.word_of_id(ids, table).select("doc_id", "id", "word").collect()), key=key)
    assert got == sorted([(7, 1, "a"), (7, 4, "d"), (8, 0, None), (9, None, None)], key=key)


@pytest.mark.parametrize("head", [1, 20])
def test_words_known_without_a_vector_are_not_looked_up(spark, monkeypatch, head):
    """A frequent word with a null vector has zeros; no search among the rare words follows."""
    monkeypatch.setattr(X, "HEAD_WORDS", head)
    docs = spark.createDataFrame([(1, ["x", "a", "x", "q"])], "doc_id long, tokens array<string>")
    vecs = spark.createDataFrame([("x", 1, None), ("x", 40, [9.0, 9.0]), ("a", 30, [1.0, -2.0])], "word string, id long, vector array<float>")
    got = X.token_vectors(X.token_rows(docs, "doc_id", "tokens"), vecs, 2).orderBy("pos").collect()
    assert [r["vector"] for r in got] == [[0.0, 0.0], [1.0, -2.0], [0.0, 0.0], [0.0, 0.0]]


@pytest.mark.parametrize("head", [1, 20])
def test_pooled_vectors_by_a_loop(spark, monkeypatch, head):
    monkeypatch.setattr(X, "HEAD_WORDS", head)
    seqs = {1: [1, 2, 2, 1], 2: [1, 3], 3: [], 4: [2, 2, 2], 5: [3], 6: [9]}
    vecs = {1: [-1.0, -2.0], 2: [-3.0, 4.0], 3: [0.0, 0.0]}
    ids = spark.createDataFrame(list(seqs.items()), "doc_id long, ids array<long>")
    table = spark.createDataFrame(list(vecs.items()), "id long, vector array<float>")
    for how, f in (("max", np.max), ("mean", np.mean)):
        got = {r["doc_id"]: r["vector"] for r in X.pooled_vectors(ids, table, 2, how).collect()}
        for d, s in seqs.items():
            own = [vecs[i] for i in s if i in vecs]
            assert got[d] == pytest.approx(list(f(own, axis=0)) if own else [0.0, 0.0])


def test_lookup_of_documents_that_share_an_id(spark, tmp_path):
    docs = [(1, "a b a"), (2, "a c"), (2, "a d e"), (None, "a"), (3, None), (4, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, REG["vocab_lookup"].fn(spark, str(tmp_path)).collect()))
    # as the SQL joins: places of documents 2 meet both ways
    assert got == [(1, 3, 3), (2, 9, 7)]
