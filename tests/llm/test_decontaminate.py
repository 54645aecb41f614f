import random

import pytest

from tessera.llm import decontaminate as D


def plain_score(item, passage):
    """Textbook Smith-Waterman over the whole text."""
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (D.MATCH if a == b else D.MISMATCH), h[i - 1][j] + D.GAP, h[i][j - 1] + D.GAP)
            best = max(best, h[i][j])
    return best / (D.MATCH * len(item))


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id long, text string")
    return make


def test_alignment_against_textbook():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.choice("abcde") for _ in range(rng.randint(1, 12))]
        passage = [rng.choice("abcde") for _ in range(rng.randint(1, 30))]
        score, first, end = D.align(item, passage)
        assert score == plain_score(item, passage)
        if score:
            assert plain_score(item, passage[first:end]) == score


def test_documents_against_brute_force(spark, documents, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = D.contaminated(documents, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r for r in rows}
    assert len(got) == len(rows) > 0
    texts = {r["doc_id"]: D.words_of(r["text"]) for r in documents.collect()}
    want = set()
    for b in bench.collect():
        item = D.words_of(b["text"])
        for i, words in texts.items():
            if len(set(item) & set(words)) >= 0.4 * len(set(item)):  # fewer can't reach the score
                score = D.align(item, words)[0]
                if score * D.MATCH * len(item) >= D.needed_score(len(item)):
                    want.add((i, b["item_id"]))
                    assert got[i, b["item_id"]]["score"] == pytest.approx(score)
    assert set(got) == want
    for r in rows:
        assert r["end_word"] - r["first_word"] >= 5
    kept = D.drop_contaminated(documents, bench)
    assert kept.columns == documents.columns
    assert {r["doc_id"] for r in kept.collect()} == set(texts) - {i for i, _ in want}


def test_edited_copies_and_copies_in_most_documents(make_docs, items):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    item = [word() for _ in range(40)]
    rows = []
    for i in range(200):
        body = [word() for _ in range(80)]
        if i % 2:  # half of the documents hold it: no n-gram of it is rare by share
            copy = list(item)
            if i % 4 == 3:
                for at in rng.sample(range(40), 6):
                    copy[at] = word()
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy)), word())
            body[30:30] = copy
        rows.append((i, " ".join(body)))
    got = {r["doc_id"]: r for r in D.contaminated(make_docs(rows), items([(7, " ".join(item).upper() + "!")])).collect()}
    assert set(got) == {i for i in range(200) if i % 2}
    assert all(got[i]["score"] == 1 and (got[i]["first_word"], got[i]["end_word"]) == (30, 70) for i in range(1, 200, 4))


@pytest.mark.parametrize("verbatim, others", [(1, 300), (50, 50), (50, 1000), (400, 1000)])
def test_edited_copies_of_frequent_items(make_docs, items, verbatim, others):
    """Copies with every fourth or fifth word changed are found however often the item itself occurs."""
    rng = random.Random(verbatim + others)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    item = [word() for _ in range(40)]
    edited = {f: [word() if k % f == f - 1 else w for k, w in enumerate(item)] for f in (4, 5)}
    copies = [item] * verbatim + [edited[4], edited[5]]
    rows = [(i, " ".join([word() for _ in range(20)] + c + [word() for _ in range(20)])) for i, c in enumerate(copies)]
    rows += [(len(copies) + i, " ".join(word() for _ in range(60))) for i in range(others)]
    docs, bench = make_docs(rows), items([(7, " ".join(item))])
    got = {r["doc_id"]: r["score"] for r in D.contaminated(docs, bench).collect()}
    assert set(got) == set(range(len(copies)))
    assert [got[verbatim + k] for k in range(2)] == pytest.approx([plain_score(item, c) for c in (edited[4], edited[5])])
    assert {r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()} == {r[0] for r in rows[len(copies):]}


def test_edges(spark, make_docs, items):
    long_item = " ".join(f"q{i}" for i in range(1000))
    part = " ".join(f"q{i}" for i in range(300, 700))
    rows = [(1, None), (2, ""), (3, "one two three four"), (3, "one two three four"), (None, "x one two three four y"),
            (4, "z " * 20000 + part), (5, "alpha beta gamma"), (6, "tiny other pair"), (7, "a tiny pair, one"), (8, "lonely")]
    docs = make_docs(rows).withColumn("_bad_id", D.F.lit(1)).withColumn("a.b", D.F.lit(1))
    bench = items([(10, "One, two: three four."), (11, None), (12, ""), (None, long_item), (13, "tiny pair"), (14, "alpha beta gamma"), (15, "Lonely!")])
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.contaminated(docs, bench).collect()}
    assert got == {(3, 10): 1.0, (None, 10): 1.0, (4, None): 1.0, (5, 14): 1.0, (7, 13): 1.0, (8, 15): 1.0}
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6]
    assert D.contaminated(make_docs([]), bench).count() == 0
    assert D.contaminated(docs, items([])).count() == 0
    assert D.drop_contaminated(docs, items([])).count() == len(rows)


def found(make_docs, items, docs, bench):
    rows = D.contaminated(make_docs(docs), items(bench)).collect()
    return {(r["doc_id"], r["item_id"]): r["score"] for r in rows}


def brute(docs, bench):
    out = {}
    for i, text in docs:
        for k, item in bench:
            a, b = D.words_of(item), D.words_of(text)
            score = plain_score(a, b)
            if D.MATCH * len(a) * score >= D.needed_score(len(a)):
                out[i, k] = score
    return out


def test_a_document_is_judged_by_itself(make_docs, items):
    bench = [(1, "a1 b1 c1 d1 e1 f1"), (2, "p1 q1 r1 s1 t1 u1"), (3, "x1 y1 z1")]
    docs = [(1, "a1 b1 c1 d1 zz p1 q1 r1 s1"), (2, "c1 d1 e1 f1"), (3, "c1 d1 p1 q1")]
    both = found(make_docs, items, docs, bench)
    assert both == brute(docs, bench) and (1, 1) in both and (1, 2) in both
    for d in docs:
        assert found(make_docs, items, [d], bench) == {k: v for k, v in both.items() if k[0] == d[0]}
    for b in bench:
        assert found(make_docs, items, docs, [b]) == {k: v for k, v in both.items() if k[1] == b[0]}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nothing_that_reaches_the_limit_is_lost(make_docs, items, seed, monkeypatch):
    """Edits of every second to fifth word, gaps, inserts and cuts, at several table sizes, against plain alignment."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    bench = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((1, 2, 3, 4, 5, 6, 8, 11, 17, 24, 40, 64))]
    docs = []
    for k, item in bench:
        words = item.split()
        copies = [words, words[len(words) // 2:], words[:len(words) // 2], words[: -(-len(words) // 2)]]
        for every in (2, 3, 4, 5):
            copies.append([word() if i % every == every - 1 else w for i, w in enumerate(words)])
            copies.append([w for i, w in enumerate(words) if i % every != every - 1])
            copies.append([x for i, w in enumerate(words) for x in ((w, word()) if i % every == every - 1 else (w,))])
        copies.append([x for w in words for x in (w, word())][:-1])
        for c in copies:
            docs.append((len(docs), " ".join([word() for _ in range(rng.randrange(30))] + c + [word() for _ in range(rng.randrange(30))])))
    want = brute(docs, bench)
    assert found(make_docs, items, docs, bench) == pytest.approx(want) and len(want) > 100
    monkeypatch.setattr(D, "MAX_SEEDS", 60)  # several blocks of items
    some = docs[::7]
    assert found(make_docs, items, some, bench) == pytest.approx({k: v for k, v in want.items() if k[0] % 7 == 0})


def test_texts_without_spaces(make_docs, items):
    bench = [(1, "这是一个没有空格的测验题目,答案是什么?"), (2, "ไม่มีช่องว่าง")]
    docs = [(1, "前面这是一个没有空格的测验题目答案是什么后面"), (2, "完全不同的文字内容在这里"), (3, "这是一个没有空格的考试题目答案是什么"), (4, "xไม่มีช่องว่างy")]
    got = found(make_docs, items, docs, bench)
    assert got == pytest.approx(brute(docs, bench)) and set(got) == {(1, 1), (3, 1), (4, 2)}


def test_many_alignments_at_once():
    rng = random.Random(9)
    item = [rng.choice("abcde") for _ in range(11)]
    passages = [[rng.choice("abcdefg") for _ in range(rng.randint(0, 70))] for _ in range(300)]
    for p, (score, first, end) in zip(passages, D.align_many(item, passages)):
        assert score == pytest.approx(plain_score(item, p) * D.MATCH * len(item))
        if score:
            assert plain_score(item, p[first:end]) * D.MATCH * len(item) == pytest.approx(score)


def test_a_stock_phrase_does_not_pair_everything(make_docs, items):
    """300 items and 3,000 documents share one phrase; each item is held by ten documents."""
    import time
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    phrase = "which of the following is true about".split()
    bench = [phrase + [word() for _ in range(18)] for _ in range(300)]
    docs = []
    for i in range(3000):
        body = bench[i // 10][7:] if i % 2 else bench[i // 10][7:20]
        docs.append((i, " ".join([word() for _ in range(20)] + phrase + body + [word() for _ in range(20)])))
    start = time.time()
    got = found(make_docs, items, docs, [(k, " ".join(w)) for k, w in enumerate(bench)])
    assert set(got) == {(i, i // 10) for i in range(3000)} and time.time() - start < 60


def test_items_that_repeat_their_words(make_docs, items):
    bench = [(1, "ha ha ha ha ha ha ha ha ha ha"), (2, "la di la di la di la di dum"), (3, "one one two two one one two two three")]
    docs = [(1, "x ha ha ha ha ha y"), (2, "ha ha ha ha"), (3, "la di la di la di"), (4, "la la di di"), (5, "two two one one two two"),
            (6, "one two one two one two one two one"), (7, " ".join(["ha"] * 500)), (8, "la x di la x di la di x la di x dum")]
    assert found(make_docs, items, docs, bench) == pytest.approx(brute(docs, bench))
