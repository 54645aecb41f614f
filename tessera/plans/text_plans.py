"""Text queries (X*, J7, C13) over the whole ``documents.text``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as TF
from tessera.operators import text as X
from tessera.plans.catalog import register
from tessera.session import cut_lineage
from tessera.sources.tables import Tables

_STOP_SQL = ", ".join(f"'{w}'" for w in TF.STOP_WORDS)
_PUNCT_SQL = TF.PUNCTUATION.replace("'", "''")
_FILTERS_SQL = TF.KERAS_FILTERS.replace("'", "''").replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '")
_SPACES_SQL = "'" + " " * len(TF.KERAS_FILTERS) + "'"

_KTOK_SQL = f"""
ktok AS (SELECT doc_id,
                list_filter(string_split(translate(lower(text), '{_FILTERS_SQL}', {_SPACES_SQL}), ' '), lambda x: x <> '') AS toks
         FROM documents),
rows AS (SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) - 1 AS pos FROM ktok),
cnt AS (SELECT word, count(*) AS n FROM rows GROUP BY word),
vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS id FROM cnt)
"""


def keras_docs(spark, d):
    return Tables(spark, d).documents.select("doc_id", TF.keras_tokens("text").alias("tokens"))


@register("text_clean", "X1", sql=f"""
WITH s AS (SELECT doc_id, lower(translate(regexp_replace(regexp_replace(text, 'https?://\\S+|www\\.\\S+', '', 'g'),
                                                        '<.*?>', '', 'g'), '{_PUNCT_SQL}', '')) AS t FROM documents)
SELECT doc_id, array_to_string(list_filter(string_split_regex(trim(t), '\\s+'),
                                           lambda x: x <> '' AND NOT list_contains([{_STOP_SQL}], x)), ' ') AS cleaned
FROM s
""")
def text_clean(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", TF.clean_text("text").alias("cleaned"))


@register("text_tokens", "X2", sql=f"""
WITH {_KTOK_SQL}
SELECT k.doc_id, len(k.toks) AS n_keras,
       len(regexp_extract_all(lower(d.text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS n_count,
       len(regexp_extract_all(d.text, '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS n_count_cased
FROM ktok k JOIN documents d ON k.doc_id = d.doc_id
""")
def text_tokens(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", F.size(TF.keras_tokens("text")).alias("n_keras"),
                       F.size(TF.count_tokens("text")).alias("n_count"),
                       F.size(TF.count_tokens("text", lowercase=False)).alias("n_count_cased"))


@register("vocabulary", "X3", sql=f"""
WITH {_KTOK_SQL}
SELECT word, n, id FROM vocab
""")
def vocabulary(spark, d):
    return X.build_vocabulary(keras_docs(spark, d), "doc_id", "tokens").select("word", "n", "id")


@register("max_length", "X3", sql=f"""
WITH {_KTOK_SQL}
SELECT max(len(toks)) AS max_length FROM ktok
""")
def max_length(spark, d):
    return X.max_length(keras_docs(spark, d), "tokens").select(F.col("max_length").cast("bigint").alias("max_length"))


@register("text_ids_padded", "X4", sql=f"""
WITH {_KTOK_SQL},
seq AS (SELECT r.doc_id, list(v.id ORDER BY r.pos) AS ids FROM rows r JOIN vocab v ON r.word = v.word GROUP BY r.doc_id),
every AS (SELECT d.doc_id, coalesce(s.ids, []) AS ids FROM documents d LEFT JOIN seq s ON d.doc_id = s.doc_id),
sized AS (SELECT *, CAST(2 ** ceil(log2(greatest(len(ids), 1))) AS BIGINT) AS width FROM every)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda x: 0)), ' ') AS ids,
       len(ids) AS n_known, width
FROM sized
""")
def text_ids_padded(spark, d):
    """Whole sequences, each padded to the next power of two, so that nothing is cut."""
    docs = keras_docs(spark, d)
    ids = X.texts_to_ids(docs, "doc_id", "tokens", cut_lineage(X.build_vocabulary(docs, "doc_id", "tokens")))
    width = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size("ids"), F.lit(1))))).cast("bigint")
    ids = ids.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_known"), width.alias("width"))
    return ids.withColumn("ids", F.array_join(X.pad_post("ids", F.col("width")), " "))


@register("text_ids", "X4", sql=f"""
WITH {_KTOK_SQL},
seq AS (SELECT r.doc_id, list(v.id ORDER BY r.pos) AS ids FROM rows r JOIN vocab v ON r.word = v.word GROUP BY r.doc_id)
SELECT d.doc_id, array_to_string(coalesce(s.ids, []), ' ') AS ids, CAST(len(coalesce(s.ids, [])) AS BIGINT) AS n_ids
FROM documents d LEFT JOIN seq s ON d.doc_id = s.doc_id
""")
def text_ids(spark, d):
    """Whole id sequences and their lengths: nothing is cut, and padding does not multiply the output."""
    docs = keras_docs(spark, d)
    ids = X.texts_to_ids(docs, "doc_id", "tokens", cut_lineage(X.build_vocabulary(docs, "doc_id", "tokens")))
    return ids.select("doc_id", F.array_join("ids", " ").alias("ids"), F.size("ids").cast("bigint").alias("n_ids"))


@register("hashed_word_ids", "X5", sql=f"""
WITH {_KTOK_SQL}
SELECT doc_id, array_to_string(list_transform(toks,
           lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 999 + 1), ' ') AS ids FROM ktok
""")
def hashed_word_ids(spark, d):
    docs = keras_docs(spark, d)
    return docs.select("doc_id", F.array_join(X.hashed_ids("tokens", 1000), " ").alias("ids"))


@register("count_vector", "X6", sql="""
SELECT doc_id, word, count(*) AS tf
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS word FROM documents)
GROUP BY doc_id, word
""")
def count_vector(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", TF.count_tokens("text").alias("tokens"))
    return X.count_vector(docs, "doc_id", "tokens")


@register("tfidf_keras", "X7", sql="""
WITH tf AS (SELECT doc_id, word, count(*) AS tf
            FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS word FROM documents)
            GROUP BY doc_id, word),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
SELECT doc_id, word, round((1 + ln(tf)) * ln(1 + (SELECT count(*) FROM documents) / (1 + df)), 6) AS tfidf
FROM tf JOIN df USING (word)
""")
def tfidf_keras(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", TF.count_tokens("text").alias("tokens"))
    t = X.tfidf_keras(docs, "doc_id", "tokens")
    return t.select("doc_id", "word", F.round("tfidf", 6).alias("tfidf"))


@register("vocab_lookup", "X8", sql=f"""
WITH {_KTOK_SQL},
ids AS (SELECT r.doc_id, r.pos, v.id FROM rows r JOIN vocab v ON r.word = v.word),
back AS (SELECT i.doc_id, i.pos, v.word FROM ids i JOIN vocab v ON i.id = v.id)
SELECT b.doc_id, count(*) AS n_tokens, count(*) FILTER (WHERE b.word = r.word) AS n_roundtrip
FROM back b JOIN rows r ON b.doc_id = r.doc_id AND b.pos = r.pos GROUP BY b.doc_id
""")
def vocab_lookup(spark, d):
    docs = keras_docs(spark, d)
    vocab = cut_lineage(X.build_vocabulary(docs, "doc_id", "tokens"))
    rows = X.token_rows(docs, "doc_id", "tokens")
    ids = X.id_of_word(rows, vocab).withColumnRenamed("word", "asked")
    back = X.word_of_id(ids, vocab).withColumnRenamed("word", "back").where(F.col("doc_id").isNotNull())
    # a token of a document whose id is its own meets only itself; only documents that share an id have to be joined
    shared = cut_lineage(docs.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    j = back
    if not shared.isEmpty():
        again = rows.join(shared, "doc_id").select("doc_id", "pos", F.col("word").alias("asked"))
        j = back.join(shared, "doc_id", "left_anti").unionByName(
            back.join(shared, "doc_id").drop("asked").join(again, ["doc_id", "pos"]))
    return j.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"),
                                   F.count(F.when(F.col("back") == F.col("asked"), 1)).alias("n_roundtrip"))


DIM = 64


# "Pretrained" vectors: the embeddings row k is the vector of vocabulary word
# with id 3k, so only part of the vocabulary is covered.
def _pretrained(spark, d, vocab):
    e = Tables(spark, d).embeddings
    return (e.join(vocab.select("id", "word"), F.col("id") == F.col("vec_id") * 3)
            .select("word", F.col("embedding").alias("vector")))


@register("vocab_vector_coverage", "J7 S5", sql=f"""
WITH {_KTOK_SQL},
hit AS (SELECT v.id FROM vocab v JOIN embeddings e ON v.id = e.vec_id * 3)
SELECT round((SELECT count(*) FROM hit) / ((SELECT count(*) FROM vocab) + 1), 6) AS coverage
""")
def vocab_vector_coverage(spark, d):
    vocab = X.build_vocabulary(keras_docs(spark, d), "doc_id", "tokens")
    _, cov = X.vocab_vectors(vocab, _pretrained(spark, d, vocab), DIM)
    return cov.select(F.round("coverage", 6).alias("coverage"))


@register("pooled_doc_vectors", "C13 J7", sql=f"""
WITH {_KTOK_SQL},
ids AS (SELECT r.doc_id, v.id FROM rows r JOIN vocab v ON r.word = v.word),
dims AS (SELECT e.vec_id * 3 AS id, unnest(e.embedding) AS val,
                generate_subscripts(e.embedding, 1) AS dim FROM embeddings e),
-- a word without a vector counts as a vector of zeros
per AS (SELECT i.doc_id, dims.dim, max(dims.val) AS hit FROM ids i JOIN dims ON i.id = dims.id GROUP BY 1, 2),
zero AS (SELECT DISTINCT i.doc_id FROM ids i WHERE i.id NOT IN (SELECT vec_id * 3 FROM embeddings)),
cells AS (SELECT per.doc_id, CASE WHEN zero.doc_id IS NULL THEN hit ELSE greatest(hit, 0) END AS v
          FROM per LEFT JOIN zero ON per.doc_id = zero.doc_id),
got AS (SELECT doc_id, round(sum(CAST(v AS DOUBLE)), 4) AS vsum, round(max(CAST(v AS DOUBLE)), 4) AS vmax
        FROM cells GROUP BY doc_id)
SELECT d.doc_id, CAST({DIM} AS BIGINT) AS n_dims, coalesce(vsum, 0) AS vsum, coalesce(vmax, 0) AS vmax
FROM documents d LEFT JOIN got ON d.doc_id = got.doc_id
""")
def pooled_doc_vectors(spark, d):
    docs = keras_docs(spark, d)
    vocab = cut_lineage(X.build_vocabulary(docs, "doc_id", "tokens"))
    vecs, _ = X.vocab_vectors(vocab, _pretrained(spark, d, vocab), DIM)
    ids = X.texts_to_ids(docs, "doc_id", "tokens", vocab)
    pooled = X.pooled_vectors(ids, vecs, DIM, "max")
    return pooled.select("doc_id", F.size("vector").cast("bigint").alias("n_dims"),
                         F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 4).alias("vsum"),
                         F.round(F.array_max("vector"), 4).alias("vmax"))


@register("flattened_doc_vectors", "C13", sql=f"""
WITH {_KTOK_SQL},
sums AS (SELECT vec_id * 3 AS id, list_sum(CAST(embedding AS DOUBLE[])) AS s FROM embeddings),
got AS (SELECT r.doc_id, count(*) AS n, sum(coalesce(s, 0.0)) AS total, sum((r.pos % 7) * coalesce(s, 0.0)) AS placed
        FROM rows r JOIN vocab v ON r.word = v.word LEFT JOIN sums ON sums.id = v.id GROUP BY r.doc_id)
SELECT d.doc_id, {DIM} * coalesce(n, 0) AS n_cells, round(coalesce(total, 0), 3) AS total, round(coalesce(placed, 0), 3) AS placed
FROM documents d LEFT JOIN got ON d.doc_id = got.doc_id
""")
def flattened_doc_vectors(spark, d):
    """Of every whole flattened vector: its length, its sum, and its sum weighted by the token's place."""
    whole = flattened_doc_vectors_whole(spark, d)
    cell = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    per = whole.select("doc_id", "pos", F.size("vector").alias("n"), cell.alias("s")).groupBy("doc_id").agg(
        F.sum("n").alias("n"), F.sum("s").alias("total"), F.sum(F.col("s") * (F.col("pos") % 7)).alias("placed"))
    zero = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 3).alias(c)
    return Tables(spark, d).documents.select("doc_id").join(per, "doc_id", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_cells"), zero("total"), zero("placed"))


@register("flattened_doc_vectors_whole", "C13")
def flattened_doc_vectors_whole(spark, d):
    """Every token of every document: (doc_id, pos, vector)."""
    docs = keras_docs(spark, d)
    vocab = cut_lineage(X.build_vocabulary(docs, "doc_id", "tokens"))
    # frequent words without a vector are there too, so that their tokens need no search among the rare ones
    vecs = cut_lineage(vocab.join(_pretrained(spark, d, vocab), "word", "left").select("word", "id", "vector")
                       .where((F.col("id") <= X.HEAD_WORDS) | F.col("vector").isNotNull()))
    return X.token_vectors(X.token_rows(docs, "doc_id", "tokens"), vecs, DIM)
