"""Exact duplicates by deterministic naming of blocks.

The normalised bytes of a text are cut into blocks of a fixed size.  The
distinct blocks are sorted and numbered: a block's name.  Then adjacent names
of a document form pairs, the distinct pairs are sorted and numbered, and so
on, until each document has one name.  Two documents have the same
(level, name) exactly if their normalised texts are equal, by induction: equal
names at a level stand for equal sequences of blocks.  No step relies on a
hash being free of collisions.

At scale: block contents cross the network once, for their naming, and equal
ones are combined before that.  Documents carry 64-bit keys of their blocks in
the meantime; a key that several distinct blocks share (found by counting) is
named by content.  Each round halves the rows.  A name that many places hold
is joined by broadcast; such names are at most ``HOT_KEYS``.

Defined results: a null text is an empty one; all empty texts are one group.
Repeated rows are rows of a group like others, and one of them is kept.  A null
``doc_id`` comes after all others in ties; a group of nothing else has a null
``keep_id``.  A text of any length is only more blocks.  An empty table gives
no rows; other columns don't matter whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, via_table

#: Bytes in a block.
BLOCK_BYTES = 4096
#: A name held by more than this part of all places is joined by broadcast: there are fewer than so many.
HOT_KEYS = 50_000
#: The characters that normalisation deletes.
WHITE = " \t\n\x0b\x0c\r"
#: In place of a right neighbour at an odd end.
_NO_NAME = -(1 << 63)


def normalised(text: Column) -> Column:
    """The text without white space, as bytes; of a null text, no bytes."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "").cast("binary")


def _n_blocks(data: Column, size: int) -> Column:
    return F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)).cast("int")


def _blocks(data: Column, size: int) -> Column:
    """array of the blocks; an empty text is one empty block."""
    return F.transform(F.sequence(F.lit(0), _n_blocks(data, size) - 1),
                       lambda i: F.substr(data, i * size + 1, F.lit(size)))


def _key(block: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(block), 64 - bits)


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names: the order of the sorted keys within the key's partition, after the partition's number."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of rows with a table of distinct keys that says how many rows each has.

    Keys with more than a ``HOT_KEYS``-th of all rows are fewer than ``HOT_KEYS`` and are broadcast;
    no key that is left has more rows than that share in the shuffle.
    """
    hot = F.col(weight) * HOT_KEYS > total
    held = table.withColumn("_hit", F.lit(True))
    found = rows.join(F.broadcast(held.where(hot)), keys, "left")
    rest = found.where("_hit IS NULL").select(*rows.columns).join(held.where(~hot), keys)
    return found.where("_hit").select(*rest.columns).unionByName(rest).drop("_hit", weight)


def _clashing(texts: DataFrame, names: DataFrame, size: int, bits: int) -> DataFrame | None:
    """(sha, pos, name) of the places whose key stands for several distinct blocks; None if there are none."""
    clash = via_table(names.groupBy("key").count().where("count > 1").select("key"), "block-clash")
    if clash.isEmpty():
        return None
    places = (texts.select("sha", F.posexplode(_blocks(F.col("data"), size)).alias("pos", "block"))
              .withColumn("key", _key(F.col("block"), bits)).join(clash, "key", "left_semi").distinct())
    places = via_table(places, "block-places")
    own = _numbered(places.select("block").distinct(), ["block"]).withColumn("name", -1 - F.col("name"))
    named = places.join(via_table(own, "block-own"), "block").select("sha", "pos", "name")
    if not named.groupBy("sha", "pos").count().where("count > 1").isEmpty():
        raise ArithmeticError("two texts have the same SHA-256")
    return via_table(named, "block-clash-names")


def _first_names(texts: DataFrame, docs: DataFrame, size: int, bits: int) -> DataFrame:
    """(row, n, pos, name) of every block of every document."""
    distinct = (texts.select(F.explode(_blocks(F.col("data"), size)).alias("block"))
                .select(_key(F.col("block"), bits).alias("key"), "block")
                .groupBy("key", "block").agg(F.count(F.lit(1)).alias("held")))
    names = via_table(_numbered(distinct, ["key", "block"]).drop("block"), "block-names")
    places = docs.select("row", "n", "sha", F.posexplode("keys").alias("pos", "key"))
    clash = _clashing(texts, names, size, bits)
    total = names.agg(F.sum("held")).first()[0] or 0
    if clash is None:
        return join_hot(places.drop("sha"), names, ["key"], "held", total).drop("key")
    shared = names.groupBy("key").count().where("count > 1").select("key")
    simple = names.join(shared, "key", "left_anti")
    plain = join_hot(places.join(shared, "key", "left_anti").drop("sha"), simple, ["key"], "held", total)
    other = places.join(shared, "key", "left_semi").join(clash, ["sha", "pos"])
    return plain.select("row", "n", "pos", "name").unionByName(other.select("row", "n", "pos", "name"))


def _next_names(places: DataFrame) -> DataFrame:
    """One round: adjacent names become the name of their pair."""
    odd = F.col("pos").bitwiseAND(1) == 1
    pairs = (places.groupBy("row", F.shiftright("pos", 1).alias("pos"))
             .agg(F.max(F.shiftright(F.col("n") + 1, 1)).alias("n"),
                  F.max(F.when(~odd, F.col("name"))).alias("left"),
                  F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(_NO_NAME)).alias("right")))
    pairs = via_table(pairs, "block-pairs")
    distinct = pairs.groupBy("left", "right").agg(F.count(F.lit(1)).alias("held"))
    names = via_table(_numbered(distinct, ["left", "right"]), "block-names")
    return join_hot(pairs, names, ["left", "right"], "held", pairs.count()).select("row", "n", "pos", "name")


def name_documents(df: DataFrame, text_col: str = "text", carry: list[str] | None = None,
                   block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """(row, carry struct, n_chars, sha, level, name): (level, name) is equal exactly for equal normalised texts.

    ``carry`` are the columns to keep (all by default); ``row`` numbers the rows.  ``key_bits`` below 64 only
    makes more keys clash, the names stay exact.
    """
    carry = df.columns if carry is None else carry
    texts = df.select(normalised(col(text_col)).alias("data")).withColumn("sha", F.sha2("data", 256))
    docs = (df.select(F.struct(*[col(c) for c in carry]).alias("carry"), normalised(col(text_col)).alias("data"),
                      F.coalesce(F.char_length(col(text_col)), F.lit(0)).cast("long").alias("n_chars"))
            .select(F.monotonically_increasing_id().alias("row"), "carry", "n_chars",
                    F.sha2("data", 256).alias("sha"), _n_blocks(F.col("data"), block_bytes).alias("n"),
                    F.transform(_blocks(F.col("data"), block_bytes), lambda b: _key(b, key_bits)).alias("keys")))
    docs = via_table(docs, "block-docs")
    longest = docs.agg(F.max("n")).first()[0] or 1
    places = via_table(_first_names(texts, docs, block_bytes, key_bits), "block-level")
    named = places.where("n = 1").select("row", F.lit(0).alias("level"), "name")
    for level in range(1, (longest - 1).bit_length() + 1):
        places = via_table(_next_names(places.where("n > 1")), "block-level")
        named = named.unionByName(places.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
    return docs.drop("n", "keys").join(named, "row")


def mark_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", carry: list[str] | None = None,
                    block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """(carry struct, keep_id, group_size, kept, text_sha256), one row per row of ``df``.

    Of equal normalised texts the row with the most code points, then the smallest id, is kept.
    """
    carry = df.columns if carry is None else carry
    named = via_table(name_documents(df, text_col, [*carry, *[id_col] * (id_col not in carry)], block_bytes, key_bits),
                      "block-identities")
    ident = F.col("carry").getField(id_col)
    first = F.min(F.struct(-F.col("n_chars"), ident.isNull(), ident.alias("id"), F.col("row").alias("keep_row")))
    groups = named.groupBy("level", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("held"))
    groups = via_table(groups.select("level", "name", F.col("first.id").alias("keep_id"), "first.keep_row",
                                     F.col("held").alias("group_size"), "held"), "block-groups")
    return (join_hot(named, groups, ["level", "name"], "held", named.count())
            .select("carry", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_exact_duplicates(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The kept rows, with the columns of ``df``."""
    marked = mark_duplicates(df, text_col, id_col)
    return marked.where("kept").select(*[F.col("carry").getField(c).alias(c) for c in df.columns])


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of all documents."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mark_duplicates(slim, carry=["doc_id"]).select(
        "carry.doc_id", "keep_id", "group_size", "kept", "text_sha256")
