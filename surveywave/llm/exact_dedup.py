"""Exact deduplication by deterministic block naming.

The normalised text is cut into fixed-size blocks.  Distinct blocks are sorted
and numbered: equal blocks get one integer name, different blocks different
ones.  Adjacent names are then paired, distinct pairs sorted and numbered, and
so on until one name stands for a document (Karp, Miller, Rosenberg).  Two
documents get the same identity exactly when their normalised texts are equal.

At scale the text moves once, in the distinct over blocks (map-side combined,
so thousands of copies of a block leave each task once).  Everything after it
is a few integers a block.  Blocks find their name by a 128-bit hash; that the
hash tells all distinct blocks apart is checked on the whole text, and another
seed is taken if it does not, so the identity stays collision-free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, hash128

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """Text without white space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def _numbered(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct rows, sorted inside their hash partition and numbered there;
    the partition's number is the upper part of the name."""
    return df.select(*cols).distinct().sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def document_identities(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                        block_chars: int = BLOCK_CHARS, hashing=hash128) -> DataFrame:
    """One row per input row: _row, doc id, n_chars (code points of the
    original), text_sha256 of the normalised text, _key1/_key2 (content key) and
    the identity (_level, _name).

    Empty and NULL texts share the identity (-1, -1).  Repeated rows keep a
    row each.  Other columns of docs are not read.
    """
    seed = 0
    while True:
        norm = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_t")).select(
            "doc_id", "_t", normalised(F.col("_t")).alias("_n"))
        cut = F.regexp_extract_all("_n", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
        h1, h2 = hashing(F.col("b"), seed=seed)
        # the distinct blocks, with nothing but their text
        names = _numbered(norm.select(F.explode(cut).alias("b")).select(h1.alias("h1"), h2.alias("h2"), "b"),
                          "h1", "h2", "b").drop("b")
        names = scratch.table(names, "names")
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break
        seed += 1
    k1, k2 = hash128(F.col("doc_id"), F.col("_t"))
    hashes = F.transform(cut, lambda b: F.struct(*[h.alias(n) for h, n in zip(hashing(b, seed=seed), ("h1", "h2"))]))
    base = scratch.table(norm.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", F.coalesce(F.length("_t"), F.lit(0)).alias("n_chars"),
        F.sha2("_n", 256).alias("text_sha256"), k1.alias("_key1"), k2.alias("_key2"), hashes.alias("_hashes")), "base")

    cur = (base.select("_row", F.size("_hashes").alias("n"), F.posexplode("_hashes").alias("pos", "h"))
           .select("_row", "n", "pos", "h.h1", "h.h2").join(names, ["h1", "h2"]).select("_row", "n", "pos", "name"))
    cur = scratch.table(cur, "level0")
    level, done = 0, cur.where("n = 1").select("_row", F.lit(0).alias("_level"), F.col("name").alias("_name"))
    while not cur.where("n > 1").isEmpty():
        level += 1
        pairs = cur.where("n > 1").groupBy("_row", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("r"),
            F.ceil(F.first("n") / 2).cast("int").alias("n"))
        names = scratch.table(_numbered(pairs, "l", "r"), f"names{level}")
        cur = scratch.table(pairs.join(names, ["l", "r"]).select("_row", "n", "pos", "name"), f"level{level}")
        done = done.unionByName(cur.where("n = 1").select("_row", F.lit(level).alias("_level"), F.col("name").alias("_name")))
    return (base.drop("_hashes").join(done, "_row", "left")
            .withColumns({"_level": F.coalesce("_level", F.lit(-1)), "_name": F.coalesce("_name", F.lit(-1))}))


def exact_dedup(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                block_chars: int = BLOCK_CHARS, hashing=hash128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    n_chars and the content key.

    Of equal normalised texts the row with the most code points in its original
    text stays, then the smallest doc_id (NULL ids last); of rows that repeat in
    full exactly one is kept.  NULL texts count as empty.  An empty table gives
    an empty result.
    """
    ident = scratch.table(document_identities(docs, scratch, id_col, text_col, block_chars, hashing), "identity")
    best = ident.groupBy("_level", "_name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), "doc_id", "_row")).alias("best"))
    # written, so that both sides of the join are exchanges and AQE may split a hot group
    best = scratch.table(best, "best")
    return ident.join(best, ["_level", "_name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("best._row")).alias("kept"), "text_sha256", "n_chars", "_key1", "_key2")
