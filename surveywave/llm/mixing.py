"""Mixing sources to target weights with a multivariate-hypergeometric tree.

A block is one document.  Each source's target in words is turned into draws:
whole passes over its blocks, each in a new permuted order, and a last pass that
takes blocks as long as they fit.  What is then missing is filled by the one block
left whose size comes nearest, or by none if that is nearer.  Only where the
source is so small that this misses the target by more than `tolerance` is a
block cut, after a word and with its white space as it is (never with
tolerance=None).

The number of draws of each source is its exact quota.  The quotas are split over
the output shards by a binary tree: a node hands half of its draws to its left
child, the counts by source following a multivariate hypergeometric law, until
each leaf (shard) has an exact quota of every source and the place in the source's
permuted draws where it starts.  A shard draws the blocks from there on, so draws
are disjoint by construction, and shuffles them locally.

Scale: there are as many shards as the words of the mix fill, of SHARD_WORDS
each.  The permuted order is a hash, cut into buckets of about BUCKET_ROWS rows.
Prefix sums run over buckets first and over the rows of one bucket then, so no
source, however hot, is sorted in one task.  What is gathered in one place has a
row for each source, or for each source and bucket.  A draw finds its shard by a
join on cells of CELL draws, which hold the starts inside them.

Edge cases.  NULL texts and texts without words have size 0 and are never drawn; a
NULL source is a source of its own.  Very long texts are blocks like others.
Repeated rows are blocks of their own; ties in the permuted order go by row.  An
empty table gives an empty mix.  Columns of the input with the names used here do
not clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, hash128, with_row_key

BUCKET_ROWS = 4096
SHARD_WORDS = 1 << 24  # about 100 MB of text
LEAST_LEVELS = 3
CELL = 256
MOST_REPEATS = 3
TOLERANCE = 0.001


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, most: int = MOST_REPEATS) -> DataFrame:
    """totals(source, source_size) with sid, weight and target.

    Sources by code point, NULL last, weigh 1, 2, 3, 1, ...; together they get
    the sum of all sizes, a target being at most `most` times its source's size
    with the excess shared again by weight.  In closed form a target is
    min(most * size, level * weight); sorted by most * size / weight the capped
    sources come first, and the level is the largest of the values that follow
    from capping the sources before each.  One row a source passes the windows.
    """
    named = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    named = named.withColumns({"weight": ((F.col("sid") - 1) % 3 + 1).cast("double"),
                               "cap": F.col("source_size").cast("double") * most})
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    named = named.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return named.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).drop("cap", "level", "weight")


def _halves(seed: int, level: int):
    """Splits a node's quotas between its children, exactly half to the left."""
    def split(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("sid")
        node, quota = int(frame["node"].iloc[0]), frame["quota"].to_numpy(np.int64)
        rng = np.random.default_rng((seed, level, node))
        total = int(quota.sum())
        draws = (total + 1) // 2
        left = np.zeros_like(quota)
        for k, have in enumerate(quota.tolist()):
            # the count of this source among the draws left, given those before
            low, high = max(0, draws - (total - have)), min(have, draws)
            if low == high:
                got = low
            elif total < 10**9:
                got = int(rng.hypergeometric(have, total - have, draws))
            else:  # beyond numpy's range the law is normal to many digits
                mean = draws * (have / total)
                sd = np.sqrt(mean * (1 - have / total) * (total - draws) / max(1, total - 1))
                got = int(min(high, max(low, round(rng.normal(mean, sd)))))
            left[k], total, draws = got, total - have, draws - got
        start = frame["start"].to_numpy(np.int64)
        return pd.DataFrame({"node": np.repeat([2 * node, 2 * node + 1], len(quota)), "sid": np.tile(frame["sid"].to_numpy(), 2),
                             "quota": np.concatenate((left, quota - left)), "start": np.concatenate((start, start + left))})
    return split


def shard_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(node, sid, quota, start) of every shard that draws from a source: how
    many draws, and where they start in the source's order."""
    tree = quotas.select(F.lit(0).cast("long").alias("node"), "sid", "quota", F.lit(0).cast("long").alias("start"))
    for level in range(levels):
        tree = tree.groupBy("node").applyInPandas(_halves(seed, level), "node long, sid long, quota long, start long").where("quota > 0")
    return tree


def _shards(drawn: DataFrame, leaves: DataFrame) -> DataFrame:
    """drawn(sid, rank, ...) with the shard that each draw goes to."""
    cells = F.sequence(F.expr(f"start div {CELL}"), F.expr(f"(start + quota - 1) div {CELL}"))
    starts = leaves.select("sid", F.explode(cells).alias("cell"), F.struct("start", "node").alias("s")).groupBy("sid", "cell").agg(
        F.collect_list("s").alias("starts"))
    met = drawn.withColumn("cell", F.expr(f"rank div {CELL}")).join(starts, ["sid", "cell"])
    latest = F.array_max(F.filter("starts", lambda s: s["start"] <= F.col("rank")))
    return met.withColumn("shard", latest["node"]).drop("cell", "starts")


def _last_picks(last: DataFrame, sources: DataFrame, scratch: Scratch, tolerance: float | None) -> DataFrame:
    """The block of each source that fills up its last pass: sid, _row, rank and
    words.  last: the draws of the last passes with part and before."""
    fits = F.col("before") + F.col("size") <= F.col("part")
    # the first block that does not fit has the rank of the draw that is missing
    gaps = last.groupBy("sid").agg(
        (F.first("part") - F.coalesce(F.max(F.when(fits, F.col("before") + F.col("size"))), F.lit(0))).alias("gap"),
        F.min(F.when(~fits, F.struct("rank", "_row"))).alias("next"))
    gaps = scratch.table(gaps.where("gap > 0"), "gaps")
    rest = last.where(~fits).join(gaps, "sid")
    best = rest.groupBy("sid").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "h", "_row", "size")).alias("best"))
    picks = best.join(gaps, "sid").join(sources.select("sid", "target"), "sid")
    off = F.least(F.col("best.off"), F.col("gap"))
    whole = F.lit(True) if tolerance is None else off <= F.col("target") * tolerance
    return picks.select(
        "sid", F.when(whole, F.col("best._row")).otherwise(F.col("next._row")).alias("_row"), F.col("next.rank").alias("rank"),
        F.when(~whole, F.col("gap")).when(F.col("best.off") < F.col("gap"), F.col("best.size")).alias("words")).where("words > 0")


def mix_plan(base: DataFrame, scratch: Scratch, shard_words: int = SHARD_WORDS, seed: int = 17, most: int = MOST_REPEATS,
             tolerance: float | None = TOLERANCE) -> tuple[DataFrame, DataFrame, int]:
    """The draws of base(_row, _key1, _key2, source, size), its sources, and the
    number of shards.

    Draws: _row, epoch, size, words (taken of this draw), shard, place (in the
    shard's shuffled order).  They depend on content, not on partitioning.
    """
    totals = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("blocks"))
    sources = source_targets(scratch.table(totals, "totals"), most)
    words = F.floor(F.col("target") + 0.5).cast("long")
    sources = scratch.table(sources.withColumns({
        "passes": F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long"),
        "part": F.when(F.col("source_size") > 0, words % F.col("source_size")).otherwise(0).cast("long")}), "sources")
    blocks, total = sources.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    levels = max(LEAST_LEVELS, int(total // shard_words).bit_length())
    bits = max(1, int(blocks // BUCKET_ROWS).bit_length())

    draws = (base.where("size > 0").join(sources.withColumnRenamed("source", "_s").select("_s", "sid", "passes", "part"),
                                         F.col("source").eqNullSafe(F.col("_s")))
             .select("_row", "_key1", "_key2", "size", "sid", "passes", "part", F.explode(F.sequence(
                 F.lit(0).cast("long"), F.col("passes") - (F.col("part") == 0).cast("long"))).alias("epoch"))
             .withColumn("h", F.xxhash64(F.lit(seed), "epoch", "_key1", "_key2")))
    draws = scratch.table(draws.where("epoch >= 0").withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
                          .drop("_key1", "_key2"), "order")
    cell = ["sid", "epoch", "bucket"]
    sums = draws.groupBy(*cell).agg(F.sum("size").alias("w"), F.count("*").alias("c"))
    through = Window.partitionBy("sid").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_pass = Window.partitionBy("sid", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*cell, F.coalesce(F.sum("c").over(through), F.lit(0)).alias("c0"),
                       F.coalesce(F.sum("w").over(in_pass), F.lit(0)).alias("w0"))
    sums = scratch.table(sums, "buckets")
    inside = Window.partitionBy(*cell).orderBy("h", "_row")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    drawn = draws.join(sums, cell).select(
        "_row", "epoch", "size", "sid", "h", "passes", "part", (F.col("c0") + F.row_number().over(inside) - 1).alias("rank"),
        (F.col("w0") + F.coalesce(F.sum("size").over(earlier), F.lit(0))).alias("before"))
    drawn = scratch.table(drawn, "ranked")
    last = drawn.where("epoch = passes")
    picks = scratch.table(_last_picks(last, sources, scratch, tolerance), "picks")
    columns = ["_row", "epoch", "size", "sid", "h", "rank"]
    picked = last.drop("rank").join(picks, ["sid", "_row"]).select(*columns, "words")
    whole = drawn.where("epoch < passes OR before + size <= part").select(*columns, F.col("size").alias("words"))
    drawn = scratch.table(whole.unionByName(picked), "drawn")

    leaves = scratch.table(shard_quotas(drawn.groupBy("sid").agg(F.count("*").alias("quota")), levels, seed), "quotas")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "h"), "_row", "epoch")
    placed = _shards(drawn, leaves).select("_row", "epoch", "size", "words", "shard", F.row_number().over(local).alias("place"))
    return scratch.table(placed, "placed"), sources, 1 << levels


def _base(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    keyed = with_row_key(docs, id_col, text_col)
    return keyed.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), "_key1", "_key2",
                        F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))


def mix_report(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               shard_words: int = SHARD_WORDS, seed: int = 17, tolerance: float | None = TOLERANCE) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken
    (words of all its draws) and draws (epoch, shard, place, words)."""
    base = scratch.table(_base(docs, id_col, text_col, source_col), "base")
    draws, sources, _ = mix_plan(base, scratch, shard_words, seed, tolerance=tolerance)
    draws = draws.groupBy("_row").agg(F.sum("words").alias("taken"), F.sort_array(F.collect_list(F.struct("epoch", "shard", "place", "words"))).alias("draws"))
    sources = sources.select(F.col("source").alias("_s"), "source_size", "target")
    return (base.join(sources, F.col("source").eqNullSafe(F.col("_s"))).join(draws, "_row", "left")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.coalesce("draws", F.expr("array()")).alias("draws")))


def _leading_words(text: F.Column, n: F.Column) -> F.Column:
    """The text up to the end of its n-th word, white space as it is."""
    words, spaces = F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.split(text, WORD)
    return F.array_join(F.zip_with(F.slice(spaces, 1, n), F.slice(words, 1, n), lambda a, b: F.concat(a, b)), "")


def mix_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  shard_words: int = SHARD_WORDS, seed: int = 17, tolerance: float | None = None) -> DataFrame:
    """The mixed corpus: the columns of docs, a row for each draw, shard by
    shard in the shard's shuffled order.  Documents are drawn whole, unless a
    tolerance is given (n_chars, if there is one, follows a cut).
    """
    # a struct, as docs may have columns named like those of the draws
    stored = scratch.table(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")), "stored")
    k1, k2 = hash128(F.col("_doc")[id_col], F.col("_doc")[text_col])
    keyed = stored.select("_row", k1.alias("_key1"), k2.alias("_key2"), F.col("_doc")[source_col].alias("source"),
                          n_words(F.col("_doc")[text_col]).alias("size"))
    draws, _, shards = mix_plan(scratch.table(keyed, "base"), scratch, shard_words, seed, tolerance=tolerance)
    rows = stored.join(draws.hint("merge"), "_row")
    # by range, so shards follow each other and a partition is about one shard, with long texts or short ones
    rows = rows.repartitionByRange(shards, "shard", "place").sortWithinPartitions("shard", "place")
    if tolerance is None:
        return rows.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
    cut = F.col("words") < F.col("size")
    text = F.col("_doc")[text_col]
    short = F.when(cut, _leading_words(text, F.col("words").cast("int"))).otherwise(text)
    out = [short.alias(c) if c == text_col else
           F.when(cut, F.length(short)).otherwise(F.col("_doc")[c]).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
           F.col("_doc")[c].alias(c) for c in docs.columns]
    return rows.select(*out)
