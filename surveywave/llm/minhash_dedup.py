"""MinHash near-deduplication with tensored banding.

Two collections A and B hold `parts` short keys each, a key being `rows`
minhashes.  Table (i, j) is keyed by the pair (A_i, B_j): parts**2 tables of
2 * rows minhashes each cost only 2 * parts * rows minhashes a text.  A pair
with similarity s meets in some table with probability (1 - (1 - s**rows)**parts)**2:
with 26 parts of 5 rows 0.9999 at 0.8, and 0.0006 at 0.25.

Scale:
* texts with equal shingle sets are one node, combined before any shuffle;
* a table key is written out only where both its parts are shared, and buckets
  are named so that near copies share names, so a node alone costs 2 * parts
  short rows and one in a group a few keys more;
* buckets are stars around their least node, never pairs; the nodes that hang
  together through buckets form clusters, and only there are texts compared;
* a cluster is compared in tiles of a bounded number of texts and shingles, as
  an incidence matrix product inside the task; large clusters are cut by size
  band (texts linked at 0.8 differ by at most one band of ratio 1.25) and by
  hash into several tiles.  Tiles return a spanning forest of their links, so
  no list of pairs exists anywhere, and nothing is capped.

Edge cases.  NULL and empty texts and texts without words have no shingles and
link with nothing.  Very long texts are read whole.  Of ties the least doc_id
names a component; repeated rows share one.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, with_row_key
from .components import connected_components
from .shingles import mix64, shingle_sets
from .streams import groups

TILE_TEXTS = 256
TILE_SHINGLES = 2_000_000


@dataclass(frozen=True)
class Tensor:
    """parts keys of rows minhashes in each of the two collections."""
    parts: int = 26
    rows: int = 5
    seed: int = 1

    def multipliers(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.integers(0, 2**63, 2 * self.parts * self.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """(texts, 2 * parts) keys; sets must not be empty."""
        values = np.concatenate(sets)
        at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
        key = np.zeros((2 * self.parts, len(sets)), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k, a in enumerate(self.multipliers()):
                least = np.minimum.reduceat(values * a, at)
                key[k // self.rows] = mix64(key[k // self.rows] * np.uint64(31) + least + np.uint64(k))
        return key.T


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _signatures(size: int, tensor: Tensor):
    """Arrow in, Arrow out: ids pass through untouched, NULLs included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):  # a few MB of shingles at a time
                part = batch.slice(low, 256)
                sets = shingle_sets(part.column("_t").to_pylist(), size)
                full = [s for s in sets if len(s)]
                keys = _signed(tensor.keys(full)).ravel() if full else np.empty(0, np.int64)
                width = [2 * tensor.parts * bool(len(s)) for s in sets]
                with np.errstate(over="ignore"):
                    s1 = np.array([mix64(np.add.reduce(mix64(s + np.uint64(5)), dtype=np.uint64) + np.uint64(len(s))) for s in sets], np.uint64)
                    s2 = np.array([np.bitwise_xor.reduce(mix64(s * np.uint64(0xD6E8FEB86659FD93)), initial=np.uint64(0)) for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("_key1"), part.column("_key2"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(_signed(s1)), pa.array(_signed(s2)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(width))), pa.int32()), pa.array(keys))],
                    ["doc_id", "_key1", "_key2", "n_shingles", "s1", "s2", "keys"])
            pa.default_memory_pool().release_unused()
    return run


def _tile_links(size: int, percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tile in groups(frames, "tile"):
            nodes = tile["node"].to_numpy()
            if len(nodes) < 2:
                continue
            label = linked_labels(shingle_sets(tile["_t"].tolist(), size), percent)
            moved = np.flatnonzero(label != np.arange(len(label)))
            if len(moved):
                yield pd.DataFrame({"u": nodes[moved], "v": nodes[label[moved]]})
    return run


def linked_labels(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first set that it reaches by links, a link being
    100 * intersection >= percent * union, on the full sets."""
    count = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), count)
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    owner, column = owner[shared], column[shared]
    dense = np.cumsum(seen > 1) - 1
    column = dense[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    width = 8192
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        block = np.zeros((len(sets), width), dtype=np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        common += block @ block.T
    link = 100 * common >= percent * (count[:, None] + count[None, :] - common)
    np.fill_diagonal(link, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(link, label[None, :], len(sets)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def candidate_clusters(nodes: DataFrame, scratch: Scratch, tensor: Tensor) -> DataFrame:
    """(node, cluster): nodes that hang together through tensored tables.
    Nodes that meet no other are left out.

    A part's bucket is named by its least node.  Two nodes that share A_i and
    B_j share the names of both buckets, so the table keyed by the two names
    holds every bucket of table (i, j); near copies, whose buckets have the
    same few least nodes, fill a few keys instead of parts**2.
    """
    m = tensor.parts
    parts = nodes.select("node", F.posexplode("keys").alias("i", "part")).select(
        "node", (F.col("i") >= m).alias("b_side"), F.xxhash64("i", "part").alias("part"))
    least = parts.groupBy("part").agg(F.min("node").alias("name"), F.max("node").alias("top")).where("name < top").drop("top")
    named = parts.join(least.hint("merge"), "part").select("node", "b_side", "name").distinct()
    both = named.groupBy("node").agg(
        F.collect_list(F.when(~F.col("b_side"), F.col("name"))).alias("a"),
        F.collect_list(F.when(F.col("b_side"), F.col("name"))).alias("b")).where("size(a) > 0 and size(b) > 0")
    table = both.select("node", F.explode("a").alias("a"), "b").select("node", "a", F.explode("b").alias("b"))
    table = scratch.table(table, "tables")
    # a star around the least node of each key: n nodes give n - 1 edges
    least = table.groupBy("a", "b").agg(F.min("node").alias("v"), F.max("node").alias("top")).where("v < top").drop("top")
    edges = table.join(least.hint("merge"), ["a", "b"]).where("node <> v").select(F.col("node").alias("u"), "v")
    return connected_components(edges, scratch).select("node", F.col("component").alias("cluster"))


def _tiles(members: DataFrame) -> DataFrame:
    """One row for each tile that a member (node, cluster, n_shingles) is in."""
    half_texts, half_shingles = TILE_TEXTS // 2, TILE_SHINGLES // 2
    members = members.withColumn("band", F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(1.25))))
    whole = members.groupBy("cluster").agg(F.count("*").alias("c_n"), F.sum("n_shingles").alias("c_s"))
    bands = members.groupBy("cluster", "band").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s")).select(
        "cluster", "band", F.ceil(F.greatest(F.col("n") / half_texts, F.col("s") / half_shingles)).alias("cuts"))
    small = (F.col("c_n") <= TILE_TEXTS) & (F.col("c_s") <= TILE_SHINGLES)
    members = members.join(whole, "cluster")
    one = members.where(small).select("node", F.xxhash64("cluster", F.lit(-1)).alias("tile"))
    big = members.where(~small).select("node", "cluster", "band")
    near = lambda shift, name: bands.select("cluster", (F.col("band") + shift).alias("band"), F.col("cuts").alias(name))
    big = (big.join(near(0, "cuts"), ["cluster", "band"])
           .join(near(1, "below"), ["cluster", "band"], "left").join(near(-1, "above"), ["cluster", "band"], "left")
           .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts"))))
    upto = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(
        F.array().cast("array<bigint>"))
    named = lambda kind, band, a, b: F.xxhash64("cluster", F.lit(kind), band, a, b)
    tiles = F.concat(
        F.transform(upto(F.col("cuts")), lambda o: named(0, F.col("band"), F.least("cut", o), F.greatest("cut", o))),
        F.transform(upto(F.col("below")), lambda o: named(1, F.col("band") - 1, o, F.col("cut"))),
        F.transform(upto(F.col("above")), lambda o: named(1, F.col("band"), F.col("cut"), o)))
    return one.unionByName(big.select("node", F.explode(tiles).alias("tile")))


def minhash_dedup(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 4, percent: int = 80, tensor: Tensor = Tensor()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, content key.

    Documents link when 100 * intersection >= percent * union of their distinct
    word shingles; component_id is the least doc_id reachable.  NULL texts and
    texts without words have n_shingles 0 and link with nothing.  Fully repeated
    rows share a component and are all marked by doc_id = component_id.  NULL
    doc_ids come last; a component of such rows alone has a NULL id and keeps
    them.  An empty table gives an empty result.

    percent is 80 at least: the size bands and the parts of the Tensor are made
    for that, and a lower one would lose links.
    """
    if percent < 80:
        raise ValueError(f"percent {percent}: the size bands and the minhash tables find links from 80 on only")
    source = with_row_key(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_t")), "doc_id", "_t")
    long = T.LongType()
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType), *(
        T.StructField(c, long) for c in ("_key1", "_key2", "n_shingles", "s1", "s2")), T.StructField("keys", T.ArrayType(long))])
    signed = scratch.table(source.mapInArrow(_signatures(shingle, tensor), schema), "signatures")

    # texts with one shingle set are one node
    nodes = signed.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("b"), "doc_id", "_key1", "_key2", "keys")).alias("r"))
    nodes = scratch.table(nodes.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "n_shingles", F.col(
        "r.doc_id").alias("least_id"), "r._key1", "r._key2", "r.keys"), "nodes")

    # what grows with the documents is joined by shuffle at every size
    members = nodes.select("node", "n_shingles", "_key1", "_key2").join(
        candidate_clusters(nodes.select("node", "keys"), scratch, tensor).hint("merge"), "node")
    members = scratch.table(members, "members")
    keys = ["_key1", "_key2"]
    texts = source.drop("doc_id").join(members.select("node", *keys).hint("merge"), keys).dropDuplicates(keys).select("node", "_t")
    tiled = _tiles(members.select("node", "cluster", "n_shingles")).join(texts.hint("merge"), "node").select("tile", "node", "_t")
    links = tiled.repartition("tile").sortWithinPartitions("tile").mapInPandas(_tile_links(shingle, percent), "u long, v long")
    found = connected_components(scratch.table(links, "links"), scratch)

    placed = nodes.join(found, "node", "left").select(
        "s1", "s2", "n_shingles", "least_id", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    placed = scratch.table(placed.join(least, "component").select("s1", "s2", "n_shingles", "component_id"), "placed")
    out = signed.drop("keys").join(placed.hint("merge"), ["s1", "s2", "n_shingles"], "left")
    alone = F.col("n_shingles") == 0
    return out.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"), *keys)
