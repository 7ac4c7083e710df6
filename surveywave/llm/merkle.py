"""A Merkle manifest of a dataset: a content-addressed DAG, descended by rank.

A leaf is the digest of a row's fields.  The leaves of a group (a source) in
order of their id form a tree of runs of three, and the roots of the groups form
another tree of the same kind, whose root stands for the dataset.  What is stored
of a tree is one record for each inner node: its digest and its children's.
Nodes are found by digest alone, so equal subtrees are one record.

A proof is a descent.  Requests (a group and a rank in it) start at the root;
at each record the next digit of the rank, base three, selects a child, and the
other children are collected as a path segment.  Requests that share leading
digits descend as one, so every level holds each wanted node once and all levels
together cost about half as many rows as there are leaves.  Reversed, the
segments lead from the leaf to the root: folding a leaf with them gives the root
if, and only if, the row is the one in the manifest.

At scale.  Texts are read once and never move; what is shuffled is digests of 32
bytes.  Ranks come from a range partitioning (`ranking`), so a group with a
third of all rows is no task of its own; a run's aggregation holds three rows.
Levels shrink by three and are written, so a lost executor re-reads a level.  The
number of levels is the only thing that is counted on the driver.

Edge cases.  NULL fields are marked in the digest and differ from empty ones.
NULL ids come first in their group, NULL groups first among the groups; ties in
the id are ordered by leaf, and rows that repeat in full have equal leaves and
each their own rank.  Texts of any length are hashed whole.  A table of one row
has its leaf as root and an empty proof.  An empty table gives empty results.
Columns beside the fields are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .ranking import ranked

FANOUT = 3
STEPS_KEPT = 4  # levels of a descent between two written tables


# --- digests -------------------------------------------------------------------

def encoded(value: Column) -> Column:
    """`-` for NULL, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """The sha256 of the concatenated strings, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[encoded(f) for f in fields])


def _joined(children: Column) -> Column:
    """The hex digests of an array of digests, one after the other; empty if there are none."""
    return F.array_join(F.transform(children, as_hex), "")


# --- building ------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """leaves: the rows with group, group_rank, rank and leaf.
    records: level (1 = parents of leaves), digest and children of every inner
    node; the levels of the tree over the groups count on from those below.
    groups: group, group_rank, height and subroot.
    root: one row, its digest and height over the groups; none for an empty table."""

    leaves: DataFrame
    group_records: list[DataFrame]
    top_records: list[DataFrame]
    groups: DataFrame
    root: DataFrame

    def records(self) -> DataFrame:
        """The stored DAG as one content-addressed table: digest, children."""
        levels = [r.select("digest", "children") for r in self.group_records + self.top_records]
        if not levels:
            return self.root.select("digest", F.array("digest").alias("children")).limit(0)
        out = levels[0]
        for level in levels[1:]:
            out = out.unionByName(level)
        return out.dropDuplicates(["digest"])


def _trees(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """From (tree, rank, n, digest), n nodes a tree: the records of each level,
    and a row a tree with its height and the digest of its root."""
    records: list[DataFrame] = []
    roots = nodes.where("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        run = F.sort_array(F.collect_list(F.struct("rank", "digest")))
        level = nodes.where("n > 1").withColumn("up", F.expr(f"rank div {FANOUT}")).groupBy("tree", "up").agg(
            run.alias("run"), F.expr(f"(max(n) + {FANOUT - 1}) div {FANOUT}").alias("n"))
        level = level.select("tree", F.col("up").alias("rank"), "n", F.col("run.digest").alias("children"))
        level = scratch.table(level.withColumn("digest", digest(_joined(F.col("children")))), f"{name}{len(records) + 1}")
        records.append(level)
        roots = roots.unionByName(level.where("n = 1").select("tree", F.lit(len(records)).alias("height"), "digest"))
        nodes = level.select("tree", "rank", "n", "digest")
        most = -(-most // FANOUT)
    return records, scratch.table(roots, f"{name}-roots")


def build_manifest(rows: DataFrame, scratch: Scratch, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> Manifest:
    """The manifest of rows that have their leaf digest (32 bytes) in `leaf`."""
    placed = ranked(rows, [group], [F.col(order).asc_nulls_first(), F.col(leaf).asc()], scratch, "leaves")
    names = scratch.table(ranked(rows.select(group).distinct(), [], [F.col(group).asc_nulls_first()], scratch, "groups")
                          .select(F.col(group).alias("_g"), F.col("_rank").alias("group_rank")), "group-ranks")
    leaves = scratch.table(placed.join(names, F.col(group).eqNullSafe(F.col("_g")))
                           .select(*rows.columns, "group_rank", F.col("_rank").alias("rank"), F.col("_size").alias("n_leaves")), "ranked")
    low, subroots = _trees(leaves.select(F.col("group_rank").alias("tree"), "rank", F.col("n_leaves").alias("n"), F.col(leaf).alias("digest")),
                           scratch, "level")
    groups = scratch.table(subroots.join(names, F.col("tree") == F.col("group_rank")).select(
        F.col("_g").alias(group), "group_rank", "height", F.col("digest").alias("subroot")), "subroots")
    n = groups.count()
    top, root = _trees(groups.select(F.lit(0).cast("long").alias("tree"), F.col("group_rank").alias("rank"), F.lit(n).cast("long").alias("n"),
                                     F.col("subroot").alias("digest")), scratch, "top")
    return Manifest(leaves, low, top, groups, root.select("digest", "height"))


# --- descending ----------------------------------------------------------------

def _segment(children: Column, chosen: Column) -> Column:
    """The unselected children to the left and to the right of the selected one."""
    return F.struct(F.slice(children, 1, chosen).alias("left"),
                    F.slice(children, chosen + 2, F.greatest(F.size(children) - chosen - 1, F.lit(0))).alias("right"))


def _meet(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The frontier's nodes with their children.  By a merge at every level: paths
    that share their beginnings are small in files and many times that in memory,
    so a size check would send them through the driver as a broadcast."""
    return frontier.join(records.select("digest", "children").dropDuplicates(["digest"]).hint("merge"), "digest")


def _down(frontier: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """One level down: (tree, rank, path, digest) of the children of the
    frontier's nodes, those only that `wanted` (tree, rank) has, if given."""
    met = _meet(frontier, records)
    kids = met.select("tree", "rank", "path", "children", F.posexplode("children").alias("digit", "digest"))
    kids = kids.select("tree", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), "digest", "path", "children", "digit")
    if wanted is not None:
        kids = kids.join(wanted.hint("merge"), ["tree", "rank"], "left_semi")
    return kids.select("tree", "rank", "digest", F.array_append("path", _segment(F.col("children"), F.col("digit"))).alias("path"))


def _wanted(requests: DataFrame | None, levels: int, scratch: Scratch, name: str) -> list[DataFrame | None]:
    """For each level the distinct nodes (tree, rank) above the requested ones."""
    if requests is None:
        return [None] * (levels + 1)
    out = [scratch.table(requests.select("tree", "rank").distinct(), f"{name}0")]
    for level in range(1, levels + 1):
        out.append(scratch.table(out[-1].select("tree", F.expr(f"rank div {FANOUT}").alias("rank")).distinct(), f"{name}{level}"))
    return out


def descend(manifest: Manifest, scratch: Scratch, requests: DataFrame | None = None, group: str = "source") -> DataFrame:
    """The parents of the requested leaves with the path that led there:
    group_rank, up (rank of the parent; of the leaf itself where it is its own
    subroot), lone, path (root first) and children.  requests has group_rank and
    rank; without it every leaf is requested."""
    empty = "cast(array() as array<struct<left: array<binary>, right: array<binary>>>)"
    asked = None if requests is None else requests.select(F.col("group_rank").alias("tree"), "rank").distinct()
    top_wanted = _wanted(None if asked is None else asked.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")),
                         len(manifest.top_records), scratch, "asked-top")
    front = manifest.root.select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", F.expr(empty).alias("path"))
    for level in range(len(manifest.top_records), 0, -1):
        front = _down(front, manifest.top_records[level - 1], top_wanted[level - 1])
    heights = manifest.groups.select("group_rank", "height", F.col("subroot").alias("digest"))
    entered = scratch.table(front.select(F.col("rank").alias("group_rank"), "path", "digest").join(heights.hint("merge"), ["group_rank", "digest"]), "entered")

    def entering(height: int) -> DataFrame:
        return entered.where(F.col("height") == height).select(
            F.col("group_rank").alias("tree"), F.lit(0).cast("long").alias("rank"), "digest", "path")

    wanted = _wanted(asked, len(manifest.group_records), scratch, "asked")
    top = len(manifest.group_records)
    front = entering(top)
    for level in range(top, 1, -1):
        front = _down(front, manifest.group_records[level - 1], wanted[level - 1]).unionByName(entering(level - 1))
        if (top - level) % STEPS_KEPT == STEPS_KEPT - 1:
            front = scratch.table(front, f"front{level}")
    lone = entering(0).select("tree", F.col("rank").alias("up"), F.lit(True).alias("lone"), "path", F.array("digest").alias("children"))
    if top:
        met = _meet(front, manifest.group_records[0])
        lone = lone.unionByName(met.select("tree", F.col("rank").alias("up"), F.lit(False).alias("lone"), "path", "children"))
    return lone.withColumnRenamed("tree", "group_rank")


def proofs(manifest: Manifest, scratch: Scratch, requests: DataFrame | None = None, group: str = "source") -> DataFrame:
    """The requested leaves (all without requests), each with its proof: an
    array of (left, right) from the leaf's run up to the root's, the siblings'
    digests on either side.  Columns: those of the leaves, subroot, root, proof."""
    ends = descend(manifest, scratch, requests, group)
    leaves = manifest.leaves
    if requests is not None:
        leaves = leaves.join(requests.select("group_rank", "rank").distinct(), ["group_rank", "rank"], "left_semi")
    # keyed by the parent, so a path moves once for its three leaves
    keyed = leaves.withColumns({"lone": F.col("n_leaves") == 1, "up": F.expr(f"rank div {FANOUT}")})
    segment = _segment(F.col("children"), F.expr(f"cast(rank % {FANOUT} as int)"))
    path = F.when(F.col("lone"), F.col("path")).otherwise(F.array_append("path", segment))
    found = keyed.join(ends.hint("merge"), ["group_rank", "up", "lone"]).withColumn("proof", F.reverse(path)).drop("up", "lone", "path", "children")
    one = manifest.root.first()
    root = F.lit(None).cast("binary") if one is None else F.lit(bytes(one.digest))
    return found.join(manifest.groups.select("group_rank", "subroot"), "group_rank").withColumn("root", root)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda at, s: digest(_joined(s["left"]), as_hex(at), _joined(s["right"])))


def proof_text(proof: Column) -> Column:
    """All digests of a proof in hex, level by level from the leaf, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(_joined(s["left"]), _joined(s["right"]))), "")


def verify(proved: DataFrame, scratch: Scratch, leaf_col: str, proof_col: str = "proof") -> DataFrame:
    """proved with folded_root (from leaf_col and the proof) and verified."""
    out = proved.withColumn("folded_root", folded(F.col(leaf_col), F.col(proof_col)))
    return out.withColumn("verified", F.col("folded_root").eqNullSafe(F.col("root")))
