"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2 c) apart; that is epsilon.  Vectors
are turned to principal axes (fitted on a bounded sample; the axes only decide
how much is skipped, never the result), put into grid cells of width epsilon on
the leading axes and sorted by cell.  The sequence is cut into blocks, blocks
into intervals of FAN blocks, and so on up.  The join starts with the whole
sequence against itself and descends: a pair of intervals goes on to its pairs
of children unless their bounding boxes on the leading axes are more than
epsilon apart, which proves that they hold no link.

Pairs of blocks are compared in double precision as one matrix product inside a
task, which returns counts of links and a spanning forest, never pairs.  Where
vectors have no structure that boxes could use, that is what remains: a block
matrix product that moves each block once a partner block.  Each block's partners are dealt evenly between the two blocks and split when there
are many.  Equal vectors are one row with a multiplicity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .components import connected_components

AXES = 8
BLOCK = 2048
FAN = 8
SAMPLE_VALUES = 500_000  # numbers that the fit of the axes may gather
PARTNERS = 64  # blocks that one stream compares with its own block
SLACK = 1e-9


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; first scaled by their largest entry, against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of vectors without NULL, NaN or infinite entries and not all zero."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.select(F.col(id_col).alias("vec_id"), F.when(fine, x).alias("x"))


def principal_axes(nodes: DataFrame, axes: int) -> np.ndarray:
    """The leading principal axes of the unit vectors with the least hashes, at
    most SAMPLE_VALUES numbers; shorter vectors are filled up with zeros."""
    width = nodes.agg(F.max("d")).first()[0] or 1
    rows = nodes.orderBy(F.xxhash64("x"), "node").limit(max(64, SAMPLE_VALUES // width)).select("x").toPandas()["x"]
    sample = np.zeros((max(1, len(rows)), width))
    for k, x in enumerate(rows):
        sample[k, :len(x)] = x
    if len(rows):
        sample = _unit(sample)
    _, vectors = np.linalg.eigh(np.cov(sample, rowvar=False, bias=True).reshape(width, width))
    return vectors[:, ::-1][:, :axes]


def _project(axes: np.ndarray, epsilon: float):
    """node, x -> its coordinates on the axes, and the cells as sort keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                rows = part.column("x").to_pylist()
                x = np.zeros((len(rows), axes.shape[0]))
                for k, row in enumerate(rows):
                    x[k, :len(row)] = row
                at = _unit(x) @ axes
                cell = np.floor(at / epsilon).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("d"), part.column("copies"), pa.array(list(cell), pa.list_(pa.int32())),
                     pa.array(list(at), pa.list_(pa.float64())), part.column("x")], ["node", "d", "copies", "cell", "at", "x"])
    return run


def _blocks(size: int, kind: str):
    """Sorted rows to blocks of `size` with their bounding boxes; a block holds
    vectors of one dimension."""
    names = ["part", "no", "d", "nodes", "copies", "low", "high", "data"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()),
             pa.list_(pa.float64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        count, d = 0, None

        def block() -> pa.RecordBatch:
            nonlocal no, held, count
            rows = pa.Table.from_batches(held)
            at = np.array(rows.column("at").to_pylist())
            data = np.array(rows.column("x").to_pylist(), dtype=kind)
            row = (part, no, d, rows.column("node").to_pylist(), rows.column("copies").to_pylist(),
                   at.min(axis=0).tolist(), at.max(axis=0).tolist(), data.tobytes())
            no, held, count = no + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            low, sizes = 0, batch.column("d").to_numpy()
            while low < batch.num_rows:
                if count and (count == size or sizes[low] != d):
                    yield block()
                d = int(sizes[low])
                other = np.flatnonzero(sizes[low:low + size - count] != d)
                high = low + int(other[0]) if len(other) else min(batch.num_rows, low + size - count)
                held.append(batch.slice(low, high - low))
                count, low = count + high - low, high
        if count:
            yield block()
    return run


def _box_apart(p: int, epsilon: float):
    """Squared distance of two boxes above epsilon**2: no link between them."""
    gaps = F.lit(0.0)
    for k in range(p):
        gap = F.greatest(F.lit(0.0), F.col(f"a_low{k}") - F.col(f"b_high{k}"), F.col(f"b_low{k}") - F.col(f"a_high{k}"))
        gaps = gaps + gap * gap
    return gaps > epsilon * epsilon + SLACK


def block_pairs(boxes: DataFrame, scratch: Scratch, p: int, epsilon: float, fan: int = FAN) -> DataFrame:
    """(a, b), a <= b: the blocks that may hold links, from boxes(seq, d, low0.., high0..)."""
    columns = [f"low{k}" for k in range(p)], [f"high{k}" for k in range(p)]
    levels = [scratch.table(boxes, "boxes")]
    while levels[-1].count() > 1:
        up = levels[-1].groupBy(F.floor(F.col("seq") / fan).alias("seq"), "d").agg(
            *[F.min(c).alias(c) for c in columns[0]], *[F.max(c).alias(c) for c in columns[1]])
        levels.append(scratch.table(up, "boxes"))  # vectors of unlike dimension stay apart
        if levels[-1].agg(F.max("seq")).first()[0] == 0:
            break
    top = levels[-1].select("seq", "d")
    pairs = top.select(F.col("seq").alias("a"), F.col("seq").alias("b"), "d").distinct()
    for level in reversed(levels[:-1]):
        kid = level.withColumn("up", F.floor(F.col("seq") / fan))
        left = kid.select(F.col("up").alias("a"), "d", F.col("seq").alias("a_seq"), *[F.col(c).alias(f"a_{c}") for side in columns for c in side])
        right = kid.select(F.col("up").alias("b"), "d", F.col("seq").alias("b_seq"), *[F.col(c).alias(f"b_{c}") for side in columns for c in side])
        met = pairs.join(left, ["a", "d"]).join(right, ["b", "d"])
        met = met.where((F.col("a_seq") <= F.col("b_seq")) & ~_box_apart(p, epsilon))
        pairs = scratch.table(met.select(F.col("a_seq").alias("a"), F.col("b_seq").alias("b"), "d"), "pairs")
    return pairs


def _compare(threshold: float, kind: str):
    """A stream sorted by stream key: first a block, then its partners."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, own, nodes, weight, count = None, None, None, None, None

        def links(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            cosine = x @ y.T
            found = cosine >= threshold
            for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12):  # within rounding: once more, in long double
                a, b = x[i].astype(np.longdouble), y[j].astype(np.longdouble)
                found[i, j] = float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) >= threshold
            return found

        def counted() -> pd.DataFrame | None:
            if key is None:
                return None
            some = np.flatnonzero(count)
            return pd.DataFrame({"node": nodes[some], "links": count[some], "root": nodes[some]}) if len(some) else None

        for frame in frames:
            for row in frame.itertuples(index=False):
                block = np.frombuffer(row.data, kind).astype(np.float64).reshape(-1, row.d)
                ids, copies = np.asarray(row.nodes), np.asarray(row.copies)
                if row.first:
                    done = counted()
                    if done is not None:
                        yield done
                    key, own, nodes, weight, count = row.stream, _unit(block), ids, copies, np.zeros(len(ids), np.int64)
                    continue
                same = row.partner == row.owner
                found = links(own, own if same else _unit(block))
                if same:
                    np.fill_diagonal(found, False)
                if not found.any():
                    continue
                count += found @ copies
                other = np.zeros(0, np.int64) if same else weight @ found
                # a spanning forest of the links: labels meet at the least number
                mine, theirs = np.arange(len(nodes)), np.arange(len(ids)) + (0 if same else len(nodes))
                top = len(nodes) + len(ids)
                while True:
                    far = mine if same else theirs
                    new = np.minimum(mine, np.where(found, far[None, :], top).min(axis=1))
                    new_far = new if same else np.minimum(theirs, np.where(found, new[:, None], top).min(axis=0))
                    if (new == mine).all() and (same or (new_far == theirs).all()):
                        break
                    mine, theirs = new, new_far
                names = nodes if same else np.concatenate((nodes, ids))
                label = mine if same else np.concatenate((mine, theirs))
                add = np.zeros(len(names), np.int64)
                if not same:
                    add[len(nodes):] = other
                moved = np.flatnonzero((label != np.arange(len(names))) | (add > 0))
                if len(moved):
                    yield pd.DataFrame({"node": names[moved], "links": add[moved], "root": names[label[moved]]})
        done = counted()
        if done is not None:
            yield done
    return run


def embedding_dedup(vectors: DataFrame, scratch: Scratch, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.9, axes: int = AXES, block: int = BLOCK) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link at cosine >= threshold, in double precision; n_links counts
    the other rows, equal vectors included.  component_id is the least vec_id
    reachable.  NULL, all-zero and non-finite vectors (or ones with such
    entries) link with nothing, vectors of unlike dimension not with each
    other.  Rows with a NULL vec_id take part; alone they have a NULL
    component and are kept.  An empty table gives an empty result.
    """
    epsilon = float(np.sqrt(2 - 2 * threshold))
    # single precision input travels as it is; all sums are in double precision
    single = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    rows = scratch.table(valid_vectors(vectors, id_col, vector_col).withColumns(
        {"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x"), "d": F.size("x")}), "vectors")
    # equal vectors are one node; grouping by the vector itself keeps it exact
    nodes = rows.where("x is not null").groupBy("h1", "h2", "d", "x").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = scratch.table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    turn = principal_axes(nodes, axes)
    p = turn.shape[1]
    placed = nodes.select("node", "d", "copies", "x").mapInArrow(
        _project(turn, epsilon), "node long, d int, copies long, cell array<int>, at array<double>, x array<double>")
    placed = scratch.table(placed, "cells")
    order = ["d", "cell", "node"]
    cut = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks(block, kind), "part long, no long, d int, nodes array<long>, copies array<long>, low array<double>, high array<double>, data binary")
    cut = scratch.table(cut, "blocks")
    # number the blocks along the whole sequence: one row a partition passes the window
    parts = cut.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    blocks = scratch.table(cut.join(parts, "part").withColumn("seq", F.col("start") + F.col("no")).drop("part", "start", "no"), "numbered")
    boxes = blocks.select("seq", "d", *[F.col("low")[k].alias(f"low{k}") for k in range(p)], *[F.col("high")[k].alias(f"high{k}") for k in range(p)])
    pairs = block_pairs(boxes, scratch, p, epsilon)

    # the even sums belong to the lower block, the odd ones to the upper
    even = (F.col("a") + F.col("b")) % 2 == 0
    tasks = pairs.select(F.when(even, F.col("a")).otherwise(F.col("b")).alias("owner"), F.when(even, F.col("b")).otherwise(F.col("a")).alias("partner"))
    degree = tasks.groupBy("owner").agg(F.ceil(F.count("*") / PARTNERS).alias("cuts"))
    tasks = tasks.join(degree, "owner").withColumn("cut", F.pmod(F.xxhash64("partner"), F.col("cuts")))
    tasks = scratch.table(tasks.withColumn("stream", F.xxhash64("owner", "cut")), "tasks")
    shape = ["d", "nodes", "copies", "data"]
    heads = tasks.select("stream", "owner").distinct().join(blocks, F.col("owner") == F.col("seq")).select(
        "stream", "owner", F.col("owner").alias("partner"), F.lit(True).alias("first"), *shape)
    others = tasks.join(blocks, F.col("partner") == F.col("seq")).select("stream", "owner", "partner", F.lit(False).alias("first"), *shape)
    stream = heads.unionByName(others).repartition("stream").sortWithinPartitions("stream", "owner", F.desc("first"), "partner")
    found = scratch.table(stream.mapInPandas(_compare(threshold, kind), "node long, links long, root long"), "links")

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    together = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), scratch)
    known = nodes.join(together, "node", "left").join(counts, "node", "left").select(
        "h1", "h2", "d", "x", "copies", "least_id", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    least = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = scratch.table(known.join(least, "component").select(
        "h1", "h2", "d", "x", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "known")
    linked = rows.where("x is not null").join(known, ["h1", "h2", "d", "x"])
    alone = rows.where("x is null")
    return linked.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(
        alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
