"""Ordered sequencing within groups, with no task per group.

Every ordered window of the survey model is one of: a running number
(``row_number``), the previous value (``lag``), the first value of the group,
the group size, or a whole-group max.  ``sequence`` computes them together, in
the same way at every size:

1. the rows are range-partitioned on (group, order), sorted and stored with the
   number of their partition and their place in the order, so every group lies
   in consecutive *chunks* and a group that holds a third of all rows is cut into
   many;
2. one window per (chunk, group) numbers the rows of a chunk; a chunk moves whole
   and in order (by range of its number), not dealt by group;
3. only the first and the last group of a chunk can go on in another one.  For
   those, at most two a chunk, an aggregate over the stored rows gives the size,
   ends and max of each piece (summed up before it is shuffled, so no row of a
   hot group moves for it), and a prefix scan over the pieces the rows before
   them, the value that precedes them and the group's first value, size and max.

The store is a table in the shared folder, read by column: steps 2 and 3 see the
same chunks, since range partitioning samples its borders anew for each plan.
``store`` lets the caller own the table and remove it once the result is stored.
Where no group is large all that is not needed: ``small`` names columns of the
group whose rows a task can hold, and rows meet by them in one shuffle, with no
table and no second move.

The border groups and their pieces are two rows for each partition of the input;
they are broadcast as long as that is at most BROADCAST_ROWS, and joined by a
shuffle beyond.  The result equals the single window; no row is dropped or
sampled, and nothing is counted or collected while the plan is built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveywave.session import checkpoint_dir


BROADCAST_ROWS = 200_000


def stored_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: reliable, and read by column."""
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/sequence-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _windows(df: DataFrame, keys, order, number, size, lag, first, group_max) -> list[Column]:
    w = Window.partitionBy(*keys).orderBy(*order)
    # Whole-partition frame on the same ordering: shares the sort with ``w``.
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = []
    if number:
        cols.append(F.row_number().over(w).cast("long").alias(number))
    if size:
        cols.append(F.count(F.lit(1)).over(whole).cast("long").alias(size))
    cols += [F.lag(src).over(w).alias(out) for out, src in lag.items()]
    cols += [F.first(src).over(whole).alias(out) for out, src in first.items()]
    cols += [F.max(expr).over(whole).alias(out) for out, expr in group_max.items()]
    return cols


def window_sequence(df: DataFrame, group: Sequence[str], order: Sequence[Column], *, number: str | None = None,
                    size: str | None = None, lag: dict[str, str] | None = None, first: dict[str, str] | None = None,
                    group_max: dict[str, Column] | None = None) -> DataFrame:
    """The plain window, for groups that are small by their nature."""
    return df.select("*", *_windows(df, group, order, number, size, lag or {}, first or {}, group_max or {}))


def sequence(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    *,
    number: str | None = None,
    size: str | None = None,
    lag: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    group_max: dict[str, Column] | None = None,
    store: Callable[[DataFrame], DataFrame] | None = None,
    chunks: int | None = None,
    small: Sequence[str] = (),
) -> DataFrame:
    """Add ordered-window columns per ``group``.

    number     row_number() as long
    size       rows in the group (= max of number) as long
    lag        out → source column: value of the preceding row (NULL on first)
    first      out → source column: value on the first row of the group
    group_max  out → Column: max of that expression over the whole group
    ``order`` must be a total order (spell NULL placement explicitly).
    ``store`` makes the ranged rows durable (a table in the shared folder if
    not given); ``chunks`` is the number of range partitions (the shuffle setting
    if not given).  ``small``: columns of ``group``, if it is known that a task can
    hold all rows of any value of them.
    """
    if small:
        return window_sequence(df.repartition(*small), group, order, number=number, size=size, lag=lag, first=first, group_max=group_max)
    lag, first, group_max = lag or {}, first or {}, group_max or {}
    by = [*[F.col(g).asc_nulls_first() for g in group], *order]
    ranged = df.repartitionByRange(chunks, *by) if chunks else df.repartitionByRange(*by)
    ranged = ranged.sortWithinPartitions(*by).withColumns({"_chunk": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    ranged = (store or stored_table)(ranged)

    key = F.struct(*group)  # structs order like the range: NULL first
    ends = ranged.groupBy("_chunk").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    border = ends.select("_chunk", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_g"))
    # the pieces of border groups, those in chunks that they only pass through too
    border = border.select("_g.*").distinct()
    count = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = F.broadcast if 2 * count <= BROADCAST_ROWS else lambda side: side  # two rows a chunk
    pieces = _join(ranged, small(border), group, "left_semi").groupBy("_chunk", *group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max_by(src, "_at").alias(f"_last_{o}") for o, src in lag.items()],
        *[F.min_by(src, "_at").alias(f"_first_{o}") for o, src in first.items()],
        *[F.max(expr).alias(f"_max_{o}") for o, expr in group_max.items()])

    along = Window.partitionBy(*group).orderBy("_chunk")
    every = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_chunk", *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(every).alias("_size"),
        *[F.lag(f"_last_{o}").over(along).alias(f"_prev_{o}") for o in lag],
        *[F.first(f"_first_{o}").over(every).alias(f"_first_{o}") for o in first],
        *[F.max(f"_max_{o}").over(every).alias(f"_max_{o}") for o in group_max])

    whole = ranged.repartitionByRange("_chunk")  # clustered by (chunk, group) too: the window adds no exchange
    local = whole.select("*", *_windows(whole, ["_chunk", *group], [F.col("_at")], "_l_number", size and "_l_size",
                                         {f"_l_{o}": s for o, s in lag.items()}, {f"_l_{o}": s for o, s in first.items()},
                                         {f"_l_{o}": e for o, e in group_max.items()}))
    joined = _join(local, small(pieces), ["_chunk", *group], "left")
    cut = F.col("_before").isNotNull()
    outs = []
    if number:
        outs.append((F.col("_l_number") + F.coalesce("_before", F.lit(0))).cast("long").alias(number))
    if size:
        outs.append(F.coalesce("_size", "_l_size").cast("long").alias(size))
    outs += [F.when(cut & (F.col("_l_number") == 1), F.col(f"_prev_{o}")).otherwise(F.col(f"_l_{o}")).alias(o) for o in lag]
    outs += [F.when(cut, F.col(f"_first_{o}")).otherwise(F.col(f"_l_{o}")).alias(o) for o in first]
    outs += [F.when(cut, F.col(f"_max_{o}")).otherwise(F.col(f"_l_{o}")).alias(o) for o in group_max]
    return joined.select(*[joined[c] for c in df.columns], *outs)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match; the right side's keys go."""
    names = {k: f"_r_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    cond = None
    for k, r in names.items():
        c = left[k].eqNullSafe(right[r])
        cond = c if cond is None else cond & c
    out = left.join(right, cond, how)
    return out if how == "left_semi" else out.drop(*names.values())
