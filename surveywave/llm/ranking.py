"""Ranks inside groups without a task per group.

The rows are range-partitioned on (group, order), sorted and written, so a group
that holds a third of all rows lies in many consecutive partitions.  The stored
row number rises along that order; a group's rank is its distance from the first
row the group has in its partition, plus what the group has in earlier ones.
Only one row for each partition and group is summed up by a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[Column], scratch: Scratch, name: str) -> DataFrame:
    """rows with _place (rises along group and order), _rank (from 0 in each
    group) and _size (rows of the group), as longs.

    Rows that are equal in group and order come in any order, but in one that
    does not change afterwards; a number of their own keeps many equal rows from
    meeting in one partition.  NULLs are values of the group, and come first.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in group] + list(order) + [F.col("_tie").asc()]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = scratch.table(dealt.drop("_tie").withColumns({"_place": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}), name)
    pieces = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    pieces = pieces.select(*group, "_part", (F.sum("_n").over(whole.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"),
                           F.sum("_n").over(whole).alias("_size"))
    pieces = scratch.table(pieces, f"{name}-pieces").select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_shift", "_size")
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(pieces, same).withColumn("_rank", F.col("_place") + F.col("_shift")).drop(
        "_part", "_p", "_shift", *[f"_g{i}" for i in range(len(group))])
