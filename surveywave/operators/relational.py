"""Relational building blocks shared by the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (DISTINCT ON / dedup by row_number).

    ``row_number() = 1`` lets Catalyst insert a WindowGroupLimit on both sides
    of the shuffle, so a hot key is cut to one row per map task before it is
    shuffled (a partial top-1, like a map-side combine)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_keep_rn", F.row_number().over(w))
              .filter(F.col("_keep_rn") == 1).drop("_keep_rn"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; keeps one copy of each key."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    return out.drop(*[f"_r_{k}" for k in keys])


def pivot_max(df: DataFrame, key: str, pivot_col: str, value_col: str,
              values: dict) -> DataFrame:
    """Rows → columns: max(case when pivot = v then value end) per key.

    ``values`` maps pivot value → output column; listing the values avoids
    the extra distinct job of an open ``pivot``."""
    aggs = [F.max(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(name)
            for v, name in values.items()]
    return df.filter(F.col(pivot_col).isin(list(values))).groupBy(key).agg(*aggs)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """ORDER BY … LIMIT k → TakeOrderedAndProject (per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)
