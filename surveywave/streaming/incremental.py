"""Incremental refresh: recompute only the families a batch touches.

Every window of the facts is partitioned by family (is_last per family; the
sequence per family × survey; scores per family × indicator), so a family's
rows depend on that family's snapshots, responses, priorities and achievements
only.  A batch may hold new or changed rows of all four tables.  Affected are

* the old and the new family of every snapshot in it,
* the family of every response in it, now and where it was stored before,
* the family of the response that a priority or achievement in it belongs to.

    kept      = previous facts  ⋉̸ affected families      (anti join)
    rebuilt   = facts over the raw rows of the affected families
    refreshed = kept ∪ rebuilt

which equals a full rebuild.  A NULL family is a family like any other: all
joins by family match NULL with NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveywave.plans.warehouse import Warehouse


class OverrideSource:
    """A raw source with some tables replaced (a slice or a new batch)."""

    def __init__(self, base, overrides: dict[str, DataFrame]):
        self.base = base
        self.overrides = overrides

    def table(self, name: str) -> DataFrame:
        if name in self.overrides:
            return self.overrides[name]
        return self.base.table(name)


def restrict_to_snapshots(source, snapshots: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> OverrideSource:
    """Raw tables limited to the given raw snapshot rows and their responses,
    priorities, achievements and economic answers.  ``stage`` stores the responses,
    which the others are selected by, so that plans built on this do not repeat
    the selection inside each other."""
    ids = snapshots.select(F.col("id").alias("snapshot_id"))
    responses = stage(source.table("snapshot_stoplight").join(ids, "snapshot_id", "left_semi"))
    rid = responses.select(F.col("id").alias("snapshot_stoplight_id"))
    return OverrideSource(source, {
        "snapshot": snapshots,
        "snapshot_stoplight": responses,
        "snapshot_stoplight_priority": source.table("snapshot_stoplight_priority").join(
            rid, "snapshot_stoplight_id", "left_semi"),
        "snapshot_stoplight_achievement": source.table("snapshot_stoplight_achievement").join(
            rid, "snapshot_stoplight_id", "left_semi"),
        "snapshot_economic": source.table("snapshot_economic").join(ids, "snapshot_id", "left_semi"),
    })


def by_family(df: DataFrame, families: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on family_id in which NULL matches NULL."""
    f = families.select(F.col("family_id").alias("_family"))
    return df.join(f, df["family_id"].eqNullSafe(f["_family"]), how)


def affected_families(wh_full: Warehouse, previous: dict[str, DataFrame], batch: dict[str, DataFrame]) -> DataFrame:
    """Distinct families (NULL included) that a batch of raw rows touches.

    batch: raw table name → its new or changed rows, any of ``snapshot``,
    ``snapshot_stoplight``, ``snapshot_stoplight_priority`` and
    ``snapshot_stoplight_achievement``."""
    now = wh_full.raw("snapshot").select(F.col("id").alias("snapshot_id"), "family_id")
    before = previous["fact_snapshots"].select("snapshot_id", "family_id")
    parts: list[DataFrame] = []

    def of_snapshots(ids: DataFrame) -> None:
        parts.extend([t.join(ids, "snapshot_id", "left_semi").select("family_id") for t in (now, before)])

    def of_responses(ids: DataFrame) -> None:
        held = wh_full.raw("snapshot_stoplight").select(F.col("id").alias("snapshot_stoplight_id"), "snapshot_id")
        of_snapshots(held.join(ids, "snapshot_stoplight_id", "left_semi").select("snapshot_id"))
        parts.append(previous["fact_indicators"].select("snapshot_stoplight_id", "family_id")
                     .join(ids, "snapshot_stoplight_id", "left_semi").select("family_id"))

    if "snapshot" in batch:
        parts.append(batch["snapshot"].select("family_id"))
        of_snapshots(batch["snapshot"].select(F.col("id").alias("snapshot_id")))
    if "snapshot_stoplight" in batch:
        of_snapshots(batch["snapshot_stoplight"].select("snapshot_id"))
        of_responses(batch["snapshot_stoplight"].select(F.col("id").alias("snapshot_stoplight_id")))
    for name in ("snapshot_stoplight_priority", "snapshot_stoplight_achievement"):
        if name in batch:
            of_responses(batch[name].select("snapshot_stoplight_id"))
    return reduce(DataFrame.unionByName, parts).distinct()


def refresh_facts(wh_full: Warehouse, previous: dict[str, DataFrame], batch: dict[str, DataFrame],
                  models=("fact_snapshots", "fact_indicators")) -> dict[str, DataFrame]:
    """Refresh stored facts after the rows of ``batch`` arrived.

    ``previous`` holds both facts as they were; ``wh_full`` sees the complete
    raw data (previous + batch).  Only affected families are recomputed."""
    affected = wh_full.stage(affected_families(wh_full, previous, batch))
    fresh = rebuilt_facts(wh_full, affected)
    return {m: by_family(previous[m], affected, "left_anti").unionByName(fresh[m]) for m in models}


def rebuilt_facts(wh_full: Warehouse, affected: DataFrame) -> dict[str, DataFrame]:
    """Both facts over the raw rows of the affected families.  Dimensions are
    read as ``wh_full`` sees them now; a batch does not restate them."""
    scoped = restrict_to_snapshots(wh_full.source, by_family(wh_full.raw("snapshot"), affected, "left_semi"), wh_full.stage)
    wh_aff = Warehouse(wh_full.spark, scoped, epoch_unit=wh_full.epoch_unit)
    for dim in ("dim_family", "dim_organization", "dim_survey_definition", "stg_survey_stoplight"):
        wh_aff.use(dim, wh_full.m(dim))
    return {m: wh_aff.m(m) for m in ("fact_snapshots", "fact_indicators")}


def replay(wh: Warehouse, cutoff_epoch: int, late_from_epoch: int) -> tuple[Warehouse, list[tuple[Warehouse, dict[str, DataFrame]]]]:
    """The raw tables as three batches that came one after the other: the
    Warehouse before them, and for each batch the Warehouse that sees the raw
    rows with it, and its rows.

    1. every snapshot from ``cutoff_epoch`` on, with its responses;
    2. the responses of the snapshots from ``late_from_epoch`` up to the cutoff,
       which come late, and all priorities and achievements on them;
    3. the snapshots before ``late_from_epoch`` whose family is told only now
       (odd organizations) or has moved (even ones).
    """
    snaps, responses = wh.raw("snapshot"), wh.raw("snapshot_stoplight")
    date = F.col("snapshot_date")
    new, late = date >= cutoff_epoch, (date >= late_from_epoch) & (date < cutoff_epoch)
    moved = (date < late_from_epoch) & (F.coalesce("project_id", F.lit(0)) == F.coalesce(F.col("organization_id"), F.lit(0)))
    untold = moved & (F.col("organization_id") % 2 == 1)
    unmoved = snaps.withColumn(
        "family_id", F.when(untold, F.lit(None)).when(moved, F.col("family_id") + 1).otherwise(F.col("family_id")))
    late_ids = snaps.where(late).select(F.col("id").alias("snapshot_id"))

    def seen(snapshots: DataFrame, with_late: bool) -> Warehouse:
        source = restrict_to_snapshots(wh.source, snapshots, wh.stage)
        if not with_late:
            source.overrides["snapshot_stoplight"] = source.table("snapshot_stoplight").join(late_ids, "snapshot_id", "left_anti")
        return Warehouse(wh.spark, source, epoch_unit=wh.epoch_unit)

    def batch(of: Column) -> dict[str, DataFrame]:
        ids = snaps.where(F.coalesce(of, F.lit(False))).select(F.col("id").alias("snapshot_id"))
        arrived = wh.stage(responses.join(ids, "snapshot_id", "left_semi"))
        rid = arrived.select(F.col("id").alias("snapshot_stoplight_id"))
        return {"snapshot_stoplight": arrived, **{t: wh.stage(wh.raw(t).join(rid, "snapshot_stoplight_id", "left_semi"))
                                                  for t in ("snapshot_stoplight_priority", "snapshot_stoplight_achievement")}}

    before = seen(unmoved.where(~F.coalesce(new, F.lit(False))), False)
    return before, [
        (seen(unmoved, False), {"snapshot": snaps.where(F.coalesce(new, F.lit(False))), **batch(new)}),
        (seen(unmoved, True), batch(late)),
        (wh, {"snapshot": snaps.where(F.coalesce(moved, F.lit(False)))})]


def demo_refresh(wh: Warehouse, cutoff_epoch: int, late_from_epoch: int) -> DataFrame:
    """The refreshed fact_indicators after the three batches of ``replay`` as one."""
    before, batches = replay(wh, cutoff_epoch, late_from_epoch)
    whole: dict[str, DataFrame] = {}
    for _, rows in batches:
        for name, df in rows.items():
            whole[name] = whole[name].unionByName(df) if name in whole else df
    previous = {m: before.m(m) for m in ("fact_snapshots", "fact_indicators")}
    return refresh_facts(wh, previous, whole)["fact_indicators"]
