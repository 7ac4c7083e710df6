"""Facts and the flow aggregate kept current batch by batch, in place.

The facts are published tables cut into buckets by family (``plans.store``).  A
batch rebuilds the families it touches (``incremental``), and only the buckets
those lie in are written; the files of all other buckets stay as they are.

The flow aggregate of the dashboard (13 keys, a count and a net change) is not
computed again from the facts but by signed deltas: rows of buckets that differ
between two versions of the fact count −1 in the old one and +1 in the new one.
Unchanged rows cancel, groups whose count comes to 0 go.  The state keeps how many
rows of a group have both scores, since the net change is NULL without any.  Its
version names the fact version it stands for, so a run that fails between the
two is made up for by the next one: catching up is the same step, whatever lies
between.  The dashboard table is the state with names looked up; nothing of it
is aggregated again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveywave.plans import marts
from surveywave.plans.store import TableStore, Version, bucket_of
from surveywave.plans.warehouse import CLUSTER_COLUMNS, Warehouse
from surveywave.session import checkpoint_dir
from surveywave.streaming.incremental import affected_families, by_family, rebuilt_facts, replay

FACTS = ("fact_snapshots", "fact_indicators")
FAMILY = ["family_id"]
STATE_SUMS = ["family_count", "net_sum", "net_rows"]


def flow_contributions(fact_indicators: DataFrame, sign: int = 1) -> DataFrame:
    """What the rows add to each group: one row a group."""
    net = F.col("current_score") - F.col("baseline_score")
    return fact_indicators.groupBy(*marts.FLOW_KEYS).agg(
        (sign * F.count(F.lit(1))).alias("family_count"),
        F.coalesce(sign * F.sum(net), F.lit(0)).cast("long").alias("net_sum"),
        (sign * F.count(net)).alias("net_rows"))


def summed(*parts: DataFrame) -> DataFrame:
    """The sum of contributions; groups to which nothing is added go."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    total = rows.groupBy(*marts.FLOW_KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in STATE_SUMS])
    # a delta may move the net change and leave the count
    return total.where(" OR ".join(f"{c} <> 0" for c in STATE_SUMS))


def flow_from_state(state: DataFrame) -> DataFrame:
    """The flow aggregate, as ``marts.flow_aggregate`` gives it."""
    return state.select(*marts.FLOW_KEYS, "family_count", F.when(F.col("net_rows") > 0, F.col("net_sum")).alias("net_change_numeric"))


class MaintainedMarts:
    """Published facts and flow state under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        self.facts = {m: TableStore(spark, f"{root.rstrip('/')}/{m}") for m in FACTS}
        self.flow = TableStore(spark, f"{root.rstrip('/')}/flow_state")

    def build(self, wh: Warehouse) -> None:
        """The first version, from all raw rows."""
        for m in FACTS:
            self.facts[m].replace(wh.m(m), keys=FAMILY, buckets=self.buckets, sort=CLUSTER_COLUMNS[m])
        self.refresh_flow()

    def apply(self, wh: Warehouse, batch: dict[str, DataFrame]) -> dict[str, Version]:
        """Bring in a batch of raw rows; ``wh`` sees the raw data with it."""
        at = {m: self.facts[m].version() for m in FACTS}
        previous = {m: self.facts[m].read(at[m].number) for m in FACTS}
        affected = wh.stage(affected_families(wh, previous, batch))
        # at most one number for each bucket
        touched = sorted(r[0] for r in affected.select(bucket_of(FAMILY, self.buckets)).distinct().collect())
        done = {}
        if touched:
            fresh = rebuilt_facts(wh, affected)
            for m in FACTS:
                kept = by_family(self.facts[m].read(at[m].number, touched), affected, "left_anti")
                done[m] = self.facts[m].replace_buckets(kept.unionByName(fresh[m]), touched, at[m].number, sort=CLUSTER_COLUMNS[m])
        self.refresh_flow()
        return done

    def refresh_flow(self) -> Version:
        """Bring the flow state to the latest version of fact_indicators."""
        fact, state = self.facts["fact_indicators"], self.flow.version()
        now = fact.version()
        if state is not None and state.info["of"] == now.number:
            return state
        info = {"of": now.number}
        if state is None:
            return self.flow.replace(flow_contributions(fact.read(now.number)), 0, keys=marts.FLOW_KEYS, buckets=self.buckets, info=info)
        before = fact.version(state.info["of"])
        differ = sorted(b for b in {*now.folders, *before.folders} if now.folders.get(b) != before.folders.get(b))
        delta = summed(flow_contributions(fact.read(now.number, differ)), flow_contributions(fact.read(before.number, differ), -1))
        delta = delta.checkpoint(eager=True)
        # at most one number for each bucket
        touched = sorted(r[0] for r in delta.select(bucket_of(marts.FLOW_KEYS, self.buckets)).distinct().collect())
        return self.flow.replace_buckets(summed(self.flow.read(state.number, touched), delta), touched, state.number, info=info)

    # -- tables ---------------------------------------------------------------
    def fact(self, name: str) -> DataFrame:
        return self.facts[name].read()

    def flow_aggregate(self) -> DataFrame:
        return flow_from_state(self.flow.read())

    def mart_indicators(self, wh: Warehouse) -> DataFrame:
        return marts.decorate_flow(self.flow_aggregate(), wh.m("dim_organization"), wh.m("dim_indicator_questions"),
                                   wh.m("dim_survey_definition"), wh.m("stg_projects"))


def replayed(wh: Warehouse, cutoff_epoch: int, late_from_epoch: int) -> MaintainedMarts:
    """Marts built before the batches of ``incremental.replay`` and kept current
    through them; made once for a Warehouse."""
    if wh.replayed is None:
        before, batches = replay(wh, cutoff_epoch, late_from_epoch)
        made = MaintainedMarts(wh.spark, f"{checkpoint_dir(wh.spark).rstrip('/')}/maintained-{uuid.uuid4().hex}")
        made.build(before)
        for seen, batch in batches:
            made.apply(seen, batch)
        wh.replayed = made
    return wh.replayed
