"""Incremental refresh against the full rebuild; late parents as a stream."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from surveywave.plans.warehouse import Warehouse
from surveywave.sources import open_source
from surveywave.streaming import incremental, late_parents
from surveywave.streaming.incremental import OverrideSource, refresh_facts, restrict_to_snapshots
from surveywave.streaming.late_parents import RESOLVED_SCHEMA, close, resolve_late_parents, stage_arrivals
from tests.conftest import SF_SMALL

MODELS = ("fact_snapshots", "fact_indicators")


@pytest.fixture(scope="module")
def now(spark):
    """The complete raw data, some snapshots of which have no family."""
    source = open_source(spark, SF_SMALL)
    snaps = source.table("snapshot")
    return OverrideSource(source, {"snapshot": snaps.withColumn("family_id", F.when(F.col("id") % 13 != 0, F.col("family_id")))})


@pytest.fixture(scope="module")
def full(spark, now):
    wh = Warehouse(spark, now)
    return wh, {m: wh.m(m).collect() for m in MODELS}


def _check(spark, full, before, batch):
    wh, expected = full
    old = Warehouse(spark, before)
    out = refresh_facts(wh, {m: old.m(m) for m in MODELS}, batch)
    changed = sorted(map(str, old.m("fact_indicators").collect())) != sorted(map(str, expected["fact_indicators"]))
    assert changed  # the batch matters
    for m in MODELS:
        assert sorted(map(str, out[m].collect())) == sorted(map(str, expected[m]))


def test_new_snapshots(spark, now, full):
    snaps = now.table("snapshot")
    new = snaps.where("id % 5 = 0")
    ids = new.select(F.col("id").alias("snapshot_id"))
    _check(spark, full, restrict_to_snapshots(now, snaps.where("id % 5 <> 0")),
           {"snapshot": new, "snapshot_stoplight": now.table("snapshot_stoplight").join(ids, "snapshot_id", "left_semi")})


def test_late_responses(spark, now, full):
    responses = now.table("snapshot_stoplight")
    _check(spark, full, OverrideSource(now, {"snapshot_stoplight": responses.where("id % 9 <> 0")}),
           {"snapshot_stoplight": responses.where("id % 9 = 0")})


@pytest.mark.parametrize("table", ["snapshot_stoplight_priority", "snapshot_stoplight_achievement"])
def test_late_priorities_and_achievements(spark, now, full, table):
    rows = now.table(table)
    _check(spark, full, OverrideSource(now, {table: rows.where("id % 3 <> 0")}), {table: rows.where("id % 3 = 0")})


def test_moved_families(spark, now, full):
    snaps = now.table("snapshot")
    moved = F.col("id") % 7 == 0
    before = snaps.withColumn("family_id", F.when(moved, F.col("family_id") + 1).otherwise(F.col("family_id")))
    _check(spark, full, restrict_to_snapshots(now, before), {"snapshot": snaps.where(moved)})


def test_families_that_become_known_or_unknown(spark, now, full):
    snaps = now.table("snapshot")
    turned = F.col("id") % 6 == 0
    before = snaps.withColumn("family_id", F.when(turned & F.col("family_id").isNull(), 1).when(turned, None).otherwise(F.col("family_id")))
    _check(spark, full, restrict_to_snapshots(now, before), {"snapshot": snaps.where(turned)})


def _rows(spark, low, high, day, kind):
    at = f"timestamp'2025-01-01' + make_interval(0, 0, 0, {day}) created_date"
    if kind == "priority":
        return spark.range(low, high).where("id >= 0").selectExpr("id", "id snapshot_stoplight_id", at)
    return spark.range(low, high).where("id >= 0").selectExpr("id", "id * 10 snapshot_id", at)


def test_late_parents_with_orphans_batch_by_batch(spark):
    """Twelve days; the responses of a day's 100 priorities are synced two days
    later, a tenth of them never.  Orphans come out once, when the watermark has
    passed them, and the state stays as large as a few days."""
    work = tempfile.mkdtemp(prefix="surveywave-late-")
    arrivals, state, read = f"{work}/arrivals", [], []
    for n in range(12):
        parents = _rows(spark, (n - 2) * 100, (n - 1) * 100, n - 2, "response").where("id % 10 <> 0")
        stage_arrivals(spark, arrivals, _rows(spark, n * 100, n * 100 + 100, n, "priority").coalesce(1), parents.coalesce(1))
        query = resolve_late_parents(spark, arrivals, work, late="2 days", apart="1 hour")
        state.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) == 0
    out = spark.read.schema(RESOLVED_SCHEMA).parquet(f"{work}/resolved")
    assert max(state[5:]) <= state[4] and max(read) <= 200  # neither state nor reading grows with history
    assert out.where("is_orphan and priority_id < 500").count() == 50  # before the stream is closed
    close(spark, arrivals, "2 days", "1 hour")
    last = resolve_late_parents(spark, arrivals, work, late="2 days", apart="1 hour")
    assert last.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 1  # the tick itself
    out = spark.read.schema(RESOLVED_SCHEMA).parquet(f"{work}/resolved")
    got = {tuple(r) for r in out.collect()}
    assert out.count() == len(got) == 1200
    assert got == {(i, i, None, True) if i % 10 == 0 or i >= 1000 else (i, i, i * 10, False) for i in range(1200)}


def test_a_replayed_batch_writes_once(spark):
    work = tempfile.mkdtemp(prefix="surveywave-late-")
    arrivals = f"{work}/arrivals"
    stage_arrivals(spark, arrivals, _rows(spark, 0, 50, 0, "priority"), _rows(spark, 0, 40, 0, "response"))
    resolve_late_parents(spark, arrivals, work)
    close(spark, arrivals)
    resolve_late_parents(spark, arrivals, work)
    read = lambda: sorted(map(str, spark.read.schema(RESOLVED_SCHEMA).parquet(f"{work}/resolved").collect()))
    before = read()
    assert len(before) == 50
    commits = [f for f in os.listdir(f"{work}/_checkpoint/commits") if f.isdigit()]
    last = max(commits, key=int)  # as if the run had failed before its last commit
    for f in (last, f".{last}.crc"):
        os.path.exists(f"{work}/_checkpoint/commits/{f}") and os.remove(f"{work}/_checkpoint/commits/{f}")
    resolve_late_parents(spark, arrivals, work)
    assert read() == before


def test_responses_before_priorities_and_rows_without_a_key(spark):
    work = tempfile.mkdtemp(prefix="surveywave-late-")
    arrivals = f"{work}/arrivals"
    stage_arrivals(spark, arrivals, responses=_rows(spark, 0, 5, 0, "response"))
    resolve_late_parents(spark, arrivals, work, apart="2000 days")
    keyless = spark.createDataFrame([(100, None), (101, 3)], "id long, snapshot_stoplight_id long").withColumn("created_date", F.lit(None).cast("timestamp"))
    stage_arrivals(spark, arrivals, priorities=_rows(spark, 0, 6, 1, "priority").unionByName(keyless))
    resolve_late_parents(spark, arrivals, work, apart="2000 days")
    close(spark, arrivals, apart="2000 days")
    resolve_late_parents(spark, arrivals, work, apart="2000 days")
    got = {r.priority_id: (r.snapshot_id, r.is_orphan) for r in spark.read.schema(RESOLVED_SCHEMA).parquet(f"{work}/resolved").collect()}
    assert got == {**{i: (i * 10, False) for i in range(5)}, 5: (None, True), 100: (None, True), 101: (30, False)}


def test_a_replay_is_cut_into_batches_by_size(spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    rows = spark.range(1, 41).selectExpr("id", "id AS snapshot_stoplight_id", "CAST('2020-01-01' AS timestamp) AS created_date").repartition(10)
    late_parents.stage_arrivals(spark, arrivals, priorities=rows)
    query = late_parents.resolve_late_parents(spark, arrivals, str(tmp_path / "work"), late_parents.REPLAY_BATCH)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [40]


def test_a_replay_selects_rows_once(wh_small):
    """What the batches are selected by is stored: plans do not nest selections."""
    before, batches = incremental.replay(wh_small, 946684800, 883612800)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df in (x for _, rows in batches for t, x in rows.items() if t != "snapshot"):
        assert "Join" not in plan(df) and "Aggregate" not in plan(df)
    held = plan(before.raw("snapshot_stoplight_priority"))  # three kinds of rows, each selected once
    assert held.count("Join") <= 3 and "Aggregate" not in held
