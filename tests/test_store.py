"""Published tables: versions, conflicts, buckets; marts kept current in place."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from surveywave.plans import marts
from surveywave.plans.store import Conflict, TableStore, bucket_of
from surveywave.plans.warehouse import Warehouse
from surveywave.sources import open_source
from surveywave.streaming.incremental import OverrideSource, replay
from surveywave.streaming.maintain import MaintainedMarts
from tests.conftest import SF_SMALL


def _store(spark):
    return TableStore(spark, tempfile.mkdtemp(prefix="surveywave-store-") + "/t")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_versions_are_whole_and_stay(spark):
    store = _store(spark)
    assert store.version() is None
    with pytest.raises(FileNotFoundError):
        store.read()
    store.replace(spark.range(100).withColumn("v", F.lit("a")), by=["v"], sort=["id"])
    old = store.read()  # opened before the swap, read after it
    store.replace(spark.range(7).withColumn("v", F.lit(2)))
    assert old.count() == 100 and store.read().count() == 7 and store.read(1).where("v = 'a'").count() == 100
    assert store.read().schema["v"].dataType.simpleString() == "int" and store.versions() == [1, 2]


def test_no_reader_sees_a_table_half_written(spark):
    store = _store(spark)
    store.replace(spark.range(10))
    with pytest.raises(Exception, match="broken"):
        store.replace(spark.range(1000).selectExpr("if(id = 999, raise_error('broken'), id) id"))
    assert store.versions() == [1] and store.read().count() == 10
    made = store._write(spark.range(5), 2, [], 0, [], [], None)  # data is there, the pointer not yet
    assert made and store.read().count() == 10


def test_two_writers_cannot_both_win(spark):
    store, other = _store(spark), None
    store.replace(spark.range(10))
    other = TableStore(spark, store.path)
    start = store.version().number
    other.replace(spark.range(20), expected=start)
    with pytest.raises(Conflict):
        store.replace(spark.range(30), expected=start)
    assert store.read().count() == 20 and store.versions() == [1, 2]
    assert len([d for d in os.listdir(store.path) if d.startswith("_v=")]) == 2  # the loser left nothing


def _files(store, version):
    out = {}
    for bucket, folders in version.folders.items():
        for f in folders:
            top = f"{store.path}/{f}"
            out.update({f"{top}/{n}": (bucket, os.stat(f"{top}/{n}").st_mtime_ns) for n in os.listdir(top)})
    return out


def test_buckets_that_are_not_touched_keep_their_files(spark):
    store = _store(spark)
    df = spark.range(1000).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), F.lit(1).alias("x"))
    first = store.replace(df, keys=["k"], buckets=16, sort=["k"])
    before = _files(store, first)
    with_bucket = store.read().withColumn("b", bucket_of(["k"], 16))
    touched = sorted(r.b for r in with_bucket.where("k in (3, 4) or k is null").select("b").distinct().collect())
    fresh = with_bucket.where(F.col("b").isin(touched)).withColumn("x", F.lit(2)).drop("b")
    second = store.replace_buckets(fresh, touched, 1)
    after = _files(store, second)
    kept = {f: m for f, m in before.items() if m[0] not in touched}
    assert kept and all(after[f] == m for f, m in kept.items())
    assert store.read().count() == 1000 and store.read(1).where("x = 2").count() == 0
    assert store.read().where("x = 2").count() == fresh.count() and store.read(2, touched).count() == fresh.count()
    with pytest.raises(ValueError):
        store.replace_buckets(fresh, touched[:1], 2)
    assert store.versions() == [1, 2]
    n = fresh.count()
    store.vacuum(keep=1)  # `fresh` reads version 1, which is gone now
    assert store.versions() == [2] and store.read().count() == 1000
    # buckets can become empty, and a table too
    store.replace_buckets(spark.createDataFrame([], fresh.schema), touched, 2)
    assert store.read().where("x = 2").count() == 0 and store.read().where("x = 1").count() == 1000 - n


def test_a_table_with_no_rows(spark):
    store = _store(spark)
    store.replace(spark.range(0), keys=["id"], buckets=4)
    assert store.read().columns == ["id"] and store.read().count() == 0


def test_marts_through_three_batches_equal_a_rebuild(spark):
    source = open_source(spark, SF_SMALL)
    snaps = source.table("snapshot")
    source = OverrideSource(source, {"snapshot": snaps.withColumn("family_id", F.when(F.col("id") % 13 != 0, F.col("family_id")))})
    full = Warehouse(spark, source)
    before, batches = replay(full, 946684800, 883612800)
    kept = MaintainedMarts(spark, tempfile.mkdtemp(prefix="surveywave-maintained-"), buckets=8)
    kept.build(before)
    assert _rows(kept.flow_aggregate()) == _rows(marts.flow_aggregate(before.m("fact_indicators")))
    for seen, batch in batches:
        start = _rows(kept.flow_aggregate())
        kept.apply(seen, batch)
        assert _rows(kept.flow_aggregate()) != start  # the batch matters
        assert _rows(kept.fact("fact_snapshots")) == _rows(seen.m("fact_snapshots"))
        assert _rows(kept.fact("fact_indicators")) == _rows(seen.m("fact_indicators"))
        assert _rows(kept.flow_aggregate()) == _rows(marts.flow_aggregate(seen.m("fact_indicators")))
        assert _rows(kept.mart_indicators(seen)) == _rows(seen.m("mart_indicators"))
    # a batch brought in again changes nothing
    again = _rows(kept.flow_aggregate())
    kept.apply(*batches[-1])
    assert _rows(kept.flow_aggregate()) == again


def test_a_batch_of_one_family_writes_its_buckets_only(spark):
    full = Warehouse(spark, open_source(spark, SF_SMALL))
    kept = MaintainedMarts(spark, tempfile.mkdtemp(prefix="surveywave-maintained-"), buckets=16)
    kept.build(full)
    store = kept.facts["fact_indicators"]
    before = _files(store, store.version())
    one = full.raw("snapshot").where("family_id is not null").orderBy("id").limit(1)
    family = one.first()["family_id"]
    bucket = spark.createDataFrame([(family,)], "family_id long").select(bucket_of(["family_id"], 16)).first()[0]
    kept.apply(full, {"snapshot": one})
    after = _files(store, store.version())
    assert {b for f, (b, _) in after.items() if before.get(f) != after[f]} <= {bucket}
    assert all(after.get(f) == m for f, m in before.items() if m[0] != bucket)


def test_the_flow_state_catches_up_after_a_failure(spark):
    full = Warehouse(spark, open_source(spark, SF_SMALL))
    before, batches = replay(full, 946684800, 883612800)
    kept = MaintainedMarts(spark, tempfile.mkdtemp(prefix="surveywave-maintained-"), buckets=4)
    kept.build(before)
    step, kept.refresh_flow = kept.refresh_flow, lambda: None  # two batches whose second half is lost
    for seen, batch in batches[:2]:
        kept.apply(seen, batch)
    assert kept.flow.version().info["of"] == 1 and kept.facts["fact_indicators"].version().number == 3
    step()
    assert _rows(kept.flow_aggregate()) == _rows(marts.flow_aggregate(batches[1][0].m("fact_indicators")))
