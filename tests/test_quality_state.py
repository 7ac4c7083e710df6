"""The report kept by counts equals the full one after every batch."""

import tempfile

import pytest
from pyspark.sql import functions as F

from surveywave.plans.quality import Check, run_checks, sum_failures
from surveywave.plans.quality_state import QualityState, changes

CHECKS = [Check("unique", "child", "id"), Check("not_null", "child", "name"), Check("not_null", "child", "id", "warn"),
          Check("relationships", "child", "up", "error", "parent", "id"), Check("accepted_values", "child", "name", values=("a", "b")),
          Check("expression_true", "child", "n", expression="> 0"), Check("unique", "parent", "id"),
          Check("relationships", "parent", "id", "warn", "child", "up")]
CHILD, PARENT = "id long, name string, up long, n int", "id long"


class Models:
    def __init__(self, **models):
        self.models = models

    def m(self, name):
        return self.models[name]


def _same(monkeypatch, state, models):
    monkeypatch.setattr("surveywave.plans.quality.CHECKS", CHECKS)
    got = sorted(map(str, state.report().collect()))
    assert got == sorted(map(str, run_checks(models).collect()))
    return got


def test_three_batches(spark, monkeypatch):
    state = QualityState(spark, tempfile.mkdtemp(prefix="surveywave-quality-"), CHECKS, buckets=4)
    rows = [(1, "a", 10, 1), (2, "c", 11, 0), (2, None, None, -1), (None, "d", 12, None), (3, "c", 12, 5)]
    child, parent = spark.createDataFrame(rows, CHILD), spark.createDataFrame([(10,), (10,), (13,)], PARENT)
    state.apply({"child": changes(child), "parent": changes(parent)})
    first = _same(monkeypatch, state, Models(child=child, parent=parent))
    # a parent comes late, a repeated key and a NULL come in
    more = spark.createDataFrame([(3, "b", 13, 1), (None, None, 12, 2)], CHILD)
    late = spark.createDataFrame([(11,), (12,), (None,)], PARENT)
    state.apply({"child": changes(more), "parent": changes(late)})
    second = _same(monkeypatch, state, Models(child=child.unionByName(more), parent=parent.unionByName(late)))
    # rows go: a parent that had children, a key that was there twice, a bad value
    gone, lost = spark.createDataFrame([rows[1], rows[4]], CHILD), spark.createDataFrame([(12,), (10,)], PARENT)
    state.apply({"child": changes(deleted=gone), "parent": changes(deleted=lost)})
    left = child.unionByName(more).exceptAll(gone)
    third = _same(monkeypatch, state, Models(child=left, parent=parent.unionByName(late).exceptAll(lost)))
    assert first != second != third
    # all of it goes again: nothing fails and nothing is stored
    state.apply({"child": changes(deleted=left), "parent": changes(deleted=parent.unionByName(late).exceptAll(lost))})
    assert state.report().where("failures <> 0").isEmpty() and state.counts.read().count() == 0


def test_only_touched_buckets_are_written_and_a_failed_refresh_is_made_up_for(spark, monkeypatch):
    state = QualityState(spark, tempfile.mkdtemp(prefix="surveywave-quality-"), CHECKS, buckets=16)
    child = spark.range(500).selectExpr("id", "'a' name", "id up", "1 n")
    parent = spark.range(499).toDF("id")
    state.apply({"child": changes(child), "parent": changes(parent)})
    before = state.counts.version().folders
    refresh, state.refresh = state.refresh, lambda: None  # lost
    more = spark.createDataFrame([(7, "z", 499, 0)], CHILD)
    state.apply({"child": changes(more)})
    after = state.counts.version().folders
    assert sum(before.get(b) != after.get(b) for b in after) <= 6  # one key a check that it counts in
    assert state.failures.version().info["of"] == 1
    state.refresh = refresh
    _same(monkeypatch, state, Models(child=child.unionByName(more), parent=parent))


def test_the_first_batch_may_be_empty(spark, monkeypatch):
    state = QualityState(spark, tempfile.mkdtemp(prefix="surveywave-quality-"), CHECKS, buckets=4)
    none, no_parent = spark.createDataFrame([], CHILD), spark.createDataFrame([], PARENT)
    state.apply({"child": changes(none), "parent": changes(no_parent)})
    _same(monkeypatch, state, Models(child=none, parent=no_parent))


@pytest.mark.parametrize("pcts,bad", [((50.0, 30.0, 20.0, 0.0), 0), ((50.0, 30.0, 20.0, 0.6), 1), ((50.0, 30.0, 19.4, 0.0), 1),
                                      ((33.3, 33.3, 33.3, 0.0), 0), ((None, None, None, None), 0)])
def test_shares_that_miss_100_are_reported(spark, pcts, bad):
    df = spark.createDataFrame([("x", *pcts)], "dimension_name string, green_pct double, yellow_pct double, red_pct double, skipped_pct double")
    got = sum_failures(df, "dimension_metrics", "dimension_name").collect()
    assert len(got) == bad and all(r.identifier == "x" and r.table_name == "dimension_metrics" for r in got)


def test_metric_rows_get_their_names_after_the_large_joins(wh_small):
    from surveywave.plans.quality import dimension_metrics
    plan = dimension_metrics(wh_small)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    deep = {c: min(len(x) - len(x.lstrip(" :+-")) for x in plan if "Join" in x and c in x) for c in ("snapshot_id", "family_id", "organization_id")}
    assert deep["organization_id"] < deep["snapshot_id"] and deep["organization_id"] < deep["family_id"]
