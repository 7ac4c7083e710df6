"""Operators: skew-aware sequencing equals the single window; labels; ratios;
naming rule; metric validation; quality severity."""

import random
import re

import pytest
from pyspark.sql import functions as F

from surveywave.functions.columns import ratio, snapshot_type
from surveywave.operators.sequence import sequence, window_sequence
from surveywave.plans.warehouse import output_schema

ALL = dict(number="n", size="sz", lag={"pv": "v"}, first={"fv": "v"})


def _order():
    return [F.col("t").desc_nulls_first(), F.col("id").asc_nulls_last()]


def _same(a, b, cols=("id", "n", "sz", "pv", "fv", "mx")):
    """Rows that differ, both ways, and the two row counts."""
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() + b.exceptAll(a).count(), a.count(), b.count()


def test_sequence_equals_the_window_on_large_groups(spark):
    """Three groups and a NULL group of 150,000 rows and more, wide rows, many input partitions."""
    i = F.col("id")
    df = spark.range(0, 640_000, numPartitions=13).select(
        "id", F.when(i % 4 < 3, i % 4).alias("g"), F.lit(None).cast("string").alias("h"),
        F.when(F.xxhash64(i) % 50 != 0, F.xxhash64(i) % 5000).alias("t"),
        F.when(i % 7 != 0, (F.xxhash64(i) % 4).cast("int")).alias("v"), F.repeat(i.cast("string"), 30).alias("wide"))
    top = {"mx": F.when(F.col("t") < 5, F.col("id"))}
    got = sequence(df, ["g", "h"], _order(), group_max=top, chunks=16, **ALL)
    assert got.columns == [*df.columns, "n", "sz", "pv", "fv", "mx"]
    assert _same(got, window_sequence(df, ["g", "h"], _order(), group_max=top, **ALL)) == (0, 640_000, 640_000)
    chunks = got.groupBy("g").agg(F.max("n").alias("n"), F.max("sz").alias("sz")).collect()
    assert {(r.g, r.n, r.sz) for r in chunks} == {(g, 160_000, 160_000) for g in (None, 0, 1, 2)}


@pytest.mark.parametrize("chunks", [1, 5, 40])
def test_sequence_equals_the_window_on_small_and_mixed_groups(spark, chunks):
    rnd = random.Random(7)
    rows = [(1 if k % 3 else rnd.randint(2, 90), None if k % 17 == 0 else rnd.randint(0, 1),
             rnd.choice([None, *range(20)]), k, rnd.choice([None, 1, 2, 3])) for k in range(400)]
    df = spark.createDataFrame(rows, "g long, h long, t long, id long, v int").repartition(3)
    top = {"mx": F.when(F.col("t") < 5, F.col("v"))}
    got = sequence(df, ["g", "h"], _order(), group_max=top, chunks=chunks, **ALL)
    assert _same(got, window_sequence(df, ["g", "h"], _order(), group_max=top, **ALL)) == (0, 400, 400)


def test_chunks_of_a_sequence_move_whole(spark):
    """The window over a chunk adds no shuffle that deals its rows by group."""
    df = spark.range(1000).selectExpr("id", "id % 7 g", "id % 11 t", "cast(id % 3 as int) v")
    plan = sequence(df, ["g"], _order(), **ALL)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(_chunk#\d+L?, g#", plan)
    # what is left by (chunk, group) are the sums of the pieces
    assert "Exchange rangepartitioning(_chunk" in plan and len(dealt) == 1


def test_sequence_of_no_rows(spark):
    df = spark.createDataFrame([], "g long, t long, id long, v int")
    assert sequence(df, ["g"], _order(), **ALL).count() == 0


def test_snapshot_type_labels(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 5, 22)], "n long")
    got = [r[0] for r in df.select(snapshot_type("n")).collect()]
    assert got == ["Baseline", "1st Follow-up", "2nd Follow-up", "3rd Follow-up", "4th Follow-up",
                   "21th Follow-up"]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, 0.25]


def test_output_schema_rule():
    assert output_schema("marts") == "analytics_marts"
    assert output_schema("marts", target="prod") == "marts"
    assert output_schema("superset") == "superset"
    assert output_schema(None) == "analytics"


def test_metric_query_validation(wh_small):
    from surveywave.plans.semantic import MetricError, metric_query
    mi = wh_small.m("mart_indicators")
    with pytest.raises(MetricError):
        metric_query(mi, "Indicators", ["count"], ["family_count"])
    with pytest.raises(MetricError):
        metric_query(mi, "Indicators", ["no_such_metric"])
    with pytest.raises(MetricError):
        metric_query(wh_small.m("mart_surveys"), "Surveys", ["count"], ["days_since_previous"])
    out = metric_query(mi, "Indicators", ["count", "pct_green"], ["current_label_ordered"],
                       filters=[("is_last", "==", True)])
    assert {r.current_label_ordered for r in out.collect()} <= {
        "1 - Green", "2 - Yellow", "3 - Red", "4 - Skipped", "5 - Unknown"}


def test_relationship_null_child_is_not_a_failure(spark):
    from surveywave.plans.quality import Check, _relationship
    child = spark.createDataFrame([(None,), (1,), (2,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    c = Check("relationships", "child", "k", parent="parent", parent_column="k")
    assert _relationship(child, parent, c).first().failures == 1


def test_quality_report_statuses(wh_small):
    from surveywave.plans.quality import QualityError, run_checks, run_report
    report = {(r.test, r.model, r.column): r for r in run_checks(wh_small).collect()}
    assert len(report) == 152
    # priorities whose response never arrives only warn
    assert report[("relationships", "stg_snapshot_stoplight_priority", "snapshot_stoplight_id")].status == "warn"
    # survey dates of the driver data predate the calendar dimension: an error
    assert report[("relationships", "fact_snapshots", "date_key")].status == "fail"
    with pytest.raises(QualityError):
        run_report(wh_small)


def test_not_null_tests_of_a_model_are_one_scan(spark, tmp_path):
    from surveywave.plans.quality import CHECKS, _row_checks
    checks = [c for c in CHECKS if c.model == "fact_indicators" and c.test == "not_null"]
    path = f"file://{tmp_path}/t"
    spark.range(5).select(*[F.when(F.col("id") > k, 1).alias(c.column) for k, c in enumerate(checks)]).write.parquet(path)
    report = _row_checks(spark.read.parquet(path), checks)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["column"]: r.failures for r in report.collect()} == {c.column: min(5, k + 1) for k, c in enumerate(checks)}


def test_shares_that_miss_100_are_reported(spark):
    from surveywave.plans import quality

    # one row sums to 99, one to 100.4, one has no answers
    rows = [("a", "o", "PY", None, 40.0, 30.0, 20.0, 9.0), ("b", "o", "PY", None, 40.0, 30.0, 20.0, 10.4), ("c", "o", "PY", None, None, None, None, None)]
    table = spark.createDataFrame(rows, "k string, o string, c string, d date, green_pct double, yellow_pct double, red_pct double, skipped_pct double")
    failing = quality.sum_failures(table, "dimension_metrics", "k").collect()
    assert [(r.table_name, r.identifier, r.total_pct) for r in failing] == [("dimension_metrics", "a", 99.0)]


def test_numbers_too_large_for_the_fact_are_counted(spark):
    from surveywave.plans.economic import dq_number_overflow

    class Answers:
        def m(self, name):
            return spark.createDataFrame([("income", "12345678901234.5"), ("income", "9999999999999.99"), ("income", "x"), ("rent", "1")],
                                         "code_name string, answer_value string")
    assert {(r.code_name, r.numeric_answers, r.too_large) for r in dq_number_overflow(Answers()).collect()} == {("income", 2, 1), ("rent", 1, 0)}
