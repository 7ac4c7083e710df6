"""Window rules of the facts (FIXTURES.md §3) and pipeline invariants."""

import datetime as dt

from pyspark.sql import functions as F

from surveywave.plans import facts, staging
from surveywave.sources.schemas import RAW_SCHEMAS

DAY = 86400


def raw_snapshots(spark, data):
    schema = RAW_SCHEMAS["snapshot"]
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in data], schema)


def test_sequence_per_family_and_survey(spark):
    s = raw_snapshots(spark, [
        {"id": 1, "family_id": 1, "survey_definition_id": 1, "snapshot_date": 10 * DAY, "created_at": 0},
        {"id": 2, "family_id": 1, "survey_definition_id": 1, "snapshot_date": 40 * DAY, "created_at": 0},
        {"id": 3, "family_id": 1, "survey_definition_id": 2, "snapshot_date": 20 * DAY, "created_at": 0},
    ])
    out = {r.snapshot_id: r for r in facts.fact_snapshots(staging.stg_snapshots(s)).collect()}
    assert [out[i].snapshot_number for i in (1, 2, 3)] == [1, 2, 1]
    assert [out[i].is_last for i in (1, 2, 3)] == [False, True, False]
    assert [out[i].max_snapshot_number for i in (1, 2, 3)] == [2, 2, 1]
    assert [out[i].days_since_baseline for i in (1, 2, 3)] == [0, 30, 0]
    assert [out[i].days_since_previous for i in (1, 2, 3)] == [None, 30, None]
    assert out[1].date_key == 19700111


def test_null_date_sorts_last_and_is_last(spark):
    s = raw_snapshots(spark, [
        {"id": 1, "family_id": 1, "survey_definition_id": 1, "snapshot_date": None, "created_at": 5},
        {"id": 2, "family_id": 1, "survey_definition_id": 1, "snapshot_date": 10 * DAY, "created_at": 5},
    ])
    out = {r.snapshot_id: r for r in facts.fact_snapshots(staging.stg_snapshots(s)).collect()}
    assert out[1].snapshot_number == 2 and out[1].is_last
    assert out[2].snapshot_number == 1 and not out[2].is_last


def test_ties_broken_by_created_then_id(spark):
    s = raw_snapshots(spark, [
        {"id": 3, "family_id": 1, "survey_definition_id": 1, "snapshot_date": DAY, "created_at": 2},
        {"id": 2, "family_id": 1, "survey_definition_id": 1, "snapshot_date": DAY, "created_at": 1},
        {"id": 1, "family_id": 1, "survey_definition_id": 1, "snapshot_date": DAY, "created_at": 2},
    ])
    out = {r.snapshot_id: r.snapshot_number for r in facts.fact_snapshots(staging.stg_snapshots(s)).collect()}
    assert out == {2: 1, 1: 2, 3: 3}


def _indicator_fact(spark, scores):
    """One family, one indicator; ``scores`` per snapshot (None = not asked)."""
    snaps = raw_snapshots(spark, [
        {"id": i + 1, "family_id": 1, "organization_id": 1, "survey_definition_id": 1,
         "snapshot_date": (i + 1) * DAY, "created_at": 0} for i in range(len(scores))])
    fs = facts.fact_snapshots(staging.stg_snapshots(snaps))
    resp = spark.createDataFrame(
        [(100 + i, i + 1, "b", v) for i, v in enumerate(scores) if v is not None],
        "snapshot_stoplight_id long, snapshot_id long, indicator_code_name string, indicator_status_value int")
    si = spark.createDataFrame([(7, 1, "b")], "survey_indicator_id long, survey_definition_id long, "
                                               "indicator_code_name string")
    fam = spark.createDataFrame([(1,)], "family_id long")
    org = spark.createDataFrame([(1,)], "organization_id long")
    sd = spark.createDataFrame([(1,)], "survey_definition_id long")
    pr = spark.createDataFrame([(100,)], "snapshot_stoplight_id long")
    ac = spark.createDataFrame([], "snapshot_stoplight_id long")
    fi = facts.fact_indicators(fs, resp, si, fam, org, sd, pr, ac)
    return {r.snapshot_number: r for r in fi.collect()}


def test_previous_is_previous_observation(spark):
    out = _indicator_fact(spark, [1, None, 3])
    assert out[3].previous_score == 1 and out[3].baseline_score == 1
    assert out[3].was_priority_in_previous is True
    assert out[1].previous_score is None and out[1].was_priority_in_previous is None


def test_not_applicable_baseline(spark):
    out = _indicator_fact(spark, [9, 2])
    assert out[1].current_score is None
    assert out[2].baseline_score is None and out[2].previous_score is None


def test_indicator_first_asked_later(spark):
    out = _indicator_fact(spark, [None, 2])
    assert out[2].baseline_score is None and out[2].was_priority_in_previous is None


def test_invariants(wh_small):
    fi, fs = wh_small.m("fact_indicators"), wh_small.m("fact_snapshots")
    from surveywave.plans.marts import flow_aggregate
    assert flow_aggregate(fi).agg(F.sum("family_count")).first()[0] == fi.count()
    last = fs.groupBy("family_id").agg(F.sum(F.col("is_last").cast("int")).alias("n"))
    assert last.filter(F.col("n") != 1).count() == 0
    base = fs.groupBy("family_id", "survey_definition_id").agg(F.sum(F.col("is_baseline").cast("int")).alias("n"))
    assert base.filter(F.col("n") != 1).count() == 0


def test_dim_date(spark):
    from surveywave.plans.dims import dim_date
    d = dim_date(spark)
    assert d.count() == 9131
    by = {r.date_actual: r for r in d.filter(F.col("date_actual").isin(
        dt.date(2011, 1, 1), dt.date(2020, 2, 29), dt.date(2021, 1, 3), dt.date(2035, 12, 31))).collect()}
    assert by[dt.date(2011, 1, 1)].day_of_week == "Saturday" and by[dt.date(2011, 1, 1)].is_weekend
    assert by[dt.date(2020, 2, 29)].day_of_year == 60
    assert by[dt.date(2021, 1, 3)].week_of_year == 53 and by[dt.date(2021, 1, 3)].day_of_week_number == 7
    assert by[dt.date(2035, 12, 31)].year_quarter == "2035-Q4"
    padded = dim_date(spark, pg_padding=True).filter(F.col("date_key") == 20110101).first()
    assert padded.day_of_week == "Saturday " and len(padded.month_name) == 9


def test_responses_and_snapshots_are_derived_once(wh_small):
    for model in ("stg_snapshot_stoplight", "stg_snapshot_stoplight_priority", "stg_snapshot_stoplight_achievement", "stg_snapshots"):
        plan = wh_small.m(model)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan


def test_flags_meet_the_responses_before_they_are_resolved(spark, wh_small):
    """By response id only narrow rows are shuffled."""
    wide = []
    facts.fact_indicators(wh_small.m("fact_snapshots"), *[wh_small.m(m) for m in (
        "stg_snapshot_stoplight", "stg_survey_stoplight", "dim_family", "dim_organization", "dim_survey_definition",
        "stg_snapshot_stoplight_priority", "stg_snapshot_stoplight_achievement")], store=lambda df: wide.append(df) or df)
    plan = wide[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    deep = lambda what: min(len(x) - len(x.lstrip(" :+-")) for x in plan if "Join" in x and what in x)
    assert deep("_pr_id") > deep("indicator_code_name")


def test_dimensions_are_stored_so_that_their_size_is_known(wh_small):
    """A plan of joins is estimated at the product of its sides, and facts were shuffled to meet a few rows."""
    for model in ("dim_organization", "dim_survey_definition", "dim_indicator_questions"):
        plan = wh_small.m(model)._jdf.queryExecution().optimizedPlan()
        assert "Join" not in plan.toString() and plan.stats().sizeInBytes() < 1 << 20


def _mixed_snapshots(spark):
    """Families of many snapshots and few, without dates, without an id, rows that repeat."""
    rows = [{"id": k, "family_id": None if k % 13 == 0 else k * k % 7, "organization_id": 1, "survey_definition_id": k % 3 or None,
             "snapshot_date": None if k % 11 == 0 else k * 37 % 50 * DAY, "created_at": k % 2} for k in range(90)]
    return staging.stg_snapshots(raw_snapshots(spark, rows + rows[20:25]))


def test_facts_of_few_snapshots_meet_by_family(spark):
    """No ranged rows are stored and moved again, and the rows are the same."""
    stg, held = _mixed_snapshots(spark), []
    keep = lambda df: held.append(df) or df
    small = facts.fact_snapshots(stg, keep, small=True)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert not held and "rangepartitioning" not in plan and "_chunk" not in plan
    large = facts.fact_snapshots(stg)
    cols = [c for c in large.columns if c != "snapshot_updated_at"]
    assert sorted(map(repr, small.select(*cols).collect())) == sorted(map(repr, large.select(*cols).collect()))

    # two codes of a survey, an indicator of two surveys, scores that do not count
    resp = spark.createDataFrame([(1000 + 2 * i + c, i, "ab"[c], [0, 1, 2, 3, 9][(i + c) % 5]) for i in range(90) for c in (0, 1)],
                                 "snapshot_stoplight_id long, snapshot_id long, indicator_code_name string, indicator_status_value int")
    si = spark.createDataFrame([(7, 1, "a"), (8, 1, "b"), (7, 2, "a")], "survey_indicator_id long, survey_definition_id long, indicator_code_name string")
    ids = lambda name, n: spark.range(n).withColumnRenamed("id", name)
    pr, ac = ids("snapshot_stoplight_id", 1050), ids("snapshot_stoplight_id", 1011)
    once = facts.fact_snapshots(stg.distinct(), small=True)
    build = lambda **how: facts.fact_indicators(once, resp, si, ids("family_id", 9), ids("organization_id", 9), ids("survey_definition_id", 9), pr, ac, **how)
    small, large = build(store=keep, small=True), build()
    assert not held and "rangepartitioning" not in small._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(repr, small.collect()))
    assert len(got) > 50 and got == sorted(map(repr, large.collect()))


def test_a_family_of_many_snapshots_is_cut_into_chunks(spark, monkeypatch):
    from surveywave.plans.warehouse import Warehouse

    wh, stored = Warehouse(spark, None), []
    wh.use("stg_snapshots", _mixed_snapshots(spark))
    assert wh._few_snapshots()
    few = sorted(map(repr, wh.m("fact_snapshots").drop("snapshot_updated_at").collect()))
    monkeypatch.setattr(facts, "FEW", 5)
    plain = facts.sequence
    monkeypatch.setattr(facts, "sequence", lambda *a, small=(), **k: stored.append(small) or plain(*a, small=small, **k))
    wh = Warehouse(spark, None)
    wh.use("stg_snapshots", _mixed_snapshots(spark))
    assert sorted(map(repr, wh.m("fact_snapshots").drop("snapshot_updated_at").collect())) == few
    assert stored == [[]] and not wh._few_snapshots()


def test_a_task_reads_little_of_a_file():
    """Grouping by keys that hardly repeat spilled 128 MB of files a task."""
    from surveywave.session import SQL_DEFAULTS

    assert int(SQL_DEFAULTS["spark.sql.files.maxPartitionBytes"]) <= 32 << 20
