"""Edge rows of the staging rules (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from surveywave.plans import staging
from surveywave.sources.schemas import RAW_SCHEMAS


def raw(spark, table, data):
    """Raw table with the declared schema; ``data`` gives some columns."""
    schema = RAW_SCHEMAS[table]
    names = [f.name for f in schema.fields]
    full = [tuple(d.get(n) for n in names) for d in data]
    return spark.createDataFrame(full, schema)


def test_family_coordinates(spark):
    lats = ["-90", "90.001", "12.", ".5", "+5", "1e3", "12.5\n", " 12", "-12.345", None]
    df = raw(spark, "family", [{"family_id": i, "latitude": v, "longitude": "0"} for i, v in enumerate(lats)])
    out = dict(staging.stg_families(df).select("family_id", "latitude").collect())
    got = [out[i] for i in range(len(lats))]
    assert got == [Decimal("-90.00"), None, Decimal("12.00"), None, None, None, None, None,
                   Decimal("-12.35"), None]


def test_family_members_gender_and_country(spark):
    df = raw(spark, "family_members", [
        {"id": 1, "family_id": 1, "gender": "Male", "birth_country": ""},
        {"id": 2, "family_id": 1, "gender": "male", "birth_country": " "},
        {"id": 3, "family_id": 1, "gender": None, "birth_country": None},
        {"id": 4, "family_id": None, "gender": "M", "birth_country": "X"},
    ])
    out = {r.family_member_id: (r.gender, r.birth_country)
           for r in staging.stg_family_members(df).collect()}
    assert out == {1: ("Male", "Unknown"), 2: ("Other", " "), 3: ("Other", "Unknown")}


def test_snapshot_stoplight_values_and_ms_epoch(spark):
    vals = [0, 1, 2, 3, 9, 4, None]
    df = raw(spark, "snapshot_stoplight", [
        {"id": i, "snapshot_id": 1, "code_name": " Brand#1 ", "value": v,
         "updated_at": 1999 if i == 0 else None} for i, v in enumerate(vals)])
    out = staging.stg_snapshot_stoplight(df)
    assert sorted(r.indicator_status_value for r in out.collect()) == [0, 1, 2, 3, 9]
    first = out.filter(F.col("snapshot_stoplight_id") == 0).first()
    assert first.indicator_code_name == "brand#1"
    assert first.snapshot_stoplight_updated_at == dt.datetime(1970, 1, 1, 0, 0, 1)


def test_survey_stoplight_null_updated_wins(spark):
    df = raw(spark, "survey_stoplight", [
        {"id": 1, "survey_definition_id": 7, "code_name": " A ", "updated_at": dt.date(2020, 1, 1)},
        {"id": 2, "survey_definition_id": 7, "code_name": "a", "updated_at": dt.date(2021, 1, 1)},
        {"id": 3, "survey_definition_id": 7, "code_name": "a", "updated_at": None},
    ])
    out = staging.stg_survey_stoplight(df).collect()
    assert [r.survey_indicator_id for r in out] == [3]


def test_dimension_null_name(spark):
    df = raw(spark, "survey_stoplight_dimension", [
        {"id": 1, "met_name": None}, {"id": 2, "met_name": " HealthAndEnvironment.name "},
        {"id": 3, "met_name": "other.name"}])
    out = dict(staging.stg_survey_stoplight_dimension(df).select("dimension_id", "is_core_dimension").collect())
    assert out == {1: None, 2: True, 3: False}


def test_economic_answer_types(spark):
    types = [None, "string", "", "number"]
    ans = raw(spark, "snapshot_economic", [{"id": i, "answer_type": t} for i, t in enumerate(types)])
    q = raw(spark, "survey_economic", [{"id": i, "answer_type": t} for i, t in enumerate(types)])
    a_out = dict(staging.stg_snapshot_economic(ans).select("snapshot_economic_id", "answer_type").collect())
    q_out = dict(staging.stg_survey_economic(q).select("survey_economic_id", "answer_type").collect())
    assert [a_out[i] for i in range(4)] == ["text", "text", "", "number"]
    assert [q_out[i] for i in range(4)] == [None, "text", "", "number"]


def test_priority_dedup_keeps_lowest_id(spark):
    df = raw(spark, "snapshot_stoplight_priority", [
        {"id": 5, "snapshot_stoplight_id": 1}, {"id": 3, "snapshot_stoplight_id": 1},
        {"id": 9, "snapshot_stoplight_id": 2}])
    out = sorted(tuple(r) for r in staging.stg_snapshot_stoplight_priority(df)
                 .select("snapshot_stoplight_id", "snapshot_stoplight_priority_id").collect())
    assert out == [(1, 3), (2, 9)]
