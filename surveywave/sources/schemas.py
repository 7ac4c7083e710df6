"""Declared schemas of the 18 raw operational tables.

Schemas are fixed, never inferred.  ``ts`` columns are audit timestamps without
zone; epoch columns stay ``long`` and are converted in staging.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B, D = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DateType()
SH = T.ShortType()
TS = T.TimestampNTZType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "applications": _struct(
        ("id", L), ("name", S), ("description", S), ("is_active", B), ("country_code", S),
        ("created_date", TS), ("last_modified_date", TS)),
    "organizations": _struct(
        ("id", L), ("application_id", L), ("name", S), ("description", S), ("is_active", B),
        ("country_code", S), ("language", S), ("created_date", TS), ("last_modified_date", TS)),
    "projects": _struct(
        ("id", L), ("organization_id", L), ("title", S), ("description", S), ("active", B),
        ("from_date", D), ("to_date", D), ("created_at", TS)),
    "countries": _struct(("id", L), ("country", S), ("alfa_2_code", S)),
    "family": _struct(
        ("family_id", L), ("country", L), ("application_id", L), ("organization_id", L),
        ("project_id", L), ("is_active", B), ("anonymous", B), ("latitude", S), ("longitude", S),
        ("created_date", TS), ("last_modified_date", TS)),
    "family_members": _struct(
        ("id", L), ("family_id", L), ("first_participant", B), ("active", B), ("anonymous", B),
        ("gender", S), ("birth_country", S), ("created_date", TS), ("last_modified_date", TS)),
    "survey_definition": _struct(
        ("id", L), ("survey_code", S), ("title", S), ("description", S), ("lang", S),
        ("active", B), ("country_code", S), ("created_at", TS), ("updated_at", TS)),
    "survey_stoplight_dimension": _struct(
        ("id", L), ("met_name", S), ("status", S), ("created_date", TS), ("last_modified_date", TS)),
    "survey_stoplight_indicator": _struct(
        ("id", L), ("survey_dimension_id", L), ("met_short_name", S), ("met_description", S)),
    "survey_stoplight": _struct(
        ("id", L), ("survey_definition_id", L), ("survey_indicator_id", L),
        ("survey_dimension_id", L), ("code_name", S), ("short_name", S), ("question_text", S),
        ("description", S), ("definition", S), ("required", B), ("order_number", I),
        ("created_at", D), ("updated_at", D)),
    "survey_stoplight_color": _struct(
        ("id", L), ("survey_stoplight_id", L), ("value", I), ("description", S),
        ("created_at", D), ("updated_at", D)),
    "translation": _struct(("id", L), ("key", S), ("lang", S), ("translation", S)),
    "survey_economic": _struct(
        ("id", L), ("survey_definition_id", L), ("code_name", S), ("question_text", S),
        ("answer_type", S), ("answer_options", S), ("scope", S), ("for_family_member", B),
        ("topic", S), ("created_at", D), ("updated_at", D)),
    "snapshot": _struct(
        ("id", L), ("family_id", L), ("organization_id", L), ("application_id", L),
        ("survey_definition_id", L), ("project_id", L), ("snapshot_number", SH), ("is_last", B),
        ("anonymous", B), ("stoplight_skipped", B), ("snapshot_date", L), ("created_at", L),
        ("last_modified_date", TS)),
    "snapshot_stoplight": _struct(
        ("id", L), ("snapshot_id", L), ("code_name", S), ("value", I), ("additional", B),
        ("created_date", TS), ("updated_at", L)),
    "snapshot_stoplight_priority": _struct(
        ("id", L), ("snapshot_stoplight_id", L), ("reason", S), ("action", S),
        ("estimated_date", L), ("created_date", TS), ("last_modified_date", TS)),
    "snapshot_stoplight_achievement": _struct(
        ("id", L), ("snapshot_stoplight_id", L), ("action", S), ("roadmap", S),
        ("created_date", TS), ("last_modified_date", TS)),
    "snapshot_economic": _struct(
        ("id", L), ("snapshot_id", L), ("code_name", S), ("answer_type", S), ("value", S),
        ("multiple_value", S), ("other_text", S), ("created_date", TS), ("last_modified_date", TS)),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

# Audit columns that the driver tables cannot provide get one fixed value.
AUDIT_COLUMNS = {"created_date", "last_modified_date"}
