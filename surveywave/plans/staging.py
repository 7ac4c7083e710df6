"""Staging ("silver") models: rename, normalise keys, clean values, dedup.

Each ``stg_*`` takes the raw DataFrame and returns a lazy DataFrame; nothing
is materialised here (the source system keeps staging as views).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveywave.functions.columns import (
    CORE_DIMENSIONS, FEMALE_CODES, MALE_CODES, VALID_RAW_SCORES, epoch_ts, geo_coord, norm_key)
from surveywave.operators.relational import keep_first


def _rename(df: DataFrame, mapping: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping])


def stg_applications(src: DataFrame) -> DataFrame:
    return _rename(src, [("id", "application_id"), ("name", "application_name"),
                         ("description", "application_description"),
                         ("is_active", "application_is_active"), ("country_code", "country_code"),
                         ("created_date", "application_created_at"),
                         ("last_modified_date", "application_updated_at")])


def stg_organizations(src: DataFrame) -> DataFrame:
    return _rename(src, [("id", "organization_id"), ("application_id", "application_id"),
                         ("name", "organization_name"), ("description", "organization_description"),
                         ("is_active", "organization_is_active"), ("country_code", "country_code"),
                         ("language", "language"), ("created_date", "organization_created_at"),
                         ("last_modified_date", "organization_updated_at")])


def stg_projects(src: DataFrame) -> DataFrame:
    return _rename(src, [("id", "project_id"), ("organization_id", "organization_id"),
                         ("title", "project_name"), ("description", "project_description"),
                         ("active", "project_is_active"), ("from_date", "from_date"),
                         ("to_date", "to_date"), ("created_at", "project_created_at")])


def stg_countries(src: DataFrame) -> DataFrame:
    return src.select(F.col("id").alias("country_id"),
                      F.trim("alfa_2_code").alias("country_code"),
                      F.col("country").alias("country_name"))


def stg_families(src: DataFrame) -> DataFrame:
    return src.select(
        "family_id", F.col("country").alias("country_id"), "application_id", "organization_id",
        "project_id", F.col("is_active").alias("family_is_active"),
        F.col("anonymous").alias("is_anonymous"),
        geo_coord("latitude", 90).alias("latitude"),
        geo_coord("longitude", 180).alias("longitude"),
        F.col("created_date").alias("family_created_at"),
        F.col("last_modified_date").alias("family_updated_at"))


def stg_family_members(src: DataFrame) -> DataFrame:
    g = F.col("gender")
    return src.filter(F.col("family_id").isNotNull()).select(
        F.col("id").alias("family_member_id"), "family_id", "first_participant",
        F.col("active").alias("family_member_is_active"), F.col("anonymous").alias("is_anonymous"),
        F.when(g.isin(MALE_CODES), "Male").when(g.isin(FEMALE_CODES), "Female")
         .otherwise("Other").alias("gender"),
        F.coalesce(F.nullif(F.col("birth_country"), F.lit("")), F.lit("Unknown")).alias("birth_country"),
        F.col("created_date").alias("family_member_created_at"),
        F.col("last_modified_date").alias("family_member_updated_at"))


def stg_snapshots(src: DataFrame, epoch_unit: str = "s") -> DataFrame:
    """Epoch columns are seconds in the source (``epoch_unit`` overrides)."""
    return src.select(
        F.col("id").alias("snapshot_id"), "family_id", "organization_id", "application_id",
        "survey_definition_id", "project_id", "snapshot_number", "is_last",
        F.col("anonymous").alias("is_anonymous"), "stoplight_skipped",
        epoch_ts("snapshot_date", epoch_unit).alias("snapshot_date"),
        epoch_ts("created_at", epoch_unit).alias("snapshot_created_at"),
        F.col("last_modified_date").alias("snapshot_updated_at"))


def stg_snapshot_stoplight(src: DataFrame) -> DataFrame:
    """Keep scores 0,1,2,3,9 (NULL and anything else dropped); ms epoch."""
    return src.filter(F.col("value").isin(VALID_RAW_SCORES)).select(
        F.col("id").alias("snapshot_stoplight_id"), "snapshot_id",
        norm_key("code_name").alias("indicator_code_name"),
        F.col("value").alias("indicator_status_value"),
        F.col("additional").alias("is_additional"),
        F.col("created_date").alias("snapshot_stoplight_created_at"),
        epoch_ts("updated_at", "ms").alias("snapshot_stoplight_updated_at"))


def _dedup_by_response(src: DataFrame) -> DataFrame:
    return keep_first(src, ["snapshot_stoplight_id"], [F.col("id").asc_nulls_last()])


def stg_snapshot_stoplight_priority(src: DataFrame) -> DataFrame:
    return _dedup_by_response(src).select(
        F.col("id").alias("snapshot_stoplight_priority_id"), "snapshot_stoplight_id",
        "reason", "action", "estimated_date",
        F.col("created_date").alias("priority_created_at"),
        F.col("last_modified_date").alias("priority_updated_at"))


def stg_snapshot_stoplight_achievement(src: DataFrame) -> DataFrame:
    return _dedup_by_response(src).select(
        F.col("id").alias("snapshot_stoplight_achievement_id"), "snapshot_stoplight_id",
        "action", "roadmap",
        F.col("created_date").alias("achievement_created_at"),
        F.col("last_modified_date").alias("achievement_updated_at"))


def stg_survey_definitions(src: DataFrame) -> DataFrame:
    return _rename(src, [("id", "survey_definition_id"), ("survey_code", "survey_code"),
                         ("title", "survey_title"), ("description", "survey_description"),
                         ("lang", "survey_language"), ("active", "survey_is_active"),
                         ("country_code", "country_code"), ("created_at", "survey_created_at"),
                         ("updated_at", "survey_updated_at")])


def stg_survey_stoplight(src: DataFrame) -> DataFrame:
    """One indicator per (survey, normalised code): the most recently updated,
    NULL ``updated_at`` first (source-system DESC order), then lowest id."""
    keyed = src.withColumn("indicator_code_name", norm_key("code_name"))
    kept = keep_first(keyed, ["survey_definition_id", "indicator_code_name"],
                      [F.col("updated_at").desc_nulls_first(), F.col("id").asc_nulls_last()])
    return kept.select(
        F.col("id").alias("survey_indicator_id"), "survey_definition_id",
        F.col("survey_indicator_id").alias("indicator_template_id"), "survey_dimension_id",
        "indicator_code_name", F.col("short_name").alias("indicator_short_name"),
        F.col("question_text").alias("indicator_question_text"),
        F.col("description").alias("indicator_description"),
        F.col("definition").alias("indicator_definition"),
        F.col("required").alias("indicator_is_required"), "order_number",
        F.col("created_at").alias("survey_indicator_created_at"),
        F.col("updated_at").alias("survey_indicator_updated_at"))


def stg_survey_stoplight_indicator(src: DataFrame) -> DataFrame:
    return src.select(
        F.col("id").alias("indicator_template_id"), F.col("survey_dimension_id").alias("dimension_id"),
        norm_key("met_short_name").alias("indicator_template_short_name"),
        norm_key("met_description").alias("indicator_template_description"))


def stg_survey_stoplight_dimension(src: DataFrame) -> DataFrame:
    name = norm_key("met_name")
    return src.select(
        F.col("id").alias("dimension_id"), name.alias("dimension_met_name"),
        F.col("status").alias("dimension_is_active"),
        name.isin(CORE_DIMENSIONS).alias("is_core_dimension"),   # NULL name → NULL flag
        F.col("created_date").alias("dimension_created_at"),
        F.col("last_modified_date").alias("dimension_updated_at"))


def stg_survey_stoplight_color(src: DataFrame) -> DataFrame:
    return _rename(src, [("id", "survey_stoplight_color_id"),
                         ("survey_stoplight_id", "survey_indicator_id"), ("value", "color_value"),
                         ("description", "color_description"), ("created_at", "color_created_at"),
                         ("updated_at", "color_updated_at")])


def stg_translations(src: DataFrame) -> DataFrame:
    return src.filter(F.col("lang") == "EN").select(
        F.col("id").alias("translation_id"), norm_key("key").alias("translation_key"),
        F.col("lang").alias("language_code"), F.col("translation").alias("translation_text"))


def stg_survey_economic(src: DataFrame) -> DataFrame:
    t = F.col("answer_type")
    return src.select(
        F.col("id").alias("survey_economic_id"), "survey_definition_id",
        norm_key("code_name").alias("code_name"), "question_text",
        F.when(t == "string", "text").otherwise(t).alias("answer_type"),
        "answer_options", "scope", F.col("for_family_member").alias("is_for_family_member"), "topic",
        F.col("created_at").alias("survey_economic_created_at"),
        F.col("updated_at").alias("survey_economic_updated_at"))


def stg_snapshot_economic(src: DataFrame) -> DataFrame:
    t = F.col("answer_type")
    return src.select(
        F.col("id").alias("snapshot_economic_id"), "snapshot_id",
        norm_key("code_name").alias("code_name"),
        F.coalesce(F.when(t == "string", "text").otherwise(t), F.lit("text")).alias("answer_type"),
        F.col("value").alias("answer_value"), F.col("multiple_value").alias("answer_multiple_value"),
        F.col("other_text").alias("answer_other_text"),
        F.col("created_date").alias("snapshot_economic_created_at"),
        F.col("last_modified_date").alias("snapshot_economic_updated_at"))


STAGING = {
    "stg_applications": ("applications", stg_applications),
    "stg_organizations": ("organizations", stg_organizations),
    "stg_projects": ("projects", stg_projects),
    "stg_countries": ("countries", stg_countries),
    "stg_families": ("family", stg_families),
    "stg_family_members": ("family_members", stg_family_members),
    "stg_snapshots": ("snapshot", stg_snapshots),
    "stg_snapshot_stoplight": ("snapshot_stoplight", stg_snapshot_stoplight),
    "stg_snapshot_stoplight_priority": ("snapshot_stoplight_priority", stg_snapshot_stoplight_priority),
    "stg_snapshot_stoplight_achievement": ("snapshot_stoplight_achievement",
                                           stg_snapshot_stoplight_achievement),
    "stg_survey_definitions": ("survey_definition", stg_survey_definitions),
    "stg_survey_stoplight": ("survey_stoplight", stg_survey_stoplight),
    "stg_survey_stoplight_indicator": ("survey_stoplight_indicator", stg_survey_stoplight_indicator),
    "stg_survey_stoplight_dimension": ("survey_stoplight_dimension", stg_survey_stoplight_dimension),
    "stg_survey_stoplight_color": ("survey_stoplight_color", stg_survey_stoplight_color),
    "stg_translations": ("translation", stg_translations),
    "stg_survey_economic": ("survey_economic", stg_survey_economic),
    "stg_snapshot_economic": ("snapshot_economic", stg_snapshot_economic),
}
