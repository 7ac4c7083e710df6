"""Dimension models (star-schema side).

All dimension inputs are small code tables (hubs, organisations, countries,
survey definitions, indicators, translations).  Spark broadcasts a side whose
bytes, estimated or measured, are under its threshold and shuffles any other;
nothing is broadcast by hand.
"""

from __future__ import annotations

import datetime as _dt
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveywave.operators.relational import pivot_max

# The calendar span of the date dimension (inclusive).
DATE_SPINE_START = _dt.date(2011, 1, 1)
DATE_SPINE_END = _dt.date(2035, 12, 31)


def dim_date(spark: SparkSession, start: _dt.date = DATE_SPINE_START,
             end: _dt.date = DATE_SPINE_END, pg_padding: bool = False) -> DataFrame:
    """One row per day.  Generated with a distributed ``range`` (SRC-19).

    ``pg_padding=True`` blank-pads day and month names to 9 characters like
    the source system's ``to_char``; the default gives plain names."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    base = spark.range(days).select(d.alias("date_actual"))
    dow = F.date_format("date_actual", "EEEE")
    month = F.date_format("date_actual", "MMMM")
    if pg_padding:
        dow, month = F.rpad(dow, 9, " "), F.rpad(month, 9, " ")
    q = F.quarter("date_actual")
    iso_dow = F.extract(F.lit("DAYOFWEEK_ISO"), F.col("date_actual"))
    return base.select(
        F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_key"),
        "date_actual",
        dow.alias("day_of_week"),
        iso_dow.cast("short").alias("day_of_week_number"),
        F.dayofmonth("date_actual").cast("short").alias("day_of_month"),
        F.dayofyear("date_actual").cast("short").alias("day_of_year"),
        F.weekofyear("date_actual").cast("short").alias("week_of_year"),
        F.month("date_actual").cast("short").alias("month_number"),
        month.alias("month_name"),
        F.date_format("date_actual", "MMM").alias("month_abbr"),
        q.cast("short").alias("quarter_number"),
        F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
        F.year("date_actual").cast("short").alias("year_number"),
        F.concat(F.year("date_actual").cast("string"), F.lit("-Q"), q.cast("string")).alias("year_quarter"),
        F.date_format("date_actual", "yyyy-MM").alias("year_month"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def dim_organization(orgs: DataFrame, apps: DataFrame, countries: DataFrame) -> DataFrame:
    o, a = orgs.alias("o"), apps.alias("a")
    oc = countries.alias("oc")
    ac = countries.alias("ac")
    j = (o.join(a, F.col("o.application_id") == F.col("a.application_id"), "inner")
          .join(oc, F.col("o.country_code") == F.col("oc.country_code"), "left")
          .join(ac, F.col("a.country_code") == F.col("ac.country_code"), "left"))
    return j.select(
        F.col("o.organization_id"), F.col("a.application_id"), F.col("a.application_name"),
        F.col("a.application_description"), F.col("a.application_is_active"),
        F.col("ac.country_code").alias("application_country_code"),
        F.col("ac.country_name").alias("application_country_name"),
        F.col("a.application_created_at"), F.col("a.application_updated_at"),
        F.col("o.organization_name"), F.col("o.organization_description"),
        F.col("o.organization_is_active"),
        F.col("oc.country_code").alias("organization_country_code"),
        F.col("oc.country_name").alias("organization_country_name"),
        F.col("o.language").alias("organization_language"),
        F.col("o.organization_created_at"), F.col("o.organization_updated_at"))


def dim_family(families: DataFrame, countries: DataFrame) -> DataFrame:
    f, c = families.alias("f"), countries.alias("c")
    return f.join(c, F.col("f.country_id") == F.col("c.country_id"), "left").select(
        "f.family_id", "f.application_id", "f.organization_id", "f.project_id", "f.is_anonymous",
        "f.family_is_active", "c.country_code", "c.country_name", "f.latitude", "f.longitude",
        "f.family_created_at", "f.family_updated_at")


def dim_survey_definition(surveys: DataFrame, countries: DataFrame) -> DataFrame:
    s, c = surveys.alias("s"), countries.alias("c")
    return s.join(c, F.col("s.country_code") == F.col("c.country_code"), "left").select(
        "s.survey_definition_id", "s.survey_code", "s.survey_title", "s.survey_description",
        "s.survey_language", "s.survey_is_active",
        F.col("c.country_code").alias("survey_country_code"),
        F.col("c.country_name").alias("survey_country_name"),
        "s.survey_created_at", "s.survey_updated_at")


def dim_economic_questions(questions: DataFrame, surveys: DataFrame) -> DataFrame:
    se, sd = questions.alias("se"), surveys.alias("sd")
    return se.join(sd, F.col("se.survey_definition_id") == F.col("sd.survey_definition_id"), "left").select(
        "se.survey_economic_id", "se.survey_definition_id", "sd.survey_code", "sd.survey_title",
        "sd.survey_description", "sd.survey_language", "sd.survey_is_active", "se.code_name",
        "se.question_text", "se.answer_type", "se.answer_options", "se.scope", "se.topic",
        "se.is_for_family_member", "sd.survey_created_at", "sd.survey_updated_at",
        "se.survey_economic_created_at", "se.survey_economic_updated_at")


# Colour level → criteria column.
COLOR_COLUMNS = {1: "red_criteria_description", 2: "yellow_criteria_description",
                 3: "green_criteria_description"}


def color_criteria_pivot(colors: DataFrame) -> DataFrame:
    """Colour rows → red / yellow / green description columns per indicator."""
    return pivot_max(colors, "survey_indicator_id", "color_value", "color_description", COLOR_COLUMNS)


def indicator_templates_translated(templates: DataFrame, translations: DataFrame) -> DataFrame:
    """Template + English name and description (a repeated key fans out)."""
    t = templates.alias("t")
    n = translations.alias("n")
    d = translations.alias("d")
    return (t.join(n, F.col("t.indicator_template_short_name") == F.col("n.translation_key"), "left")
             .join(d, F.col("t.indicator_template_description") == F.col("d.translation_key"), "left")
             .select("t.indicator_template_id", "t.dimension_id", "t.indicator_template_short_name",
                     "t.indicator_template_description",
                     F.col("n.translation_text").alias("indicator_name"),
                     F.col("d.translation_text").alias("indicator_description")))


def dim_indicator_questions(survey_indicators: DataFrame, templates: DataFrame, colors: DataFrame,
                            dimensions: DataFrame, translations: DataFrame) -> DataFrame:
    """Survey indicator ⋈ template (inner: template-less indicators vanish),
    dimension (joined on the survey indicator's own dimension id), its English
    name and the colour criteria."""
    si = survey_indicators.alias("si")
    tt = indicator_templates_translated(templates, translations).alias("tt")
    dm = dimensions.alias("dm")
    tr = translations.alias("tr")
    cp = color_criteria_pivot(colors).alias("cp")
    j = (si.join(tt, F.col("si.indicator_template_id") == F.col("tt.indicator_template_id"), "inner")
           .join(dm, F.col("si.survey_dimension_id") == F.col("dm.dimension_id"), "left")
           .join(tr, F.col("dm.dimension_met_name") == F.col("tr.translation_key"), "left")
           .join(cp, F.col("si.survey_indicator_id") == F.col("cp.survey_indicator_id"), "left"))
    return j.select(
        "si.survey_indicator_id", "si.survey_definition_id", "dm.dimension_id",
        F.col("tr.translation_text").alias("dimension_name"), "dm.dimension_is_active",
        "dm.is_core_dimension", "tt.indicator_template_id", "tt.indicator_name",
        "tt.indicator_description",
        F.col("si.indicator_code_name").alias("survey_indicator_code_name"),
        F.col("si.indicator_short_name").alias("survey_indicator_short_name"),
        F.col("si.indicator_question_text").alias("survey_indicator_question_text"),
        F.col("si.indicator_description").alias("survey_indicator_description"),
        "si.indicator_definition",
        F.col("si.indicator_is_required").alias("survey_indicator_is_required"),
        "si.order_number", "cp.red_criteria_description", "cp.yellow_criteria_description",
        "cp.green_criteria_description", "dm.dimension_created_at", "dm.dimension_updated_at",
        "si.survey_indicator_created_at", "si.survey_indicator_updated_at")
