"""Dashboard marts: aggregate first, then decorate with small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveywave.functions.columns import (
    baseline_label, current_label, previous_label, snapshot_type)


FLOW_KEYS = [
    "organization_id", "survey_indicator_id", "survey_definition_id", "project_id",
    "snapshot_number", "is_last", "max_snapshot_number", "baseline_score", "previous_score",
    "current_score", "is_priority", "has_achievement", "was_priority_in_previous",
]

MART_INDICATOR_COLUMNS = [
    "application_id", "hub_name", "organization_name", "project_name", "indicator_name",
    "dimension_name", "survey_title", "snapshot_type", "snapshot_number", "is_last",
    "max_snapshot_number", "baseline_label", "previous_label", "current_label", "is_priority",
    "has_achievement", "was_priority_in_previous", "net_change_numeric", "family_count",
]


def flow_aggregate(fact_indicators: DataFrame) -> DataFrame:
    """Group by the 13 id/score/flag keys (partial + final hash aggregate).

    net_change_numeric is NULL when no row of the group has both scores."""
    return fact_indicators.groupBy(*FLOW_KEYS).agg(
        F.count(F.lit(1)).alias("family_count"),
        F.sum(F.col("current_score") - F.col("baseline_score")).cast("long").alias("net_change_numeric"))


def mart_indicators(fact_indicators: DataFrame, dim_organization: DataFrame,
                    dim_indicator_questions: DataFrame, dim_survey_definition: DataFrame,
                    projects: DataFrame) -> DataFrame:
    """The ``Indicators`` dashboard table.

    Only core-dimension indicators survive the final filter; since the
    indicator id is a group key, they are selected *before* aggregating
    (semi join on the small indicator dimension) so the shuffle carries less."""
    diq = dim_indicator_questions
    core_ids = diq.filter(F.col("is_core_dimension") == F.lit(True)).select("survey_indicator_id")
    agg = flow_aggregate(fact_indicators.join(core_ids.distinct(), "survey_indicator_id", "left_semi"))
    return decorate_flow(agg, dim_organization, diq, dim_survey_definition, projects)


def decorate_flow(flow: DataFrame, dim_organization: DataFrame, dim_indicator_questions: DataFrame,
                  dim_survey_definition: DataFrame, projects: DataFrame) -> DataFrame:
    """The flow aggregate with names and labels, core dimensions only."""
    agg = flow.alias("g")
    diq = dim_indicator_questions
    org = dim_organization.alias("o")
    ind = diq.alias("i")
    sdef = dim_survey_definition.alias("s")
    prj = projects.alias("p")
    j = (agg.join(org, F.col("g.organization_id") == F.col("o.organization_id"), "inner")
            .join(ind, F.col("g.survey_indicator_id") == F.col("i.survey_indicator_id"), "inner")
            .join(sdef, F.col("g.survey_definition_id") == F.col("s.survey_definition_id"), "inner")
            .join(prj, F.col("g.project_id") == F.col("p.project_id"), "left")
            .filter(F.col("i.is_core_dimension") == F.lit(True)))
    return j.select(
        F.col("o.application_id"), F.col("o.application_name").alias("hub_name"),
        F.col("o.organization_name"), F.col("p.project_name"), F.col("i.indicator_name"),
        F.col("i.dimension_name"), F.col("s.survey_title"),
        snapshot_type(F.col("g.snapshot_number")).alias("snapshot_type"),
        F.col("g.snapshot_number"), F.col("g.is_last"), F.col("g.max_snapshot_number"),
        baseline_label(F.col("g.baseline_score")).alias("baseline_label"),
        previous_label(F.col("g.previous_score")).alias("previous_label"),
        current_label(F.col("g.current_score")).alias("current_label"),
        F.col("g.is_priority"), F.col("g.has_achievement"), F.col("g.was_priority_in_previous"),
        F.col("g.net_change_numeric"), F.col("g.family_count"))


MART_SURVEY_COLUMNS = [
    "snapshot_id", "country_name", "is_last", "days_since_previous", "days_since_baseline",
    "snapshot_number", "is_baseline", "snapshot_date", "application_id", "hub_name",
    "organization_name", "project_name", "latitude", "longitude", "is_anonymous", "survey_title",
    "survey_count",
]


def mart_surveys(fact_snapshots: DataFrame, dim_family: DataFrame, dim_organization: DataFrame,
                 dim_survey_definition: DataFrame, projects: DataFrame) -> DataFrame:
    """The ``Surveys`` dashboard table: one row per snapshot.  dim_family grows
    with the data, so that join is left to the planner (a shuffle on family_id
    of both sides once the fact is stored)."""
    s = fact_snapshots.alias("s")
    f = dim_family.alias("f")
    o = dim_organization.alias("o")
    d = dim_survey_definition.alias("d")
    p = projects.alias("p")
    j = (s.join(o, F.col("s.organization_id") == F.col("o.organization_id"), "inner")
          .join(f, F.col("s.family_id") == F.col("f.family_id"), "inner")
          .join(d, F.col("s.survey_definition_id") == F.col("d.survey_definition_id"), "inner")
          .join(p, F.col("s.project_id") == F.col("p.project_id"), "left"))
    return j.select(
        F.col("s.snapshot_id"), F.coalesce(F.col("f.country_name"), F.lit("Unknown")).alias("country_name"),
        F.col("s.is_last"), F.col("s.days_since_previous"), F.col("s.days_since_baseline"),
        F.col("s.snapshot_number"), F.col("s.is_baseline"), F.col("s.snapshot_date"),
        F.col("o.application_id"), F.col("o.application_name").alias("hub_name"),
        F.col("o.organization_name"), F.col("p.project_name"), F.col("f.latitude"),
        F.col("f.longitude"), F.col("f.is_anonymous"), F.col("d.survey_title"),
        F.lit(1).alias("survey_count"))
