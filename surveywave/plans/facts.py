"""Fact models: snapshot sequence and per-indicator score alignment.

Shuffle plan (the only large exchanges of the pipeline):
* fact_snapshots  — snapshots by family (the latest one, partially reduced),
  by snapshot id, and by range of (family, survey, date) for the sequence;
* fact_indicators — responses by response id (priority / achievement flags),
  by snapshot_id (resolve), by range of (family, indicator, survey).
Where no family has more than FEW snapshots (``small``) the last of each is a
shuffle by family instead: no row is stored and moved again for its window, and
the rows of a family stay together, which they compress and sum up by.
Small sides (survey indicators, organisations, surveys) are broadcast by Spark
when their size is under the threshold, by plan or as measured at run time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveywave.functions.columns import date_key, days_between, score_or_null
from surveywave.operators.relational import keep_first
from surveywave.operators.sequence import sequence

Store = Callable[[DataFrame], DataFrame]
FEW = 10_000  # snapshots of a family: with all their responses, what a task sorts

FACT_SNAPSHOT_COLUMNS = [
    "snapshot_id", "family_id", "organization_id", "application_id", "survey_definition_id",
    "project_id", "date_key", "snapshot_date", "snapshot_number", "is_last", "is_baseline",
    "max_snapshot_number", "days_since_baseline", "days_since_previous", "stoplight_skipped",
    "is_anonymous", "snapshot_created_at", "snapshot_updated_at",
]

FACT_INDICATOR_COLUMNS = [
    "snapshot_stoplight_id", "snapshot_id", "family_id", "organization_id", "survey_indicator_id",
    "survey_definition_id", "project_id", "date_key", "snapshot_number", "is_last", "is_baseline",
    "max_snapshot_number", "current_score", "baseline_score", "previous_score", "is_priority",
    "has_achievement", "was_priority_in_previous",
]


def snapshot_order():
    """Chronological order of a family's snapshots (ascending, NULLs last)."""
    return [F.col("snapshot_date").asc_nulls_last(), F.col("snapshot_created_at").asc_nulls_last(),
            F.col("snapshot_id").asc_nulls_last()]


def latest_order():
    """ORDER BY date, created, id DESC with NULLs first (source-system DESC)."""
    return [F.col("snapshot_date").desc_nulls_first(), F.col("snapshot_created_at").desc_nulls_first(),
            F.col("snapshot_id").desc_nulls_first()]


def few_snapshots(stg_snapshots: DataFrame) -> bool:
    """No family has so many snapshots that a task should not hold them."""
    largest = stg_snapshots.groupBy("family_id").count().agg(F.max("count")).first()[0]
    return (largest or 0) <= FEW


def fact_snapshots(stg_snapshots: DataFrame, store: Store | None = None, small: bool = False) -> DataFrame:
    """Recompute the per-(family, survey) sequence; source numbers are ignored.

    is_last is per family across all surveys: the latest row of each family,
    cut to one a map task before the shuffle, then met by its snapshot id."""
    s = stg_snapshots.drop("snapshot_number", "is_last")
    last = keep_first(s.select("family_id", "snapshot_id", "snapshot_date", "snapshot_created_at"), ["family_id"], latest_order())
    last = last.select(F.col("snapshot_id").alias("_last_id"))
    s = s.join(last, s["snapshot_id"].eqNullSafe(last["_last_id"]), "left")
    seq = sequence(
        s, ["family_id", "survey_definition_id"], snapshot_order(),
        number="snapshot_number", size="max_snapshot_number",
        lag={"_prev_date": "snapshot_date"}, first={"_first_date": "snapshot_date"}, store=store, small=["family_id"] if small else [])
    return seq.select(
        "snapshot_id", "family_id", "organization_id", "application_id", "survey_definition_id",
        "project_id", date_key("snapshot_date").alias("date_key"), "snapshot_date",
        "snapshot_number", F.col("_last_id").isNotNull().alias("is_last"),
        (F.col("snapshot_number") == 1).alias("is_baseline"), "max_snapshot_number",
        days_between("snapshot_date", "_first_date").alias("days_since_baseline"),
        days_between("snapshot_date", "_prev_date").alias("days_since_previous"),
        "stoplight_skipped", "is_anonymous", "snapshot_created_at", "snapshot_updated_at")


def resolve_indicator(responses: DataFrame, snapshots: DataFrame, survey_indicators: DataFrame, *more: str) -> DataFrame:
    """Response → its snapshot → the survey's indicator on the composite key
    (survey_definition_id, normalised code).  Inner joins drop orphans.  ``more``
    are further columns of the responses that are kept."""
    si = survey_indicators.select("survey_indicator_id", "survey_definition_id", "indicator_code_name")
    r = responses.select("snapshot_stoplight_id", "snapshot_id", "indicator_code_name",
                         "indicator_status_value", *more)
    return (r.join(snapshots, "snapshot_id", "inner")
             .join(si, ["survey_definition_id", "indicator_code_name"], "inner"))


def fact_indicators(fact_snaps: DataFrame, responses: DataFrame, survey_indicators: DataFrame,
                    dim_family: DataFrame, dim_organization: DataFrame,
                    dim_survey_definition: DataFrame, priorities: DataFrame,
                    achievements: DataFrame, store: Store | None = None, small: bool = False) -> DataFrame:
    # Existence filters: the source inner-joins three dimensions without
    # selecting from them; with unique dimension keys that is a semi join.
    snaps = (fact_snaps
             .select("snapshot_id", "snapshot_number", "is_last", "is_baseline",
                     "max_snapshot_number", "snapshot_date", "family_id", "organization_id",
                     "survey_definition_id", "project_id")
             .join(dim_family.select("family_id"), "family_id", "left_semi")
             .join(dim_organization.select("organization_id"), "organization_id", "left_semi")
             .join(dim_survey_definition.select("survey_definition_id"), "survey_definition_id", "left_semi"))
    pr = priorities.select(F.col("snapshot_stoplight_id").alias("_pr_id"))
    ac = achievements.select(F.col("snapshot_stoplight_id").alias("_ac_id"))
    # flags first: by response id the narrow responses move, not what they resolve to
    r = responses.select("snapshot_stoplight_id", "snapshot_id", "indicator_code_name", "indicator_status_value")
    noted = (r.join(pr, r["snapshot_stoplight_id"] == pr["_pr_id"], "left")
             .join(ac, r["snapshot_stoplight_id"] == ac["_ac_id"], "left")
             .select(*r.columns, F.col("_pr_id").isNotNull().alias("is_priority"),
                     F.col("_ac_id").isNotNull().alias("has_achievement")))
    flagged = resolve_indicator(noted, snaps, survey_indicators, "is_priority", "has_achievement").withColumn(
        "current_score", score_or_null("indicator_status_value"))
    flagged = flagged.drop("indicator_code_name", "indicator_status_value")
    seq = sequence(
        flagged, ["family_id", "survey_indicator_id"],
        [F.col("snapshot_number").asc_nulls_last(), F.col("snapshot_stoplight_id").asc_nulls_last()],
        lag={"previous_score": "current_score", "was_priority_in_previous": "is_priority"},
        group_max={"baseline_score": F.when(F.col("is_baseline"), F.col("current_score"))}, store=store, small=["family_id"] if small else [])
    return seq.select(
        "snapshot_stoplight_id", "snapshot_id", "family_id", "organization_id",
        "survey_indicator_id", "survey_definition_id", "project_id",
        date_key("snapshot_date").alias("date_key"), "snapshot_number", "is_last", "is_baseline",
        "max_snapshot_number", "current_score", "baseline_score", "previous_score", "is_priority",
        "has_achievement", "was_priority_in_previous")
