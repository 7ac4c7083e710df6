"""Registered queries: key → (Spark builder over a Warehouse, DuckDB oracle SQL).

Every builder reads the given tables through the Warehouse (raw tables →
staging → marts), so its work grows with the input.  Oracle SQL is ``None``
where the operator is not expressible as one SQL statement.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveywave.oracle.models import oracle
from surveywave.plans.warehouse import Warehouse
from surveywave.session import checkpoint_dir


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Warehouse], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(key: str, sql: str | None):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        QUERIES[key] = Query(key, fn, oracle(sql) if sql is not None else None)
        return fn
    return deco


def whole(model: str):
    """A model read in full (staging view, dimension, fact or mart)."""
    register(model, f"select * from {model}")(lambda wh: wh.m(model))


# -- sources, staging, dimensions, facts, marts ------------------------------
for _m in ["stg_applications", "stg_organizations", "stg_projects", "stg_countries",
           "stg_families", "stg_family_members", "stg_snapshots", "stg_snapshot_stoplight",
           "stg_snapshot_stoplight_priority", "stg_snapshot_stoplight_achievement",
           "stg_survey_definitions", "stg_survey_stoplight", "stg_survey_stoplight_indicator",
           "stg_survey_stoplight_dimension", "stg_survey_stoplight_color", "stg_translations",
           "stg_survey_economic", "stg_snapshot_economic",
           "dim_organization", "dim_family", "dim_survey_definition",
           "dim_economic_questions", "color_criteria_pivot", "indicator_templates_translated",
           "dim_indicator_questions", "fact_snapshots", "fact_indicators", "mart_indicators",
           "mart_surveys", "flow_aggregate"]:
    if _m != "flow_aggregate":
        whole(_m)


@register("flow_aggregate", "select * from flow_aggregate")
def _flow(wh):
    from surveywave.plans.marts import flow_aggregate
    return flow_aggregate(wh.m("fact_indicators"))


# -- one key per window column ---------------------------------------------
_FS_KEY = "snapshot_id, family_id, survey_definition_id"
for _key, _col in [("win_snapshot_number", "snapshot_number"), ("win_is_last", "is_last"),
                   ("win_is_baseline", "is_baseline"),
                   ("win_max_snapshot_number", "max_snapshot_number"),
                   ("win_days_since_baseline", "days_since_baseline"),
                   ("win_days_since_previous", "days_since_previous")]:
    register(_key, f"select {_FS_KEY}, {_col} from fact_snapshots")(
        (lambda c: lambda wh: wh.m("fact_snapshots").select(
            "snapshot_id", "family_id", "survey_definition_id", c))(_col))

_FI_KEY = "snapshot_stoplight_id, family_id, survey_indicator_id, snapshot_number"
for _key, _col in [("win_baseline_score", "baseline_score"), ("win_previous_score", "previous_score"),
                   ("win_was_priority_in_previous", "was_priority_in_previous"),
                   ("score_current", "current_score"),
                   ("flag_priority_achievement", "is_priority, has_achievement")]:
    _cols = [c.strip() for c in _col.split(",")]
    register(_key, f"select {_FI_KEY}, {_col} from fact_indicators")(
        (lambda cs: lambda wh: wh.m("fact_indicators").select(
            "snapshot_stoplight_id", "family_id", "survey_indicator_id", "snapshot_number", *cs))(_cols))


@register("resolve_indicator", "select snapshot_stoplight_id, snapshot_id, survey_indicator_id from fi_resolved")
def _resolve(wh):
    from surveywave.plans.facts import resolve_indicator
    snaps = wh.m("fact_snapshots").select("snapshot_id", "survey_definition_id")
    return resolve_indicator(wh.m("stg_snapshot_stoplight"), snaps, wh.m("stg_survey_stoplight")).select(
        "snapshot_stoplight_id", "snapshot_id", "survey_indicator_id")


@register("fact_existence_filter", """
select s.snapshot_id from fact_snapshots s
join dim_family f on s.family_id = f.family_id
join dim_organization o on s.organization_id = o.organization_id
join dim_survey_definition d on s.survey_definition_id = d.survey_definition_id""")
def _exist(wh):
    return (wh.m("fact_snapshots").select("snapshot_id", "family_id", "organization_id", "survey_definition_id")
            .join(wh.m("dim_family").select("family_id"), "family_id", "left_semi")
            .join(wh.m("dim_organization").select("organization_id"), "organization_id", "left_semi")
            .join(wh.m("dim_survey_definition").select("survey_definition_id"), "survey_definition_id",
                  "left_semi")
            .select("snapshot_id"))


@register("label_snapshot_type", "select distinct snapshot_number, snapshot_type from mart_indicators")
def _lst(wh):
    return wh.m("mart_indicators").select("snapshot_number", "snapshot_type").distinct()


@register("label_scores", """
select baseline_label, previous_label, current_label, cast(sum(family_count) as bigint) family_count
from mart_indicators group by all""")
def _lsc(wh):
    return (wh.m("mart_indicators").groupBy("baseline_label", "previous_label", "current_label")
            .agg(F.sum("family_count").cast("long").alias("family_count")))


# -- metric layer ------------------------------------------------------------
from surveywave.oracle.metrics import INDICATOR_SQL, SURVEY_SQL, ordered_label_sql  # noqa: E402
from surveywave.plans import semantic  # noqa: E402

IND_GROUP = ["hub_name", "snapshot_number"]
SUR_GROUP = ["hub_name", "country_name"]

for _name in semantic.INDICATOR_METRICS:
    register(f"m_{_name}",
             f"select {', '.join(IND_GROUP)}, {INDICATOR_SQL[_name]} m_{_name} "
             f"from mart_indicators group by all")(
        (lambda n: lambda wh: semantic.metric_query(
            wh.m("mart_indicators"), "Indicators", [n], IND_GROUP)
            .withColumnRenamed(n, f"m_{n}"))(_name))

for _name in semantic.SURVEY_METRICS:
    register(f"s_{_name}",
             f"select {', '.join(SUR_GROUP)}, {SURVEY_SQL[_name]} s_{_name} "
             f"from mart_surveys group by all")(
        (lambda n: lambda wh: semantic.metric_query(
            wh.m("mart_surveys"), "Surveys", [n], SUR_GROUP)
            .withColumnRenamed(n, f"s_{n}"))(_name))

for _stage in ["current", "baseline", "previous"]:
    register(f"c_{_stage}_label_ordered",
             f"select {ordered_label_sql(_stage + '_label')} {_stage}_label_ordered, "
             f"cast(sum(family_count) as bigint) count from mart_indicators group by all")(
        (lambda st: lambda wh: semantic.metric_query(
            wh.m("mart_indicators"), "Indicators", ["count"], [f"{st}_label_ordered"]))(_stage))


@register("c_survey_type", """
select case when snapshot_number = 1 then 'Baseline' else 'Follow-up' end survey_type,
       count(*) count, avg(days_since_baseline) avg_days_since_baseline
from mart_surveys group by all""")
def _c_survey_type(wh):
    return semantic.metric_query(wh.m("mart_surveys"), "Surveys",
                                 ["count", "avg_days_since_baseline"], ["survey_type"])


METRIC_QUERY_SQL = f"""
select dimension_name, {INDICATOR_SQL['count']} count, {INDICATOR_SQL['pct_green']} pct_green,
       {INDICATOR_SQL['pct_red']} pct_red, {INDICATOR_SQL['avg_improvement_steps']} avg_improvement_steps
from mart_indicators where is_last = true and snapshot_number > 1 group by all"""
# A request that groups, filters and orders: metrics, group columns, filters, order.
METRIC_REQUEST = (["count", "pct_green", "pct_red", "avg_improvement_steps"], ["dimension_name"],
                  [("is_last", "==", True), ("snapshot_number", ">", 1)], [("count", "desc"), ("dimension_name", "asc")])


@register("metric_query", METRIC_QUERY_SQL)
def _metric_query(wh):
    return semantic.metric_query(wh.m("mart_indicators"), "Indicators", *METRIC_REQUEST)


# Fixed parameters: the requests of a dashboard page that rollups are chosen for.
PAGE_REQUESTS = [METRIC_REQUEST[:3], (["count_green", "count_red"], ["hub_name"], [("is_last", "==", True)]),
                 (["count", "achievement_rate"], ["hub_name", "dimension_name"], []), (["pct_green_baseline"], ["survey_title"], [])]


@register("rollup_metric_query", METRIC_QUERY_SQL)
def _rollup_metric_query(wh):
    """The request of ``metric_query``, answered from the smallest of the rollups
    that a dashboard page's requests are worth."""
    rollups = semantic.indicator_rollups(wh.stage(wh.m("mart_indicators")))
    root = f"{checkpoint_dir(wh.spark).rstrip('/')}/rollups-{uuid.uuid4().hex}"
    rollups.store(root, rollups.choose([sorted(semantic.request_columns(*r)) for r in PAGE_REQUESTS], share=0.5))
    return semantic.rollup_query(rollups, *METRIC_REQUEST)


@register("scoped_metrics", f"""
with scope as (
  select 'hub:' || application_name user_name, application_id from stg_applications
  union all
  select 'all-hubs', application_id from stg_applications)
select s.user_name, {INDICATOR_SQL['count']} count, {INDICATOR_SQL['pct_green']} pct_green
from mart_indicators m join scope s on m.application_id = s.application_id
group by all""")
def _scoped(wh):
    scope = semantic.scope_table(wh.m("stg_applications"))
    return semantic.scoped_metrics(wh.m("mart_indicators"), scope, ["count", "pct_green"])


# -- charts, benchmarks, business questions, quality, economic ---------------
from surveywave.plans import economic, questions, quality  # noqa: E402,F401


# -- incremental refresh and late-arriving parents ------------------------------
from surveywave.streaming import incremental, late_parents, maintain  # noqa: E402

# Fixed parameters: surveys from 2000 on arrive as the new batch, with the late
# responses of the two years before.
REFRESH_CUTOFF_EPOCH = 946684800   # 2000-01-01T00:00:00Z
REFRESH_LATE_EPOCH = 883612800     # 1998-01-01T00:00:00Z


@register("incremental_refresh", "select * from fact_indicators")
def _incremental_refresh(wh):
    """Facts as they were + a batch of new snapshots, late responses and moved
    or newly told families, refreshed for the affected families only; must
    equal the full rebuild (the oracle)."""
    return incremental.demo_refresh(wh, REFRESH_CUTOFF_EPOCH, REFRESH_LATE_EPOCH)


@register("refresh_in_place", "select * from fact_indicators")
def _refresh_in_place(wh):
    """The published fact after the same rows came as three batches, each of
    which replaced the buckets of its families only."""
    return maintain.replayed(wh, REFRESH_CUTOFF_EPOCH, REFRESH_LATE_EPOCH).fact("fact_indicators")


@register("delta_flow_aggregate", "select * from flow_aggregate")
def _delta_flow_aggregate(wh):
    """The flow aggregate kept by signed deltas through the three batches."""
    return maintain.replayed(wh, REFRESH_CUTOFF_EPOCH, REFRESH_LATE_EPOCH).flow_aggregate()


@register("delta_mart_indicators", "select * from mart_indicators")
def _delta_mart_indicators(wh):
    """The dashboard table from the state that the deltas keep."""
    return maintain.replayed(wh, REFRESH_CUTOFF_EPOCH, REFRESH_LATE_EPOCH).mart_indicators(wh)


@register("late_parent_resolution", """
select p.id priority_id, p.snapshot_stoplight_id, r.snapshot_id, r.id is null is_orphan
from raw_snapshot_stoplight_priority p left join raw_snapshot_stoplight r on p.snapshot_stoplight_id = r.id""")
def _late_parent_resolution(wh):
    return late_parents.late_parent_resolution(wh)
