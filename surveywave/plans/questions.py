"""Ready-made questions: dashboard charts, benchmark queries, the wide
follow-up mart used by the index benchmarks, and the business questions.

Each ``@register`` pairs a Spark builder with its DuckDB formulation.
Status counts are over responses (one row per family × indicator × survey);
"current" means each family's latest survey (``is_last``), "baseline" the
first survey of a sequence and "follow-up" any later one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveywave.functions.columns import (
    current_label, ratio, score_label, snapshot_type, survey_type)
from surveywave.operators.relational import top_k
from surveywave.operators.sequence import window_sequence
from surveywave.plans.dictionary import ValueDictionary
from surveywave.plans.registry import register
from surveywave.plans.rollups import Rollups
from surveywave.plans.warehouse import Warehouse
from surveywave.session import checkpoint_dir

# Fixed parameters of the ready-made questions.
TOP_K = 15                      # benchmark top-k (hub ranking)
FOLLOWUP_BUCKET_DAYS = 30       # time-to-follow-up histogram width
FOCUS_DIMENSION = "Housing and Infrastructure"   # dimension filter of index query 3
DATE_FROM, DATE_TO = 19960101, 19981231          # date-key range question
RECENT_DAYS = 365               # "active in follow-up" window

SCORE = {"green": 3, "yellow": 2, "red": 1, "skipped": 0}


# -- shared pieces ------------------------------------------------------------
def status_aggs(score: str = "current_score") -> list[Column]:
    """Four colour counts, the total and four shares of the total."""
    s = F.col(score)
    counts = {k: F.sum(F.when(s == v, 1).otherwise(0)).cast("long") for k, v in SCORE.items()}
    total = F.count(F.lit(1))
    out = [c.alias(f"count_{k}") for k, c in counts.items()] + [total.alias("total")]
    out += [ratio(counts[k], total).alias(f"pct_{k}") for k in SCORE]
    return out


def status_sql(score: str = "current_score") -> str:
    parts = [f"cast(sum(case when {score} = {v} then 1 else 0 end) as bigint) count_{k}"
             for k, v in SCORE.items()]
    parts.append("count(*) total")
    parts += [f"cast(sum(case when {score} = {v} then 1 else 0 end) as double) / count(*) pct_{k}"
              for k, v in SCORE.items()]
    return ", ".join(parts)


def status_counts(df: DataFrame, *keys: str, score: str = "current_score") -> DataFrame:
    """The four colour counts and the total, before names are looked up."""
    c = F.col(score)
    return df.groupBy(*keys).agg(*[F.sum(F.when(c == v, 1).otherwise(0)).alias(f"_{k}") for k, v in SCORE.items()],
                                 F.count(F.lit(1)).alias("_total"))


def status_sums() -> list[Column]:
    """status_aggs over rows of status_counts."""
    counts = {k: F.sum(f"_{k}").cast("long") for k in SCORE}
    total = F.sum("_total").cast("long")
    return ([c.alias(f"count_{k}") for k, c in counts.items()] + [total.alias("total")]
            + [ratio(c, total).alias(f"pct_{k}") for k, c in counts.items()])


def with_indicator(wh: Warehouse, per_indicator: DataFrame, *names: str) -> DataFrame:
    """Looks up indicator or dimension names for rows that were aggregated by
    survey_indicator_id first: a few rows an indicator meet a small dimension."""
    return per_indicator.join(wh.m("dim_indicator_questions").select("survey_indicator_id", *names), "survey_indicator_id", "left")


def with_family(wh: Warehouse, per_family: DataFrame, *names: str) -> DataFrame:
    """The same by family; both sides grow, so this is a shuffle on family_id
    of rows that are reduced to one a family (and key) already."""
    return per_family.join(wh.m("dim_family").select("family_id", *names), "family_id", "left")


RESPONSES_SQL = """
select fi.*, i.indicator_name, i.dimension_name, f.country_name, f.latitude, f.longitude
from fact_indicators fi
left join dim_indicator_questions i on fi.survey_indicator_id = i.survey_indicator_id
left join dim_family f on fi.family_id = f.family_id"""


def _sql(body: str) -> str:
    return f"with responses as ({RESPONSES_SQL})\n{body}"


def quarter_label(ts) -> Column:
    """'YYYY-Qn' of a date/timestamp (the date dimension's year_quarter)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def quarter_sql(ts: str) -> str:
    return f"cast(year({ts}) as varchar) || '-Q' || cast(quarter({ts}) as varchar)"


# -- charts -------------------------------------------------------------------
@register("chart_sankey", """
select baseline_label, current_label, cast(sum(family_count) as bigint) family_count
from mart_indicators where is_last group by all""")
def chart_sankey(wh):
    return (wh.m("mart_indicators").filter(F.col("is_last"))
            .groupBy("baseline_label", "current_label")
            .agg(F.sum("family_count").cast("long").alias("family_count")))


@register("chart_sankey_matched", """
select case baseline_score when 0 then 'Skipped' when 1 then 'Red' when 2 then 'Yellow'
            when 3 then 'Green' else 'N/A' end baseline_label,
       case current_score when 0 then 'Skipped' when 1 then 'Red' when 2 then 'Yellow'
            when 3 then 'Green' else 'Unknown' end current_label,
       count(*) family_count
from fact_indicators where is_last and baseline_score is not null group by all""")
def chart_sankey_matched(wh):
    fi = wh.m("fact_indicators").filter(F.col("is_last") & F.col("baseline_score").isNotNull())
    return (fi.groupBy(score_label("baseline_score", "N/A").alias("baseline_label"),
                       current_label().alias("current_label"))
            .agg(F.count(F.lit(1)).alias("family_count")))


@register("chart_line_pct_green", """
select snapshot_number,
       cast(sum(family_count) filter (where current_label = 'Green') as double)
         / nullif(cast(sum(family_count) as double), 0) pct_green
from mart_indicators group by all""")
def chart_line_pct_green(wh):
    mi = wh.m("mart_indicators")
    green = F.sum(F.when(F.col("current_label") == "Green", F.col("family_count")))
    return mi.groupBy("snapshot_number").agg(
        ratio(F.coalesce(green, F.lit(None)), F.sum("family_count")).alias("pct_green"))


@register("chart_bar_distributions", """
select 'baseline' stage, baseline_label label, cast(sum(family_count) as bigint) family_count
from mart_indicators group by all
union all
select 'current', current_label, cast(sum(family_count) as bigint) from mart_indicators group by all""")
def chart_bar_distributions(wh):
    mi = wh.m("mart_indicators")
    # one pass: each row contributes to both stages, then one aggregate
    pairs = mi.select(F.explode(F.array(
        F.struct(F.lit("baseline").alias("stage"), F.col("baseline_label").alias("label")),
        F.struct(F.lit("current").alias("stage"), F.col("current_label").alias("label")))).alias("p"),
        "family_count")
    return (pairs.groupBy(F.col("p.stage").alias("stage"), F.col("p.label").alias("label"))
            .agg(F.sum("family_count").cast("long").alias("family_count")))


@register("chart_cohort_survivor", """
with per_max as (
  select max_snapshot_number, sum(family_count) n from mart_indicators
  where snapshot_number = 1 group by all)
select max_snapshot_number min_snapshots,
       cast(sum(n) over (order by max_snapshot_number desc
                         rows between unbounded preceding and current row) as bigint) family_count
from per_max""")
def chart_cohort_survivor(wh):
    """Baseline responses whose sequence reached at least N surveys, per N."""
    per_max = (wh.m("mart_indicators").filter(F.col("snapshot_number") == 1)
               .groupBy("max_snapshot_number").agg(F.sum("family_count").alias("n")))
    # per_max has one row per distinct sequence length (a handful): the
    # running sum over it is a single small partition by construction
    w = Window.orderBy(F.col("max_snapshot_number").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return per_max.select(F.col("max_snapshot_number").alias("min_snapshots"),
                          F.sum("n").over(w).cast("long").alias("family_count"))


@register("progress_change", """
select snapshot_stoplight_id, family_id, survey_indicator_id, current_score - baseline_score progress_change
from fact_indicators where baseline_score is not null""")
def progress_change(wh):
    fi = wh.m("fact_indicators").filter(F.col("baseline_score").isNotNull())
    return fi.select("snapshot_stoplight_id", "family_id", "survey_indicator_id",
                     (F.col("current_score") - F.col("baseline_score")).alias("progress_change"))


@register("momentum_change", """
select snapshot_stoplight_id, family_id, survey_indicator_id, current_score - previous_score momentum_change
from fact_indicators where previous_score is not null""")
def momentum_change(wh):
    fi = wh.m("fact_indicators").filter(F.col("previous_score").isNotNull())
    return fi.select("snapshot_stoplight_id", "family_id", "survey_indicator_id",
                     (F.col("current_score") - F.col("previous_score")).alias("momentum_change"))


@register("achievement_cohort", """
select survey_indicator_id, count(*) achieved_after_priority
from fact_indicators where has_achievement and was_priority_in_previous group by all""")
def achievement_cohort(wh):
    fi = wh.m("fact_indicators").filter(F.col("has_achievement") & F.col("was_priority_in_previous"))
    return fi.groupBy("survey_indicator_id").agg(F.count(F.lit(1)).alias("achieved_after_priority"))


@register("families_in_country", """
select country_name, count(*) families from mart_surveys where is_last group by all""")
def families_in_country(wh):
    return (wh.m("mart_surveys").filter(F.col("is_last")).groupBy("country_name")
            .agg(F.count(F.lit(1)).alias("families")))


@register("avg_time_between_visits", """
select avg(days_since_previous) avg_days_between_visits from mart_surveys""")
def avg_time_between_visits(wh):
    return wh.m("mart_surveys").agg(F.avg("days_since_previous").alias("avg_days_between_visits"))


@register("total_surveys", "select count(*) total_surveys from mart_surveys")
def total_surveys(wh):
    return wh.m("mart_surveys").agg(F.count(F.lit(1)).alias("total_surveys"))


@register("project_reach", "select project_name, count(*) surveys from mart_surveys group by all")
def project_reach(wh):
    return wh.m("mart_surveys").groupBy("project_name").agg(F.count(F.lit(1)).alias("surveys"))


@register("time_to_followup", f"""
select cast(floor(days_since_baseline / {FOLLOWUP_BUCKET_DAYS}) * {FOLLOWUP_BUCKET_DAYS} as integer) bucket_start_days,
       count(*) surveys
from mart_surveys where snapshot_number > 1 group by all""")
def time_to_followup(wh):
    d = F.col("days_since_baseline")
    bucket = (F.floor(d / FOLLOWUP_BUCKET_DAYS) * FOLLOWUP_BUCKET_DAYS).cast("int")
    return (wh.m("mart_surveys").filter(F.col("snapshot_number") > 1)
            .groupBy(bucket.alias("bucket_start_days")).agg(F.count(F.lit(1)).alias("surveys")))


# -- benchmark queries (three layers) ---------------------------------------
def _hub_order():
    return [F.col("indicator_responses").desc(), F.col("hub_name").asc()]


@register("bench_hub_raw", f"""
with answers as (select snapshot_id id, count(*) n from raw_snapshot_stoplight group by all),
by_hub as (select application_id id, sum(n) n from raw_snapshot join answers using (id) group by all)
select name hub_name, sum(n)::bigint indicator_responses from raw_applications join by_hub using (id)
group by all order by 2 desc, 1 limit {TOP_K}""")
def bench_hub_raw(wh):
    """Raw layer: responses → snapshots → hubs (two joins)."""
    ssl = wh.raw("snapshot_stoplight").select("snapshot_id")
    snap = wh.raw("snapshot").select(F.col("id").alias("snapshot_id"), "application_id")
    apps = wh.raw("applications").select(F.col("id").alias("application_id"), F.col("name").alias("hub_name"))
    agg = (ssl.join(snap, "snapshot_id").join(apps, "application_id")
           .groupBy("hub_name").agg(F.count(F.lit(1)).alias("indicator_responses")))
    return top_k(agg, TOP_K, _hub_order())


@register("bench_hub_marts", f"""
with by_organization as (select organization_id, count(*) n from fact_indicators group by all)
select application_name hub_name, sum(n)::bigint indicator_responses
from dim_organization join by_organization using (organization_id)
group by all order by 2 desc, 1 limit {TOP_K}""")
def bench_hub_marts(wh):
    """Mart layer: one join.  Pre-aggregating the fact by organisation first
    shrinks the join input to one row per organisation."""
    per_org = wh.m("fact_indicators").groupBy("organization_id").agg(F.count(F.lit(1)).alias("n"))
    org = wh.m("dim_organization").select("organization_id", F.col("application_name").alias("hub_name"))
    agg = (per_org.join(org, "organization_id").groupBy("hub_name")
           .agg(F.sum("n").cast("long").alias("indicator_responses")))
    return top_k(agg, TOP_K, _hub_order())


@register("bench_hub_dashboard", f"""
select hub_name, sum(family_count)::bigint indicator_responses
from mart_indicators group by all order by 2 desc, 1 limit {TOP_K}""")
def bench_hub_dashboard(wh):
    """Dashboard layer: no join."""
    agg = (wh.m("mart_indicators").groupBy("hub_name")
           .agg(F.sum("family_count").cast("long").alias("indicator_responses")))
    return top_k(agg, TOP_K, _hub_order())


@register("bench_volumes", """
select 'snapshot_stoplight (raw)' tbl, count(*) row_count from raw_snapshot_stoplight
union all select 'fact_indicators (marts)', count(*) from fact_indicators
union all select 'Indicators (superset)', count(*) from mart_indicators""")
def bench_volumes(wh):
    def c(label, df):
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(label).alias("tbl"), "row_count")
    return (c("snapshot_stoplight (raw)", wh.raw("snapshot_stoplight"))
            .unionByName(c("fact_indicators (marts)", wh.m("fact_indicators")))
            .unionByName(c("Indicators (superset)", wh.m("mart_indicators"))))


SCORES = 1 << 33  # room for any score (int) and for none
LEAST_SCORE = -(1 << 31)


# -- wide follow-up mart and the index benchmark queries ---------------------
def mart_indicators_wide(wh: Warehouse) -> DataFrame:
    """One row per family × survey indicator: baseline, first follow-up
    (survey 2) and latest follow-up (greatest survey > 1) value and label."""
    fi = wh.m("fact_indicators")
    sn, sc = F.col("snapshot_number"), F.col("current_score")
    # the greatest (number, score) as one long, the score in its last bits, NULL the
    # least: a struct would make Spark sort every row before it is summed up
    latest = F.max(F.when(sn > 1, sn.cast("long") * SCORES + F.coalesce(sc.cast("long") - LEAST_SCORE + 1, F.lit(0))))
    agg = fi.groupBy("family_id", "survey_indicator_id", "survey_definition_id").agg(
        F.max("organization_id").alias("organization_id"), F.max("project_id").alias("project_id"),
        F.max(F.when(sn == 1, sc)).alias("baseline_value"),
        F.max(F.when(sn == 2, sc)).alias("first_followup_value"),
        F.when(latest % SCORES > 0, latest % SCORES + LEAST_SCORE - 1).cast(fi.schema["current_score"].dataType).alias("latest_followup_value"),
        (F.max(sn) > 1).alias("has_followup_data"))
    # names come from small dimensions: scoping and drop-downs run on this table
    diq = wh.m("dim_indicator_questions").select("survey_indicator_id", "indicator_name", "dimension_name")
    org = wh.m("dim_organization").select("organization_id", "application_id", "application_name", "organization_name")
    form = wh.m("dim_survey_definition").select("survey_definition_id", "survey_title")
    project = wh.m("stg_projects").select("project_id", "project_name")
    named = (agg.join(diq, "survey_indicator_id", "left").join(org, "organization_id", "left")
             .join(form, "survey_definition_id", "left").join(project, "project_id", "left"))
    return named.select(
        "family_id", "survey_indicator_id", "survey_definition_id", "organization_id", "application_id",
        "application_name", "organization_name", "project_name", "survey_title",
        "indicator_name", "dimension_name", "baseline_value",
        score_label("baseline_value", "N/A").alias("baseline_label"), "first_followup_value",
        score_label("first_followup_value", "N/A").alias("first_followup_label"),
        "latest_followup_value",
        score_label("latest_followup_value", "N/A").alias("latest_followup_label"),
        "has_followup_data")


def _label_sql(c: str) -> str:
    return (f"case {c} when 0 then 'Skipped' when 1 then 'Red' when 2 then 'Yellow' "
            f"when 3 then 'Green' else 'N/A' end")


WIDE_SQL = f"""
with line as (
  select family_id, survey_indicator_id, survey_definition_id, max(organization_id) organization_id,
         max(project_id) project_id, max(snapshot_number) newest,
         max(current_score) filter (snapshot_number = 1) baseline_value,
         max(current_score) filter (snapshot_number = 2) first_followup_value
  from fact_indicators group by all),
newest_answer as (
  select family_id, survey_indicator_id, survey_definition_id, snapshot_number newest, max(current_score) latest_followup_value
  from fact_indicators where snapshot_number > 1 group by all),
mart_indicators_wide as (
  select family_id, survey_indicator_id, survey_definition_id, organization_id, application_id, application_name,
         organization_name, project_name, survey_title, indicator_name, dimension_name,
         baseline_value, {_label_sql('baseline_value')} baseline_label,
         first_followup_value, {_label_sql('first_followup_value')} first_followup_label,
         latest_followup_value, {_label_sql('latest_followup_value')} latest_followup_label,
         newest > 1 has_followup_data
  from line
  left join newest_answer using (family_id, survey_indicator_id, survey_definition_id, newest)
  left join (select survey_indicator_id, indicator_name, dimension_name from dim_indicator_questions) using (survey_indicator_id)
  left join (select organization_id, application_id, application_name, organization_name from dim_organization) using (organization_id)
  left join (select survey_definition_id, survey_title from dim_survey_definition) using (survey_definition_id)
  left join (select project_id, project_name from stg_projects) using (project_id))
"""


def wide(wh: Warehouse) -> DataFrame:
    """The wide mart as a Warehouse model (built once, storable)."""
    if not wh.has("mart_indicators_wide"):
        wh.register("mart_indicators_wide", lambda: mart_indicators_wide(wh))
    return wh.m("mart_indicators_wide")


register("mart_indicators_wide", WIDE_SQL + "select * from mart_indicators_wide")(wide)

# What the index benchmark queries group and filter by.
WIDE_REQUESTS = [["baseline_label"], ["indicator_name", "baseline_value", "first_followup_value"],
                 ["dimension_name", "has_followup_data", "indicator_name", "baseline_value"],
                 ["dimension_name", "has_followup_data", "baseline_value"], ["baseline_label", "has_followup_data"],
                 ["first_followup_label", "has_followup_data"]]


def wide_rollups(wh: Warehouse) -> Rollups:
    """Rollups of the wide mart, counting its rows as n; none is stored yet."""
    if wh.wide_rollups is None:
        wh.wide_rollups = Rollups(wide(wh), {"n": lambda: F.lit(1).cast("long")})
    return wh.wide_rollups


def store_wide_rollups(wh: Warehouse, root: str) -> None:
    """Choose and publish the rollups that the benchmark queries are answered from."""
    wh.wide_rollups = None  # of the wide mart as it is now
    rollups = wide_rollups(wh)
    rollups.store(root, rollups.choose(WIDE_REQUESTS))


@register("idx_q1_label_counts", WIDE_SQL + "select baseline_label, count(*) n from mart_indicators_wide group by all")
def idx_q1(wh):
    return wide_rollups(wh).table(["baseline_label"]).groupBy("baseline_label").agg(F.sum("n").alias("n"))


@register("idx_q2_indicator_compare", WIDE_SQL + """
select indicator_name,
       cast(sum(case when baseline_value in (1, 2) then 1 else 0 end) as bigint) baseline_red_yellow,
       cast(sum(case when first_followup_value in (1, 2) then 1 else 0 end) as bigint) followup_red_yellow
from mart_indicators_wide group by all""")
def idx_q2(wh):
    w = wide_rollups(wh).table(["indicator_name", "baseline_value", "first_followup_value"])
    return w.groupBy("indicator_name").agg(
        F.sum(F.when(F.col("baseline_value").isin(1, 2), F.col("n")).otherwise(0)).cast("long").alias("baseline_red_yellow"),
        F.sum(F.when(F.col("first_followup_value").isin(1, 2), F.col("n")).otherwise(0)).cast("long")
         .alias("followup_red_yellow"))


def _green_share() -> Column:
    return F.sum(F.when(F.col("baseline_value") == 3, F.col("n")).otherwise(0)) / F.sum("n")


GREEN_SHARE_SQL = "avg(case when baseline_value = 3 then 1.0::double else 0.0::double end)"


@register("idx_q3_dimension_filter", WIDE_SQL + f"""
select indicator_name, {GREEN_SHARE_SQL} baseline_green_share from mart_indicators_wide
where dimension_name = '{FOCUS_DIMENSION}' and has_followup_data group by all""")
def idx_q3(wh):
    w = wide_rollups(wh).table(["dimension_name", "has_followup_data", "indicator_name", "baseline_value"])
    w = w.filter((F.col("dimension_name") == FOCUS_DIMENSION) & F.col("has_followup_data"))
    return w.groupBy("indicator_name").agg(_green_share().alias("baseline_green_share"))


@register("idx_q4_dimension_avg", WIDE_SQL + f"""
select dimension_name, {GREEN_SHARE_SQL} baseline_green_share from mart_indicators_wide
where has_followup_data group by all""")
def idx_q4(wh):
    w = wide_rollups(wh).table(["dimension_name", "has_followup_data", "baseline_value"]).filter(F.col("has_followup_data"))
    return w.groupBy("dimension_name").agg(_green_share().alias("baseline_green_share"))


@register("idx_q5_label_followup", WIDE_SQL + """
select baseline_label, count(*) n from mart_indicators_wide where has_followup_data group by all""")
def idx_q5(wh):
    return (wide_rollups(wh).table(["baseline_label", "has_followup_data"]).filter(F.col("has_followup_data"))
            .groupBy("baseline_label").agg(F.sum("n").alias("n")))


@register("idx_q6_followup_label", WIDE_SQL + """
select first_followup_label, count(*) n from mart_indicators_wide where has_followup_data group by all""")
def idx_q6(wh):
    return (wide_rollups(wh).table(["first_followup_label", "has_followup_data"]).filter(F.col("has_followup_data"))
            .groupBy("first_followup_label").agg(F.sum("n").alias("n")))


DROPDOWN_FIELDS = ["organization_name", "project_name", "survey_title", "hub_name"]
DROPDOWN_SQL = """
select distinct 'organization_name' field, organization_name value from mart_indicators
union select distinct 'project_name', project_name from mart_indicators
union select distinct 'survey_title', survey_title from mart_indicators
union select distinct 'hub_name', hub_name from mart_indicators"""


@register("distinct_dropdown", DROPDOWN_SQL)
def distinct_dropdown(wh):
    """Dropdown values of four filter columns in one scan and one aggregate."""
    fields = DROPDOWN_FIELDS
    pairs = wh.m("mart_indicators").select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("p"))
    return pairs.select("p.field", "p.value").distinct()


@register("dropdown_dictionary", DROPDOWN_SQL)
def dropdown_dictionary(wh):
    """The same values from a dictionary that saw the dashboard table come in two
    parts, the first one with rows that were deleted again."""
    mart = wh.m("mart_indicators")
    part = F.pmod(F.xxhash64(*mart.columns), F.lit(3))
    known = ValueDictionary(wh.spark, f"{checkpoint_dir(wh.spark).rstrip('/')}/dropdown-{uuid.uuid4().hex}", DROPDOWN_FIELDS)
    known.apply(inserted=mart.where(part < 2))
    known.apply(inserted=mart.where(part == 2), deleted=mart.where(part == 1))
    known.apply(inserted=mart.where(part == 1))
    return known.values()


# -- business questions --------------------------------------------------------
def _current(wh):
    return wh.m("fact_indicators").filter(F.col("is_last"))


@register("bq01_overall_status", _sql("""
select current_label, count(*) responses,
       cast(count(*) as double) / sum(count(*)) over () share
from (select case current_score when 0 then 'Skipped' when 1 then 'Red' when 2 then 'Yellow'
             when 3 then 'Green' else 'Unknown' end current_label from responses where is_last) t
group by all"""))
def bq01(wh):
    by = _current(wh).groupBy(current_label().alias("current_label")).agg(
        F.count(F.lit(1)).alias("responses"))
    # at most five label rows: the grand total window is one tiny partition
    total = F.sum("responses").over(Window.partitionBy())
    return by.select("current_label", "responses", ratio(F.col("responses"), total).alias("share"))


def _red_yellow_by(wh, key):
    per = with_indicator(wh, status_counts(_current(wh), "survey_indicator_id"), key)
    return per.groupBy(key).agg(F.sum("_red").cast("long").alias("red"), F.sum("_yellow").cast("long").alias("yellow"))


def _red_yellow_sql(key):
    return _sql(f"""
select {key}, cast(sum(case when current_score = 1 then 1 else 0 end) as bigint) red,
       cast(sum(case when current_score = 2 then 1 else 0 end) as bigint) yellow
from responses where is_last group by all""")


@register("bq02_dimension_need", _red_yellow_sql("dimension_name"))
def bq02(wh):
    return _red_yellow_by(wh, "dimension_name").orderBy(
        F.col("red").desc(), F.col("yellow").desc(), F.col("dimension_name").asc_nulls_last())


@register("bq03_dimension_distribution", _sql(f"""
select dimension_name, {status_sql()} from responses where is_last group by all"""))
def bq03(wh):
    per = with_indicator(wh, status_counts(_current(wh), "survey_indicator_id"), "dimension_name")
    return per.groupBy("dimension_name").agg(*status_sums())


@register("bq04_critical_indicators", _red_yellow_sql("indicator_name"))
def bq04(wh, limit: int | None = None):
    """All indicators, most critical first; a limit only on request."""
    out = _red_yellow_by(wh, "indicator_name")
    order = [F.col("red").desc(), F.col("yellow").desc(), F.col("indicator_name").asc_nulls_last()]
    return top_k(out, limit, order) if limit else out.orderBy(*order)


@register("bq05_vulnerable_indicators", _red_yellow_sql("indicator_name"))
def bq05(wh, limit: int | None = None):
    """All indicators, most vulnerable first; a limit only on request."""
    out = _red_yellow_by(wh, "indicator_name")
    order = [F.col("yellow").desc(), F.col("red").desc(), F.col("indicator_name").asc_nulls_last()]
    return top_k(out, limit, order) if limit else out.orderBy(*order)


@register("bq06_indicator_distribution", _sql(f"""
select indicator_name, {status_sql()} from responses where is_last group by all"""))
def bq06(wh):
    per = with_indicator(wh, status_counts(_current(wh), "survey_indicator_id"), "indicator_name")
    return per.groupBy("indicator_name").agg(*status_sums())


@register("bq07_sorted_indicators", _red_yellow_sql("indicator_name"))
def bq07(wh):
    """Two-level sort: red desc, then yellow desc (not their sum)."""
    return _red_yellow_by(wh, "indicator_name").orderBy(
        F.col("red").desc(), F.col("yellow").desc(), F.col("indicator_name").asc_nulls_last())


@register("bq08_family_locations", """
select cast(latitude as double) latitude, cast(longitude as double) longitude, count(*) families
from dim_family where latitude is not null and longitude is not null group by all""")
def bq08(wh):
    fam = wh.m("dim_family").filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return fam.groupBy(F.col("latitude").cast("double").alias("latitude"),
                       F.col("longitude").cast("double").alias("longitude")).agg(
        F.count(F.lit(1)).alias("families"))


@register("bq09_status_by_area", _sql(f"""
select country_name, {status_sql()} from responses where is_last group by all"""))
def bq09(wh):
    per = with_family(wh, status_counts(_current(wh), "family_id"), "country_name")
    return per.groupBy("country_name").agg(*status_sums())


@register("bq10_indicator_by_area", _sql(f"""
select indicator_name, country_name, {status_sql()} from responses where is_last group by all"""))
def bq10(wh):
    by_place = with_family(wh, status_counts(_current(wh), "family_id", "survey_indicator_id"), "country_name")
    per = by_place.groupBy("survey_indicator_id", "country_name").agg(
        *[F.sum(f"_{k}").alias(f"_{k}") for k in [*SCORE, "total"]])
    return with_indicator(wh, per, "indicator_name").groupBy("indicator_name", "country_name").agg(*status_sums())


@register("bq11_critical_areas", _sql("""
select country_name, cast(sum(case when current_score = 1 then 1 else 0 end) as double) / count(*) red_share,
       count(*) responses
from responses where is_last group by all"""))
def bq11(wh):
    per = with_family(wh, status_counts(_current(wh), "family_id"), "country_name")
    total = F.sum("_total").cast("long")
    return (per.groupBy("country_name").agg(ratio(F.sum("_red"), total).alias("red_share"), total.alias("responses"))
            .orderBy(F.col("red_share").desc(), F.col("country_name").asc_nulls_last()))


@register("bq12_progress", _sql("""
select case when snapshot_number = 1 then 'Baseline' else 'Follow-up' end stage,
       case current_score when 0 then 'Skipped' when 1 then 'Red' when 2 then 'Yellow'
            when 3 then 'Green' else 'Unknown' end current_label, count(*) responses
from responses group by all"""))
def bq12(wh):
    return wh.m("fact_indicators").groupBy(survey_type().alias("stage"), current_label().alias("current_label")) \
        .agg(F.count(F.lit(1)).alias("responses"))


def _stage_shares(wh, colour: int, out: str):
    """Per indicator: share of ``colour`` at follow-up minus at baseline, in
    percentage points."""
    s, sn = F.col("current_score"), F.col("snapshot_number")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    per = wh.m("fact_indicators").groupBy("survey_indicator_id").agg(
        one((sn == 1) & (s == colour)).alias("bh"), one(sn == 1).alias("bn"),
        one((sn > 1) & (s == colour)).alias("fh"), one(sn > 1).alias("fn"))
    g = with_indicator(wh, per, "indicator_name").groupBy("indicator_name").agg(
        ratio(F.sum("bh"), F.sum("bn")).alias("baseline_share"), ratio(F.sum("fh"), F.sum("fn")).alias("followup_share"))
    return g.select("indicator_name", "baseline_share", "followup_share",
                    ((F.col("followup_share") - F.col("baseline_share")) * 100).alias(out)) \
            .orderBy(F.col(out).desc_nulls_last(), F.col("indicator_name").asc_nulls_last())


def _stage_shares_sql(colour: int, out: str) -> str:
    return _sql(f"""
select indicator_name, baseline_share, followup_share, (followup_share - baseline_share) * 100 {out}
from (select indicator_name,
        cast(sum(case when snapshot_number = 1 and current_score = {colour} then 1 else 0 end) as double)
          / nullif(cast(sum(case when snapshot_number = 1 then 1 else 0 end) as double), 0) baseline_share,
        cast(sum(case when snapshot_number > 1 and current_score = {colour} then 1 else 0 end) as double)
          / nullif(cast(sum(case when snapshot_number > 1 then 1 else 0 end) as double), 0) followup_share
      from responses group by all) t""")


@register("bq13_most_improved", _stage_shares_sql(3, "green_pp_change"))
def bq13(wh):
    return _stage_shares(wh, 3, "green_pp_change")


@register("bq14_most_deteriorated", _stage_shares_sql(1, "red_pp_change"))
def bq14(wh):
    return _stage_shares(wh, 1, "red_pp_change")


@register("bq15_kpis_by_round", _sql(f"""
select snapshot_number, count(distinct family_id) families, {status_sql()}
from responses group by all"""))
def bq15(wh):
    return wh.m("fact_indicators").groupBy("snapshot_number").agg(
        F.countDistinct("family_id").alias("families"), *status_aggs())


def _snapshots_per_family(wh):
    return wh.m("fact_snapshots").groupBy("family_id").agg(F.count(F.lit(1)).alias("surveys"))


@register("bq16_multi_survey_families", """
select family_id, count(*) surveys from fact_snapshots group by all having count(*) >= 2""")
def bq16(wh):
    return _snapshots_per_family(wh).filter(F.col("surveys") >= 2)


@register("bq17_survey_count_histogram", """
select surveys, count(*) families from (select family_id, count(*) surveys from fact_snapshots group by all) t
group by all""")
def bq17(wh):
    return _snapshots_per_family(wh).groupBy("surveys").agg(F.count(F.lit(1)).alias("families"))


@register("bq18_status_over_time", f"""
select {quarter_sql('s.snapshot_date')} year_quarter, {status_sql('fi.current_score')}
from fact_indicators fi join fact_snapshots s on fi.snapshot_id = s.snapshot_id group by all""")
def bq18(wh):
    """Distribution per calendar quarter of the survey (the date dimension's
    year_quarter, computed from the date so surveys outside its span count)."""
    snaps = wh.m("fact_snapshots").select("snapshot_id", quarter_label("snapshot_date").alias("year_quarter"))
    return (wh.m("fact_indicators").join(snaps, "snapshot_id")
            .groupBy("year_quarter").agg(*status_aggs()))


@register("bq19_status_date_range", _sql(f"""
select {status_sql()} from responses where date_key between {DATE_FROM} and {DATE_TO}"""))
def bq19(wh):
    return wh.m("fact_indicators").filter(F.col("date_key").between(DATE_FROM, DATE_TO)).agg(*status_aggs())


@register("bq20_cohort_compare", f"""
with cohort as (select family_id, {quarter_sql('min(snapshot_date)')} cohort_quarter
                from fact_snapshots group by family_id)
select c.cohort_quarter, {status_sql('fi.current_score')}
from fact_indicators fi join cohort c on fi.family_id = c.family_id group by all""")
def bq20(wh):
    cohort = wh.m("fact_snapshots").groupBy("family_id").agg(
        quarter_label(F.min("snapshot_date")).alias("cohort_quarter"))
    return (wh.m("fact_indicators").join(cohort, "family_id")
            .groupBy("cohort_quarter").agg(*status_aggs()))


def family_snapshot_metrics(wh: Warehouse) -> DataFrame:
    return wh.m("fact_indicators").groupBy(
        "family_id", "survey_definition_id", "snapshot_id", "snapshot_number").agg(*status_aggs())


FSM_SQL = f"""
with family_snapshot_metrics as (
  select family_id, survey_definition_id, snapshot_id, snapshot_number, {status_sql()}
  from fact_indicators group by all)
"""

register("family_snapshot_metrics", FSM_SQL + "select * from family_snapshot_metrics")(family_snapshot_metrics)


@register("pct_point_change", FSM_SQL + """
select family_id, survey_definition_id, snapshot_number,
       (pct_green - lag(pct_green) over w) * 100 green_pp_change,
       (pct_yellow - lag(pct_yellow) over w) * 100 yellow_pp_change,
       (pct_red - lag(pct_red) over w) * 100 red_pp_change,
       (pct_skipped - lag(pct_skipped) over w) * 100 skipped_pp_change
from family_snapshot_metrics
window w as (partition by family_id, survey_definition_id order by snapshot_number, snapshot_id)""")
def pct_point_change(wh):
    m = family_snapshot_metrics(wh)
    seq = window_sequence(m, ["family_id", "survey_definition_id"],
                   [F.col("snapshot_number").asc_nulls_last(), F.col("snapshot_id").asc_nulls_last()],
                   lag={f"_prev_{k}": f"pct_{k}" for k in SCORE})
    return seq.select("family_id", "survey_definition_id", "snapshot_number", *[
        ((F.col(f"pct_{k}") - F.col(f"_prev_{k}")) * 100).alias(f"{k}_pp_change") for k in SCORE])


@register("engagement_counts", """
with per_family as (select family_id, count(*) surveys from fact_snapshots group by all)
select count(*) families, cast(sum(surveys) as bigint) surveys,
       cast(sum(case when surveys = 1 then 1 else 0 end) as bigint) families_one_survey,
       cast(sum(case when surveys = 2 then 1 else 0 end) as bigint) families_exactly_two,
       cast(sum(case when surveys >= 2 then 1 else 0 end) as bigint) families_two_plus,
       cast(sum(case when surveys >= 3 then 1 else 0 end) as bigint) families_three_plus,
       avg(surveys) surveys_per_family
from per_family""")
def engagement_counts(wh):
    s = F.col("surveys")
    return _snapshots_per_family(wh).agg(
        F.count(F.lit(1)).alias("families"), F.sum(s).cast("long").alias("surveys"),
        F.sum(F.when(s == 1, 1).otherwise(0)).cast("long").alias("families_one_survey"),
        F.sum(F.when(s == 2, 1).otherwise(0)).cast("long").alias("families_exactly_two"),
        F.sum(F.when(s >= 2, 1).otherwise(0)).cast("long").alias("families_two_plus"),
        F.sum(F.when(s >= 3, 1).otherwise(0)).cast("long").alias("families_three_plus"),
        F.avg(s).alias("surveys_per_family"))


@register("indicator_counts", """
with defined as (select survey_definition_id, count(*) indicators from stg_survey_stoplight group by all),
answered as (select survey_definition_id, count(*) responses from fact_indicators group by all)
select d.survey_definition_id, d.indicators, coalesce(a.responses, 0) responses
from defined d left join answered a on d.survey_definition_id = a.survey_definition_id""")
def indicator_counts(wh):
    defined = wh.m("stg_survey_stoplight").groupBy("survey_definition_id").agg(
        F.count(F.lit(1)).alias("indicators"))
    answered = wh.m("fact_indicators").groupBy("survey_definition_id").agg(
        F.count(F.lit(1)).alias("responses"))
    return defined.join(answered, "survey_definition_id", "left").select(
        "survey_definition_id", "indicators", F.coalesce("responses", F.lit(0)).cast("long").alias("responses"))


@register("geo_metrics", _sql(f"""
select cast(latitude as double) latitude, cast(longitude as double) longitude,
       count(distinct family_id) families, count(distinct snapshot_id) surveys, {status_sql()}
from responses where latitude is not null and longitude is not null group by all"""))
def geo_metrics(wh):
    # one row a snapshot, then one a family, meet the family's place
    per = status_counts(wh.m("fact_indicators"), "family_id", "snapshot_id").groupBy("family_id").agg(
        F.count(F.lit(1)).alias("_surveys"), *[F.sum(f"_{k}").alias(f"_{k}") for k in [*SCORE, "total"]])
    place = wh.m("dim_family").where("latitude is not null and longitude is not null").select(
        "family_id", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"))
    return per.join(place, "family_id").groupBy("latitude", "longitude").agg(
        F.count(F.lit(1)).alias("families"), F.sum("_surveys").alias("surveys"), *status_sums())


@register("completion_cohorts", f"""
with per_family as (
  select family_id, count(*) surveys,
         max(case when snapshot_number > 1 then snapshot_date end) last_followup
  from fact_snapshots group by all),
as_of as (select max(snapshot_date) d from fact_snapshots)
select case when surveys = 1 then 'Baseline Only'
            when last_followup >= (select d from as_of) - interval {RECENT_DAYS} day then 'Active in Follow-up'
            else 'Has Follow-up' end cohort,
       count(*) families
from per_family group by all""")
def completion_cohorts(wh, recent_days: int = RECENT_DAYS):
    fs = wh.m("fact_snapshots")
    per = fs.groupBy("family_id").agg(
        F.count(F.lit(1)).alias("surveys"),
        F.max(F.when(F.col("snapshot_number") > 1, F.col("snapshot_date"))).alias("last_followup"))
    # the as-of date is one row, joined on a constant as a broadcast of that row
    as_of = fs.agg(F.max("snapshot_date").alias("as_of")).withColumn("_one", F.lit(1))
    per = per.withColumn("_one", F.lit(1)).join(F.broadcast(as_of), "_one")
    recent = F.col("last_followup") >= (F.col("as_of") - F.expr(f"INTERVAL {recent_days} DAYS"))
    cohort = (F.when(F.col("surveys") == 1, "Baseline Only")
              .when(recent, "Active in Follow-up").otherwise("Has Follow-up"))
    return per.groupBy(cohort.alias("cohort")).agg(F.count(F.lit(1)).alias("families"))


@register("doc_family_birth_country", """
select family_id, first_value(birth_country) over (partition by family_id
         order by family_member_created_at, family_member_id) first_birth_country,
       family_member_id
from stg_family_members""")
def doc_family_birth_country(wh):
    """Documented variant: the family's first member's birth country."""
    m = wh.m("stg_family_members")
    seq = window_sequence(m, ["family_id"], [F.col("family_member_created_at").asc_nulls_last(),
                                      F.col("family_member_id").asc_nulls_last()],
                   first={"first_birth_country": "birth_country"})
    return seq.select("family_id", "first_birth_country", "family_member_id")


@register("c_snapshot_type", """
select case when snapshot_number = 1 then 'Baseline' when snapshot_number = 2 then '1st Follow-up'
            when snapshot_number = 3 then '2nd Follow-up' when snapshot_number = 4 then '3rd Follow-up'
            else cast(snapshot_number - 1 as varchar) || 'th Follow-up' end snapshot_type,
       count(*) surveys
from fact_snapshots group by all""")
def c_snapshot_type(wh):
    return wh.m("fact_snapshots").groupBy(snapshot_type().alias("snapshot_type")).agg(
        F.count(F.lit(1)).alias("surveys"))
