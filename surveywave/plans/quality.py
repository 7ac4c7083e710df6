"""Data-quality suite: generic schema tests and the documented analyses.

Generic tests compile to "failing rows" counts: all not-null and expression
tests of a model are one aggregate over one scan; a unique, accepted-values or
relationship test is one grouped or anti-join pass.
The report has one row per test: (test, model, column, severity, failures,
status) and ``run_report`` raises only when an ``error`` test fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveywave.functions.columns import norm_key
from surveywave.plans.registry import register
from surveywave.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Check:
    test: str           # unique | not_null | relationships | accepted_values | expression_true
    model: str
    column: str
    severity: str = "error"
    parent: str | None = None        # relationships: parent model
    parent_column: str | None = None
    values: tuple = ()                # accepted_values
    expression: str | None = None     # expression_true: "> 0"


def _u(model, col, sev="error"):
    return Check("unique", model, col, sev)


def _nn(model, *cols, sev="error"):
    return [Check("not_null", model, c, sev) for c in cols]


def _rel(model, col, parent, parent_col=None, sev="error"):
    return Check("relationships", model, col, sev, parent, parent_col or col)


def _acc(model, col, values, sev="error"):
    return Check("accepted_values", model, col, sev, values=tuple(values))


# The declared test suite (keys, required columns, foreign keys, domains).
CHECKS: list[Check] = [
    _u("stg_applications", "application_id"), *_nn("stg_applications", "application_id", "application_name"),
    _u("stg_organizations", "organization_id"),
    *_nn("stg_organizations", "organization_id", "application_id", "organization_name"),
    _rel("stg_organizations", "application_id", "stg_applications"),
    _u("stg_families", "family_id"), *_nn("stg_families", "family_id", "is_anonymous"),
    _u("stg_family_members", "family_member_id"), *_nn("stg_family_members", "family_member_id", "family_id"),
    _rel("stg_family_members", "family_id", "stg_families"),
    _u("stg_snapshots", "snapshot_id"),
    *_nn("stg_snapshots", "snapshot_id", "family_id", "organization_id", "snapshot_number", "is_last"),
    _rel("stg_snapshots", "family_id", "stg_families"),
    _rel("stg_snapshots", "organization_id", "stg_organizations"),
    Check("expression_true", "stg_snapshots", "snapshot_number", expression="> 0"),
    _u("stg_snapshot_stoplight", "snapshot_stoplight_id"),
    *_nn("stg_snapshot_stoplight", "snapshot_stoplight_id", "snapshot_id", "indicator_code_name",
         "indicator_status_value"),
    _rel("stg_snapshot_stoplight", "snapshot_id", "stg_snapshots"),
    _acc("stg_snapshot_stoplight", "indicator_status_value", [0, 1, 2, 3, 9]),
    _u("stg_survey_definitions", "survey_definition_id"),
    *_nn("stg_survey_definitions", "survey_definition_id", "survey_title"),
    _u("stg_survey_stoplight", "survey_indicator_id"),
    *_nn("stg_survey_stoplight", "survey_indicator_id", "indicator_code_name"),
    _u("stg_survey_stoplight_indicator", "indicator_template_id"),
    *_nn("stg_survey_stoplight_indicator", "indicator_template_id"),
    _u("stg_survey_stoplight_dimension", "dimension_id"), *_nn("stg_survey_stoplight_dimension", "dimension_id"),
    _u("stg_survey_stoplight_color", "survey_stoplight_color_id"),
    *_nn("stg_survey_stoplight_color", "survey_stoplight_color_id", "survey_indicator_id"),
    _u("stg_survey_economic", "survey_economic_id"),
    *_nn("stg_survey_economic", "survey_economic_id", "survey_definition_id", "code_name", "answer_type"),
    _u("stg_snapshot_economic", "snapshot_economic_id"),
    *_nn("stg_snapshot_economic", "snapshot_economic_id", "snapshot_id", "code_name", "answer_type"),
    _rel("stg_snapshot_economic", "snapshot_id", "stg_snapshots"),
    _u("stg_snapshot_stoplight_priority", "snapshot_stoplight_priority_id"),
    *_nn("stg_snapshot_stoplight_priority", "snapshot_stoplight_priority_id", "snapshot_stoplight_id"),
    _rel("stg_snapshot_stoplight_priority", "snapshot_stoplight_id", "stg_snapshot_stoplight", sev="warn"),
    _u("stg_snapshot_stoplight_achievement", "snapshot_stoplight_achievement_id"),
    *_nn("stg_snapshot_stoplight_achievement", "snapshot_stoplight_achievement_id", "snapshot_stoplight_id"),
    _rel("stg_snapshot_stoplight_achievement", "snapshot_stoplight_id", "stg_snapshot_stoplight", sev="warn"),
    _u("stg_projects", "project_id"), *_nn("stg_projects", "project_id"),
    _u("stg_countries", "country_id"), *_nn("stg_countries", "country_id", "country_code", "country_name"),
    _u("dim_date", "date_key"), _u("dim_date", "date_actual"),
    *_nn("dim_date", "date_key", "date_actual", "day_of_week_number", "month_number", "quarter_number"),
    _acc("dim_date", "day_of_week_number", range(1, 8)), _acc("dim_date", "month_number", range(1, 13)),
    _acc("dim_date", "quarter_number", range(1, 5)),
    _u("dim_organization", "organization_id"),
    *_nn("dim_organization", "organization_id", "organization_name", "application_id", "application_name"),
    _u("dim_indicator_questions", "survey_indicator_id"),
    *_nn("dim_indicator_questions", "survey_indicator_id", "indicator_template_id",
         "survey_indicator_code_name", "indicator_name"),
    _u("dim_family", "family_id"), *_nn("dim_family", "family_id", "is_anonymous"),
    *_nn("dim_family", "organization_id", sev="warn"),
    _rel("dim_family", "organization_id", "dim_organization"),
    _u("dim_survey_definition", "survey_definition_id"),
    *_nn("dim_survey_definition", "survey_definition_id", "survey_title"),
    _u("dim_economic_questions", "survey_economic_id"),
    *_nn("dim_economic_questions", "survey_economic_id", "survey_definition_id", "code_name", "answer_type",
         "survey_title"),
    _rel("dim_economic_questions", "survey_definition_id", "dim_survey_definition"),
    _acc("dim_economic_questions", "answer_type",
         ["text", "number", "date", "select", "radio", "checkbox", "string"], sev="warn"),
    _u("fact_snapshots", "snapshot_id"),
    *_nn("fact_snapshots", "snapshot_id", "family_id", "organization_id", "survey_definition_id", "date_key",
         "snapshot_date", "snapshot_number", "is_last", "is_baseline", "max_snapshot_number",
         "days_since_baseline"),
    _rel("fact_snapshots", "family_id", "dim_family"),
    _rel("fact_snapshots", "organization_id", "dim_organization"),
    _rel("fact_snapshots", "survey_definition_id", "dim_survey_definition"),
    _rel("fact_snapshots", "date_key", "dim_date"),
    _u("fact_indicators", "snapshot_stoplight_id"),
    *_nn("fact_indicators", "snapshot_stoplight_id", "snapshot_id", "family_id", "organization_id",
         "survey_indicator_id", "survey_definition_id", "date_key", "snapshot_number", "is_last",
         "is_baseline", "max_snapshot_number", "is_priority", "has_achievement"),
    *_nn("mart_indicators", "application_id", "hub_name", "organization_name", "indicator_name",
         "survey_title", "snapshot_type", "snapshot_number", "is_last", "max_snapshot_number",
         "baseline_label", "current_label", "family_count"),
    _acc("mart_indicators", "baseline_label", ["Red", "Yellow", "Green", "Skipped", "N/A"]),
    _acc("mart_indicators", "current_label", ["Red", "Yellow", "Green", "Skipped", "Unknown"]),
    _u("mart_surveys", "snapshot_id"), *_nn("mart_surveys", "snapshot_id", "country_name"),
]

REPORT_COLUMNS = ["test", "model", "column", "severity", "failures"]


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All per-row tests of one model: one aggregate over one scan, its single
    row unpivoted by explode."""
    aggs: list[Column] = []
    for i, c in enumerate(checks):
        if c.test == "not_null":
            bad = F.col(c.column).isNull()
        elif c.test == "expression_true":
            bad = ~F.expr(f"`{c.column}` {c.expression}")
        else:
            raise ValueError(c.test)
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias(f"c{i}"))
    tests = F.array(*[F.struct(*_const(c, F.coalesce(F.col(f"c{i}"), F.lit(0)))) for i, c in enumerate(checks)])
    return df.agg(*aggs).select(F.explode(tests).alias("t")).select("t.*")


def _const(c: Check, failures: Column) -> list[Column]:
    return [F.lit(c.test).alias("test"), F.lit(c.model).alias("model"), F.lit(c.column).alias("column"),
            F.lit(c.severity).alias("severity"), failures.cast("long").alias("failures")]


def _unique(df: DataFrame, c: Check) -> DataFrame:
    """Distinct non-NULL values that occur more than once."""
    dup = (df.select(F.col(c.column).alias("k")).filter(F.col("k").isNotNull())
             .groupBy("k").count().filter(F.col("count") > 1))
    return dup.agg(F.count(F.lit(1)).alias("n")).select(*_const(c, F.col("n")))


def _relationship(df: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    """Non-NULL child keys absent from the parent (anti join; NULL is no failure)."""
    child = df.select(F.col(c.column).alias("k")).filter(F.col("k").isNotNull())
    par = parent.select(F.col(c.parent_column).alias("k"))
    return (child.join(par, "k", "left_anti").agg(F.count(F.lit(1)).alias("n"))
            .select(*_const(c, F.col("n"))))


def _accepted(df: DataFrame, c: Check) -> DataFrame:
    """Distinct non-NULL values outside the accepted list."""
    bad = (df.select(F.col(c.column).alias("k")).filter(F.col("k").isNotNull() & ~F.col("k").isin(list(c.values)))
             .distinct())
    return bad.agg(F.count(F.lit(1)).alias("n")).select(*_const(c, F.col("n")))


def run_checks(wh: Warehouse, tests: set[str] | None = None) -> DataFrame:
    chosen = [c for c in CHECKS if tests is None or c.test in tests]
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in chosen:
        if c.test in ("not_null", "expression_true"):
            by_model.setdefault(c.model, []).append(c)
        elif c.test == "unique":
            parts.append(_unique(wh.m(c.model), c))
        elif c.test == "relationships":
            parts.append(_relationship(wh.m(c.model), wh.m(c.parent), c))
        elif c.test == "accepted_values":
            parts.append(_accepted(wh.m(c.model), c))
    for model, checks in by_model.items():
        parts.append(_row_checks(wh.m(model), checks))
    report = reduce(DataFrame.unionByName, parts)
    status = (F.when(F.col("failures") == 0, "pass")
              .when(F.col("severity") == "warn", "warn").otherwise("fail"))
    return report.select(*REPORT_COLUMNS, status.alias("status"))


class QualityError(AssertionError):
    pass


def run_report(wh: Warehouse) -> DataFrame:
    """Run every test; raise if an error-severity test fails (warn tests only
    report).  The report is small (one row per test) and is collected."""
    report = run_checks(wh)
    failed = report.filter(F.col("status") == "fail").collect()
    if failed:
        names = ", ".join(f"{r.test}({r.model}.{r.column})={r.failures}" for r in failed)
        raise QualityError(f"{len(failed)} failing tests: {names}")
    return report


# -- oracle text of the generic tests -----------------------------------------
def check_sql(c: Check) -> str:
    head = f"select '{c.test}' test, '{c.model}' model, '{c.column}' \"column\", '{c.severity}' severity"
    col = c.column
    if c.test == "not_null":
        return f"{head}, cast(count(*) filter (where {col} is null) as bigint) failures from {c.model}"
    if c.test == "expression_true":
        return f"{head}, cast(count(*) filter (where not ({col} {c.expression})) as bigint) failures from {c.model}"
    if c.test == "unique":
        return (f"{head}, cast(count(*) as bigint) failures from (select {col} from {c.model} "
                f"where {col} is not null group by {col} having count(*) > 1) d")
    if c.test == "relationships":
        return (f"{head}, cast(count(*) as bigint) failures from {c.model} ch where ch.{col} is not null "
                f"and not exists (select 1 from {c.parent} p where p.{c.parent_column} = ch.{col})")
    if c.test == "accepted_values":
        vals = ", ".join(repr(v) if isinstance(v, str) else str(v) for v in c.values)
        return (f"{head}, cast(count(distinct {col}) as bigint) failures from {c.model} "
                f"where {col} is not null and {col} not in ({vals})")
    raise ValueError(c.test)


def report_sql(tests: set[str] | None = None) -> str:
    parts = [check_sql(c) for c in CHECKS if tests is None or c.test in tests]
    body = "\nunion all\n".join(parts)
    return (f"select *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' "
            f"else 'fail' end status from (\n{body}\n) r")


for _key, _tests in [("dq_unique", {"unique"}), ("dq_not_null", {"not_null"}),
                     ("dq_relationships", {"relationships"}), ("dq_accepted_values", {"accepted_values"}),
                     ("dq_expression_true", {"expression_true"}), ("dq_severity", None)]:
    register(_key, report_sql(_tests))((lambda t: lambda wh: run_checks(wh, t))(_tests))


@register("dq_incremental_report", report_sql())
def dq_incremental_report(wh):
    """The report of ``dq_severity``, kept by counts through three batches."""
    from surveywave.plans.quality_state import replayed_report
    return replayed_report(wh)


# -- percentage tables and the sum-to-100 test ----------------------------------
def _pct_cols(score: str = "current_score") -> list[Column]:
    s = F.col(score)
    scored = F.sum(F.when(s.isin(0, 1, 2, 3), 1).otherwise(0))
    out = []
    for name, v in [("green", 3), ("yellow", 2), ("red", 1), ("skipped", 0)]:
        hit = F.sum(F.when(s == v, 1).otherwise(0))
        out.append(F.when(scored != 0, hit.cast("double") * 100.0 / scored.cast("double")).alias(f"{name}_pct"))
    return out


def _metric_base(wh: Warehouse) -> DataFrame:
    fi = wh.m("fact_indicators").select("survey_indicator_id", "organization_id", "family_id", "snapshot_id",
                                        "current_score")
    diq = wh.m("dim_indicator_questions").select("survey_indicator_id", "dimension_name",
                                                 F.col("survey_indicator_short_name").alias("indicator_short_name"),
                                                 "survey_indicator_code_name")
    org = wh.m("dim_organization").select("organization_id", "organization_name")
    fam = wh.m("dim_family").select("family_id", "country_code")
    snap = wh.m("fact_snapshots").select("snapshot_id", F.to_date("snapshot_date").alias("snapshot_date"))
    # ids and scores are shuffled; names come after that
    return (fi.join(fam, "family_id", "left").join(snap, "snapshot_id")
              .join(diq, "survey_indicator_id").join(org, "organization_id"))


METRIC_BASE_SQL = """
with metric_base as (
  select fi.current_score, i.dimension_name, i.survey_indicator_code_name, o.organization_name,
         f.country_code, cast(s.snapshot_date as date) snapshot_date
  from fact_indicators fi
  join dim_indicator_questions i on fi.survey_indicator_id = i.survey_indicator_id
  join dim_organization o on fi.organization_id = o.organization_id
  left join dim_family f on fi.family_id = f.family_id
  join fact_snapshots s on fi.snapshot_id = s.snapshot_id)
"""


def _pct_sql() -> str:
    scored = "sum(case when current_score in (0, 1, 2, 3) then 1 else 0 end)"
    return ", ".join(
        f"case when {scored} <> 0 then cast(sum(case when current_score = {v} then 1 else 0 end) as double)"
        f" * 100.0 / cast({scored} as double) end {n}_pct"
        for n, v in [("green", 3), ("yellow", 2), ("red", 1), ("skipped", 0)])


DIM_KEYS = ["dimension_name", "organization_name", "country_code", "snapshot_date"]
IND_KEYS = ["survey_indicator_code_name", "organization_name", "country_code", "snapshot_date"]


def dimension_metrics(wh: Warehouse) -> DataFrame:
    return _metric_base(wh).groupBy(*DIM_KEYS).agg(*_pct_cols())


def indicator_metrics(wh: Warehouse) -> DataFrame:
    return _metric_base(wh).groupBy(*IND_KEYS).agg(*_pct_cols())


register("dimension_metrics", METRIC_BASE_SQL + f"select {', '.join(DIM_KEYS)}, {_pct_sql()} from metric_base group by all")(dimension_metrics)
register("indicator_metrics", METRIC_BASE_SQL + f"select {', '.join(IND_KEYS)}, {_pct_sql()} from metric_base group by all")(indicator_metrics)


@register("dq_pct_sum_100", METRIC_BASE_SQL + f"""
, dm as (select {', '.join(DIM_KEYS)}, {_pct_sql()} from metric_base group by all)
, im as (select {', '.join(IND_KEYS)}, {_pct_sql()} from metric_base group by all)
select 'dimension_metrics' table_name, dimension_name identifier,
       green_pct + yellow_pct + red_pct + skipped_pct total_pct
from dm where green_pct is not null and abs(green_pct + yellow_pct + red_pct + skipped_pct - 100.0) > 0.5
union all
select 'indicator_metrics', survey_indicator_code_name, green_pct + yellow_pct + red_pct + skipped_pct
from im where green_pct is not null and abs(green_pct + yellow_pct + red_pct + skipped_pct - 100.0) > 0.5""")
def dq_pct_sum_100(wh):
    return (sum_failures(dimension_metrics(wh), "dimension_metrics", "dimension_name")
            .unionByName(sum_failures(indicator_metrics(wh), "indicator_metrics", "survey_indicator_code_name")))


def sum_failures(df: DataFrame, table: str, ident: str) -> DataFrame:
    """Rows whose four shares miss 100 by more than half a point."""
    total = F.col("green_pct") + F.col("yellow_pct") + F.col("red_pct") + F.col("skipped_pct")
    return (df.filter(F.col("green_pct").isNotNull() & (F.abs(total - 100.0) > 0.5))
            .select(F.lit(table).alias("table_name"), F.col(ident).alias("identifier"), total.alias("total_pct")))


# -- documented data-quality analyses --------------------------------------------
@register("dq_invalid_values", """
select value, count(*) responses from raw_snapshot_stoplight
where value is null or value not in (0, 1, 2, 3, 9) group by all""")
def dq_invalid_values(wh):
    v = F.col("value")
    return (wh.raw("snapshot_stoplight").filter(v.isNull() | ~v.isin(0, 1, 2, 3, 9))
            .groupBy("value").agg(F.count(F.lit(1)).alias("responses")))


@register("dq_orphan_members", """
select count(*) orphan_members from raw_family_members where family_id is null""")
def dq_orphan_members(wh):
    return wh.raw("family_members").filter(F.col("family_id").isNull()).agg(
        F.count(F.lit(1)).alias("orphan_members"))


@register("dq_missing_answer_type", """
select cast(sum(case when answer_type is null then 1 else 0 end) as bigint) missing, count(*) total,
       cast(sum(case when answer_type is null then 1 else 0 end) as double) / count(*) share
from raw_snapshot_economic""")
def dq_missing_answer_type(wh):
    miss = F.sum(F.when(F.col("answer_type").isNull(), 1).otherwise(0))
    return wh.raw("snapshot_economic").agg(
        miss.cast("long").alias("missing"), F.count(F.lit(1)).alias("total"),
        (miss.cast("double") / F.count(F.lit(1))).alias("share"))


@register("dq_duplicate_priorities", """
select count(*) total, count(distinct snapshot_stoplight_id) distinct_responses,
       count(*) - count(distinct snapshot_stoplight_id) duplicates,
       cast(count(*) - count(distinct snapshot_stoplight_id) as double) * 100 / count(*) duplicate_pct
from raw_snapshot_stoplight_priority""")
def dq_duplicate_priorities(wh):
    total, distinct = F.count(F.lit(1)), F.countDistinct("snapshot_stoplight_id")
    return wh.raw("snapshot_stoplight_priority").agg(
        total.alias("total"), distinct.alias("distinct_responses"), (total - distinct).alias("duplicates"),
        ((total - distinct).cast("double") * 100 / total).alias("duplicate_pct"))


@register("dq_orphan_priorities", """
select 'priority' kind, count(*) total,
       cast(sum(case when r.id is null then 1 else 0 end) as bigint) orphaned,
       cast(sum(case when r.id is null then 1 else 0 end) as double) * 100 / count(*) orphan_pct
from raw_snapshot_stoplight_priority p left join raw_snapshot_stoplight r on p.snapshot_stoplight_id = r.id
union all
select 'achievement', count(*), cast(sum(case when r.id is null then 1 else 0 end) as bigint),
       cast(sum(case when r.id is null then 1 else 0 end) as double) * 100 / count(*)
from raw_snapshot_stoplight_achievement a left join raw_snapshot_stoplight r on a.snapshot_stoplight_id = r.id""")
def dq_orphan_priorities(wh):
    ids = wh.raw("snapshot_stoplight").select(F.col("id").alias("snapshot_stoplight_id"), F.lit(1).alias("_hit"))

    def one(kind, df):
        j = df.select("snapshot_stoplight_id").join(ids, "snapshot_stoplight_id", "left")
        orphan = F.sum(F.when(F.col("_hit").isNull(), 1).otherwise(0))
        return j.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("total"),
                     orphan.cast("long").alias("orphaned"),
                     (orphan.cast("double") * 100 / F.count(F.lit(1))).alias("orphan_pct"))
    return (one("priority", wh.raw("snapshot_stoplight_priority"))
            .unionByName(one("achievement", wh.raw("snapshot_stoplight_achievement"))))


@register("dq_sequence_mismatch", """
select cast(s.snapshot_number as bigint) source_number, f.snapshot_number recomputed_number,
       count(*) snapshots, count(distinct f.family_id) families
from stg_snapshots s join fact_snapshots f on s.snapshot_id = f.snapshot_id
where cast(s.snapshot_number as bigint) <> f.snapshot_number group by all""")
def dq_sequence_mismatch(wh):
    src = wh.m("stg_snapshots").select("snapshot_id", F.col("snapshot_number").cast("long").alias("source_number"))
    new = wh.m("fact_snapshots").select("snapshot_id", "family_id",
                                        F.col("snapshot_number").alias("recomputed_number"))
    return (src.join(new, "snapshot_id").filter(F.col("source_number") != F.col("recomputed_number"))
            .groupBy("source_number", "recomputed_number")
            .agg(F.count(F.lit(1)).alias("snapshots"), F.countDistinct("family_id").alias("families")))


@register("dq_duplicate_codes", """
select survey_definition_id, lower(trim(code_name)) indicator_code_name, count(*) rows_per_code
from raw_survey_stoplight group by all having count(*) > 1""")
def dq_duplicate_codes(wh):
    return (wh.raw("survey_stoplight").groupBy("survey_definition_id", norm_key("code_name").alias("indicator_code_name"))
            .agg(F.count(F.lit(1)).alias("rows_per_code")).filter(F.col("rows_per_code") > 1))


@register("dq_orphan_responses", """
select r.indicator_code_name, s.survey_definition_id, count(*) responses
from stg_snapshot_stoplight r join stg_snapshots s on r.snapshot_id = s.snapshot_id
where not exists (select 1 from stg_survey_stoplight i where i.survey_definition_id = s.survey_definition_id
                  and i.indicator_code_name = r.indicator_code_name)
group by all""")
def dq_orphan_responses(wh):
    r = wh.m("stg_snapshot_stoplight").select("snapshot_id", "indicator_code_name")
    s = wh.m("stg_snapshots").select("snapshot_id", "survey_definition_id")
    known = wh.m("stg_survey_stoplight").select("survey_definition_id", "indicator_code_name")
    return (r.join(s, "snapshot_id").join(known, ["survey_definition_id", "indicator_code_name"], "left_anti")
            .groupBy("indicator_code_name", "survey_definition_id").agg(F.count(F.lit(1)).alias("responses")))


@register("dq_date_range", """
select count(*) snapshots_outside_calendar, min(date_key) min_date_key, max(date_key) max_date_key
from fact_snapshots f where not exists (select 1 from dim_date d where d.date_key = f.date_key)""")
def dq_date_range(wh):
    out = wh.m("fact_snapshots").select("date_key").join(wh.m("dim_date").select("date_key"), "date_key", "left_anti")
    return out.agg(F.count(F.lit(1)).alias("snapshots_outside_calendar"),
                   F.min("date_key").alias("min_date_key"), F.max("date_key").alias("max_date_key"))


@register("dq_families_no_org", "select count(*) families_without_organization from stg_families where organization_id is null")
def dq_families_no_org(wh):
    return wh.m("stg_families").filter(F.col("organization_id").isNull()).agg(
        F.count(F.lit(1)).alias("families_without_organization"))


@register("dq_dimension_usage", """
with used as (
  select i.survey_dimension_id dimension_id, count(*) responses, count(distinct fi.family_id) families
  from fact_indicators fi join stg_survey_stoplight i on fi.survey_indicator_id = i.survey_indicator_id
  group by all),
in_surveys as (select distinct survey_dimension_id dimension_id from stg_survey_stoplight),
in_templates as (select distinct dimension_id from stg_survey_stoplight_indicator)
select d.dimension_id, d.dimension_met_name, coalesce(u.responses, 0) responses,
       coalesce(u.families, 0) families,
       case when s.dimension_id is null and t.dimension_id is null then 'ORPHAN'
            when t.dimension_id is null then 'DIRECT SURVEYS'
            when coalesce(u.responses, 0) < 100000 then 'LOW USAGE' else 'IN USE' end usage_class
from stg_survey_stoplight_dimension d
left join used u on d.dimension_id = u.dimension_id
left join in_surveys s on d.dimension_id = s.dimension_id
left join in_templates t on d.dimension_id = t.dimension_id""")
def dq_dimension_usage(wh, low_usage: int = 100_000):
    si = wh.m("stg_survey_stoplight")
    used = (wh.m("fact_indicators").select("survey_indicator_id", "family_id")
            .join(si.select("survey_indicator_id", F.col("survey_dimension_id").alias("dimension_id")),
                  "survey_indicator_id")
            .groupBy("dimension_id").agg(F.count(F.lit(1)).alias("responses"),
                                         F.countDistinct("family_id").alias("families")))
    in_s = si.select(F.col("survey_dimension_id").alias("dimension_id")).distinct().withColumn("_s", F.lit(1))
    in_t = wh.m("stg_survey_stoplight_indicator").select("dimension_id").distinct().withColumn("_t", F.lit(1))
    d = (wh.m("stg_survey_stoplight_dimension").select("dimension_id", "dimension_met_name")
         .join(used, "dimension_id", "left").join(in_s, "dimension_id", "left").join(in_t, "dimension_id", "left"))
    resp = F.coalesce(F.col("responses"), F.lit(0)).cast("long")
    klass = (F.when(F.col("_s").isNull() & F.col("_t").isNull(), "ORPHAN")
             .when(F.col("_t").isNull(), "DIRECT SURVEYS")
             .when(resp < low_usage, "LOW USAGE").otherwise("IN USE"))
    return d.select("dimension_id", "dimension_met_name", resp.alias("responses"),
                    F.coalesce(F.col("families"), F.lit(0)).cast("long").alias("families"),
                    klass.alias("usage_class"))


@register("dq_families_no_country", """
with lost as (select family_id, organization_id from dim_family where country_name is null),
by_org as (
  select organization_id, count(*) families_without_country,
         (select count(*) from fact_snapshots s where s.family_id in
            (select family_id from lost l where l.organization_id is not distinct from lost.organization_id)) surveys_affected
  from lost group by organization_id)
select organization_id, families_without_country, surveys_affected,
       (select count(*) from dim_family) total_families,
       families_without_country * 100.0::double / (select count(*) from dim_family) families_pct,
       surveys_affected * 100.0::double / (select count(*) from fact_snapshots) surveys_pct,
       row_number() over (order by families_without_country desc, organization_id nulls last) place
from by_org""")
def dq_families_no_country(wh):
    """Families without a country by organization, with their share of all
    families and surveys, most affected organizations first (place 1)."""
    families, surveys = wh.m("dim_family"), wh.m("fact_snapshots")
    f = families.filter(F.col("country_name").isNull()).select("family_id", "organization_id")
    counts = surveys.groupBy("family_id").agg(F.count(F.lit(1)).alias("n"))
    by_org = f.join(counts, "family_id", "left").groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("families_without_country"), F.coalesce(F.sum("n"), F.lit(0)).alias("surveys_affected"))
    # two totals of one row each
    totals = families.agg(F.count(F.lit(1)).alias("total_families")).withColumn("_one", F.lit(1)).join(
        F.broadcast(surveys.agg(F.count(F.lit(1)).alias("total_surveys")).withColumn("_one", F.lit(1))), "_one")
    # the ranking passes one row an organization through one window
    place = Window.orderBy(F.col("families_without_country").desc(), F.col("organization_id").asc_nulls_last())
    return (by_org.withColumn("_one", F.lit(1)).join(F.broadcast(totals), "_one")
            .select("organization_id", "families_without_country", "surveys_affected", "total_families",
                    (F.col("families_without_country") * 100.0 / F.col("total_families")).alias("families_pct"),
                    (F.col("surveys_affected") * 100.0 / F.col("total_surveys")).alias("surveys_pct"),
                    F.row_number().over(place).cast("long").alias("place")))


def _orphan_econ(wh):
    a = wh.m("stg_snapshot_economic").select("snapshot_id", "code_name")
    s = wh.m("stg_snapshots").select("snapshot_id", "survey_definition_id")
    q = wh.m("stg_survey_economic").select("survey_definition_id", "code_name")
    return a.join(s, "snapshot_id").join(q, ["survey_definition_id", "code_name"], "left_anti")


ORPHAN_ECON_SQL = """
with orphan_econ as (
  select a.snapshot_id, a.code_name from stg_snapshot_economic a
  join stg_snapshots s on a.snapshot_id = s.snapshot_id
  where not exists (select 1 from stg_survey_economic q
                    where q.survey_definition_id = s.survey_definition_id and q.code_name = a.code_name))
"""


@register("dq_orphan_econ_codes", ORPHAN_ECON_SQL + "select distinct code_name from orphan_econ")
def dq_orphan_econ_codes(wh):
    return _orphan_econ(wh).select("code_name").distinct()


@register("dq_orphan_econ_counts", ORPHAN_ECON_SQL + """
select code_name, count(*) answers, count(distinct snapshot_id) snapshots,
       min(snapshot_id) min_snapshot_id, max(snapshot_id) max_snapshot_id
from orphan_econ group by all""")
def dq_orphan_econ_counts(wh):
    return _orphan_econ(wh).groupBy("code_name").agg(
        F.count(F.lit(1)).alias("answers"), F.countDistinct("snapshot_id").alias("snapshots"),
        F.min("snapshot_id").alias("min_snapshot_id"), F.max("snapshot_id").alias("max_snapshot_id"))


@register("dq_econ_income_currency", """
with per as (
  select snapshot_id, max(case when code_name = 'householdmonthlyincome' then 1 else 0 end) inc,
         max(case when code_name like '%currency%' then 1 else 0 end) cur
  from stg_snapshot_economic group by snapshot_id)
select cast(sum(case when inc = 1 and cur = 0 then 1 else 0 end) as bigint) income_only,
       cast(sum(case when inc = 0 and cur = 1 then 1 else 0 end) as bigint) currency_only,
       cast(sum(case when inc = 1 and cur = 1 then 1 else 0 end) as bigint) both_present
from per""")
def dq_econ_income_currency(wh):
    c = F.col("code_name")
    per = wh.m("stg_snapshot_economic").groupBy("snapshot_id").agg(
        F.max(F.when(c == "householdmonthlyincome", 1).otherwise(0)).alias("inc"),
        F.max(F.when(c.like("%currency%"), 1).otherwise(0)).alias("cur"))
    i, u = F.col("inc"), F.col("cur")
    return per.agg(
        F.sum(F.when((i == 1) & (u == 0), 1).otherwise(0)).cast("long").alias("income_only"),
        F.sum(F.when((i == 0) & (u == 1), 1).otherwise(0)).cast("long").alias("currency_only"),
        F.sum(F.when((i == 1) & (u == 1), 1).otherwise(0)).cast("long").alias("both_present"))


@register("dq_natural_key", """
select count(*) duplicate_keys from (select snapshot_id, survey_indicator_id from fact_indicators
group by all having count(*) > 1) d""")
def dq_natural_key(wh):
    return (wh.m("fact_indicators").groupBy("snapshot_id", "survey_indicator_id").count()
            .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("duplicate_keys")))


# The documented ranges; a date is out of range before 2018 or
# after the newest change recorded in the snapshots (no survey is of the future).
_RAW_RANGES = [("latitude", 90), ("longitude", 180)]


@register("dq_geo_range", "".join(f"""
select '{c}_out_of_range' "check", count(*) failures from raw_family
where try_cast(trim({c}) as double) not between -{m} and {m}
union all
select '{c}_not_a_number', count(*) from raw_family
where trim({c}) <> '' and try_cast(trim({c}) as double) is null
union all""" for c, m in _RAW_RANGES) + """
select 'snapshot_before_2018', count(*) from fact_snapshots where snapshot_date < timestamp '2018-01-01'
union all
select 'snapshot_after_last_change', count(*) from fact_snapshots
where snapshot_date > (select max(snapshot_created_at) from fact_snapshots)
union all
select 'snapshot_without_date', count(*) from fact_snapshots where snapshot_date is null""")
def dq_geo_range(wh):
    """Coordinates as the raw table has them (staging blanks bad ones) and
    survey dates outside 2018 to the newest change; a scan of each table."""
    fam, checks = wh.raw("family"), []
    for c, most in _RAW_RANGES:
        number = F.trim(c).try_cast("double")
        checks.append((f"{c}_out_of_range", ~number.between(-most, most)))
        checks.append((f"{c}_not_a_number", (F.trim(c) != "") & number.isNull()))
    date = F.col("snapshot_date")
    snaps = wh.m("fact_snapshots").select("snapshot_date", "snapshot_created_at")
    newest = snaps.agg(F.max("snapshot_created_at").alias("_newest")).withColumn("_one", F.lit(1))
    snaps = snaps.withColumn("_one", F.lit(1)).join(F.broadcast(newest), "_one")  # one row
    dated = [("snapshot_before_2018", date < F.lit("2018-01-01").cast("timestamp")),
             ("snapshot_after_last_change", date > F.col("_newest")), ("snapshot_without_date", date.isNull())]

    def counts(df, tests):
        one = df.agg(*[F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(n) for n, bad in tests])
        rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n, _ in tests])
        return one.select(F.explode(rows).alias("r")).select("r.*")
    return counts(fam, checks).unionByName(counts(snaps, dated))
