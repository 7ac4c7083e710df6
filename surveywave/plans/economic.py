"""Economic branch: one row per economic answer with typed value columns.

answer → snapshot (inner, carries family / sequence) → the survey's question
on (survey_definition_id, normalised code) (inner; orphan answers drop).
Values are routed by the question's answer type (the answer's own type when
the question has none): exactly one of value_text / value_number /
value_date is filled.  Income rows get the currency answered in the same
snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveywave.functions.columns import date_key, mask_anonymous, surrogate_key
from surveywave.plans.registry import register
from surveywave.plans.warehouse import Warehouse
from surveywave.streaming.incremental import OverrideSource

# Question codes (normalised) and answer-type routing.
INCOME_CODE = "householdmonthlyincome"
HOUSING_CODE = "housingsituation"
VISIT_CODE = "visitdate"
TEXT_TYPES = ["text", "select", "radio"]
NUMBER_PATTERN = r"^[0-9]+\.?[0-9]*\z"


def checkbox_options(c: Column) -> Column:
    """The options of a checkbox answer, which the raw documents give as a JSON
    array or as text with bars.  The value is read as a VARIANT; what is no JSON
    array is text, a JSON number, string or object too.  NULL items are dropped
    like empty ones."""
    listed = F.try_variant_get(F.try_parse_json(c), "$", "array<string>")
    return F.coalesce(F.when(c.rlike(r"^\s*\["), listed), F.split(c, r"\|"))


def pipe_join(c: Column) -> Column:
    """Checkbox options → trimmed, de-duplicated, sorted, '|'-joined."""
    opts = F.filter(F.transform(checkbox_options(c), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(opts)), "|")


def parse_number(c: Column) -> Column:
    return F.when(c.rlike(NUMBER_PATTERN), c.try_cast("decimal(15,2)"))


def parse_epoch_ms(c: Column) -> Column:
    ms = F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("long"))
    return F.timestamp_seconds(((ms - ms % 1000) / 1000).cast("long"))


def fact_economic(wh: Warehouse) -> DataFrame:
    a = wh.m("stg_snapshot_economic").select(
        "snapshot_economic_id", "snapshot_id", "code_name",
        F.col("answer_type").alias("response_type"), "answer_value", "answer_multiple_value",
        "answer_other_text")
    s = wh.m("fact_snapshots").select("snapshot_id", "family_id", "organization_id", "survey_definition_id",
                                      "snapshot_date", "snapshot_number", "is_last")
    q = wh.m("stg_survey_economic").select(
        "survey_economic_id", "survey_definition_id", "code_name", F.col("answer_type").alias("question_type"))
    j = a.join(s, "snapshot_id").join(q, ["survey_definition_id", "code_name"])
    t = F.coalesce(F.col("question_type"), F.col("response_type"))
    v = F.col("answer_value")
    typed = j.select(
        "snapshot_economic_id", "snapshot_id", "family_id", "organization_id", "survey_definition_id",
        "survey_economic_id", "code_name", date_key("snapshot_date").alias("date_key"), "snapshot_number",
        "is_last", t.alias("answer_type"),
        F.when(t.isin(TEXT_TYPES), v)
         .when(t == "checkbox", pipe_join(F.coalesce(F.col("answer_multiple_value"), v))).alias("value_text"),
        F.when(t == "number", parse_number(v)).alias("value_number"),
        F.when(t == "date", parse_epoch_ms(v)).alias("value_date"),
        F.col("answer_other_text").alias("value_other_text"))
    # currency answered in the same snapshot (one value per snapshot)
    currency = (a.filter(F.col("code_name").like("%currency%"))
                .groupBy("snapshot_id").agg(F.max("answer_value").alias("_currency")))
    out = typed.join(currency, "snapshot_id", "left")
    return out.select(*typed.columns, F.when(F.col("code_name") == INCOME_CODE, F.col("_currency"))
                      .alias("currency_code"))


FACT_ECON_SQL = """
with econ_currency as (
  select snapshot_id, max(answer_value) currency from stg_snapshot_economic
  where code_name like '%currency%' group by snapshot_id),
fact_economic as (
  select a.snapshot_economic_id, a.snapshot_id, s.family_id, s.organization_id, s.survey_definition_id,
         q.survey_economic_id, a.code_name, cast(strftime(s.snapshot_date, '%Y%m%d') as integer) date_key,
         s.snapshot_number, s.is_last, coalesce(q.answer_type, a.answer_type) answer_type,
         case when coalesce(q.answer_type, a.answer_type) in ('text', 'select', 'radio') then a.answer_value
              when coalesce(q.answer_type, a.answer_type) = 'checkbox' then
                array_to_string(list_sort(list_distinct(list_filter(
                  list_transform(string_split(coalesce(a.answer_multiple_value, a.answer_value), '|'),
                                 lambda x: trim(x)), lambda x: x <> ''))), '|') end value_text,
         case when coalesce(q.answer_type, a.answer_type) = 'number'
                   and regexp_full_match(a.answer_value, '[0-9]+\\.?[0-9]*')
              then try_cast(a.answer_value as decimal(15,2)) end value_number,
         case when coalesce(q.answer_type, a.answer_type) = 'date' and regexp_full_match(a.answer_value, '[0-9]+')
              then make_timestamp((cast(a.answer_value as bigint) // 1000) * 1000000) end value_date,
         a.answer_other_text value_other_text,
         case when a.code_name = 'householdmonthlyincome' then c.currency end currency_code
  from stg_snapshot_economic a
  join fact_snapshots s on a.snapshot_id = s.snapshot_id
  join stg_survey_economic q on q.survey_definition_id = s.survey_definition_id and q.code_name = a.code_name
  left join econ_currency c on a.snapshot_id = c.snapshot_id)
"""

_ECON_COLS = ("snapshot_economic_id, snapshot_id, family_id, organization_id, survey_definition_id, "
              "survey_economic_id, code_name, date_key, snapshot_number, is_last, answer_type, value_text, "
              "cast(value_number as double) value_number, value_date, value_other_text, currency_code")


def _econ(wh: Warehouse) -> DataFrame:
    if not wh.has("fact_economic"):
        wh.register("fact_economic", lambda: fact_economic(wh))
    return wh.m("fact_economic")


@register("fact_economic", FACT_ECON_SQL + f"select {_ECON_COLS} from fact_economic")
def q_fact_economic(wh):
    return _econ(wh).withColumn("value_number", F.col("value_number").cast("double"))


@register("econ_typed_values", FACT_ECON_SQL + """
select answer_type, count(*) answers, count(value_text) text_values, count(value_number) number_values,
       count(value_date) date_values,
       cast(sum((value_text is not null)::int + (value_number is not null)::int
                + (value_date is not null)::int) as bigint) filled_values
from fact_economic group by all""")
def econ_typed_values(wh):
    e = _econ(wh)
    filled = sum(F.col(c).isNotNull().cast("int") for c in ["value_text", "value_number", "value_date"])
    return e.groupBy("answer_type").agg(
        F.count(F.lit(1)).alias("answers"), F.count("value_text").alias("text_values"),
        F.count("value_number").alias("number_values"), F.count("value_date").alias("date_values"),
        F.sum(filled).cast("long").alias("filled_values"))


@register("econ_numeric_parse", """
select a.snapshot_economic_id, a.code_name, a.answer_value,
       case when regexp_full_match(a.answer_value, '[0-9]+\\.?[0-9]*')
            then cast(try_cast(a.answer_value as decimal(15,2)) as double) end parsed_number
from stg_snapshot_economic a where a.answer_type in ('number', 'text')""")
def econ_numeric_parse(wh):
    a = wh.m("stg_snapshot_economic").filter(F.col("answer_type").isin("number", "text"))
    return a.select("snapshot_economic_id", "code_name", "answer_value",
                    parse_number(F.col("answer_value")).cast("double").alias("parsed_number"))


@register("econ_checkbox_join", FACT_ECON_SQL + """
select snapshot_economic_id, snapshot_id, value_text from fact_economic where answer_type = 'checkbox'""")
def econ_checkbox_join(wh):
    return _econ(wh).filter(F.col("answer_type") == "checkbox").select(
        "snapshot_economic_id", "snapshot_id", "value_text")


@register("econ_checkbox_forms", FACT_ECON_SQL + """
select snapshot_economic_id, snapshot_id, value_text from fact_economic where answer_type = 'checkbox'""")
def econ_checkbox_forms(wh):
    """The checkbox answers with every other one given as a JSON array, read
    through the whole model: one result for both forms."""
    raw = wh.raw("snapshot_economic")
    given = F.coalesce("multiple_value", "value")
    as_array = F.when((F.col("answer_type") == "checkbox") & (F.col("id") % 2 == 0), F.to_json(F.split(given, r"\|"))).otherwise(F.col("multiple_value"))
    source = OverrideSource(wh.source, {"snapshot_economic": raw.withColumn("multiple_value", as_array)})
    mixed = Warehouse(wh.spark, source, epoch_unit=wh.epoch_unit)
    mixed.use("fact_snapshots", wh.m("fact_snapshots"))
    return fact_economic(mixed).filter(F.col("answer_type") == "checkbox").select("snapshot_economic_id", "snapshot_id", "value_text")


@register("econ_currency_attach", FACT_ECON_SQL + f"""
select snapshot_id, family_id, cast(value_number as double) income, currency_code
from fact_economic where code_name = '{INCOME_CODE}'""")
def econ_currency_attach(wh):
    return _econ(wh).filter(F.col("code_name") == INCOME_CODE).select(
        "snapshot_id", "family_id", F.col("value_number").cast("double").alias("income"), "currency_code")


@register("econ_date_parse", FACT_ECON_SQL + """
select snapshot_economic_id, snapshot_id, value_date from fact_economic where answer_type = 'date'""")
def econ_date_parse(wh):
    return _econ(wh).filter(F.col("answer_type") == "date").select(
        "snapshot_economic_id", "snapshot_id", "value_date")


@register("econ_income_latest", FACT_ECON_SQL + f"""
select family_id, cast(value_number as double) income, currency_code
from fact_economic where code_name = '{INCOME_CODE}' and is_last""")
def econ_income_latest(wh):
    return (_econ(wh).filter((F.col("code_name") == INCOME_CODE) & F.col("is_last"))
            .select("family_id", F.col("value_number").cast("double").alias("income"), "currency_code"))


@register("econ_housing_latest", FACT_ECON_SQL + f"""
select family_id, answer_type, value_text housing_response
from fact_economic where code_name = '{HOUSING_CODE}' and is_last""")
def econ_housing_latest(wh):
    return (_econ(wh).filter((F.col("code_name") == HOUSING_CODE) & F.col("is_last"))
            .select("family_id", "answer_type", F.col("value_text").alias("housing_response")))


@register("econ_pivot_wide", FACT_ECON_SQL + f"""
select family_id,
       cast(max(case when code_name = '{INCOME_CODE}' then value_number end) as double) income,
       max(case when code_name = '{INCOME_CODE}' then currency_code end) currency_code,
       max(case when code_name = '{HOUSING_CODE}' then value_text end) housing,
       max(case when code_name = '{VISIT_CODE}' then value_date end) visit_date
from fact_economic where is_last group by family_id""")
def econ_pivot_wide(wh):
    """Questions as columns per family (latest survey): conditional max."""
    c = F.col("code_name")
    return _econ(wh).filter(F.col("is_last")).groupBy("family_id").agg(
        F.max(F.when(c == INCOME_CODE, F.col("value_number"))).cast("double").alias("income"),
        F.max(F.when(c == INCOME_CODE, F.col("currency_code"))).alias("currency_code"),
        F.max(F.when(c == HOUSING_CODE, F.col("value_text"))).alias("housing"),
        F.max(F.when(c == VISIT_CODE, F.col("value_date"))).alias("visit_date"))


@register("surrogate_key", """
select snapshot_stoplight_id,
       md5(concat_ws('-', coalesce(cast(snapshot_id as varchar), '_null_'),
                          coalesce(cast(survey_indicator_id as varchar), '_null_'))) surrogate_key
from fact_indicators""")
def q_surrogate_key(wh):
    return wh.m("fact_indicators").select(
        "snapshot_stoplight_id", surrogate_key("snapshot_id", "survey_indicator_id").alias("surrogate_key"))


@register("mask_anonymous", """
select family_id, is_anonymous,
       case when is_anonymous then 'ANON_DATA' else 'family ' || cast(family_id as varchar) end family_label
from dim_family""")
def q_mask_anonymous(wh):
    fam = wh.m("dim_family")
    label = F.concat(F.lit("family "), F.col("family_id").cast("string"))
    return fam.select("family_id", "is_anonymous", mask_anonymous(label, "is_anonymous").alias("family_label"))


@register("dq_number_overflow", """
select code_name, count(*) numeric_answers,
       cast(count(*) filter (where length(split_part(answer_value, '.', 1)) > 13
                             and try_cast(answer_value as decimal(15,2)) is null) as bigint) too_large
from stg_snapshot_economic where regexp_full_match(answer_value, '[0-9]+\\.?[0-9]*') group by all""")
def dq_number_overflow(wh):
    """Answers that are numbers but do not fit the declared NUMERIC(15,2), by
    question: the fact holds NULL for them, here they are counted."""
    v = F.col("answer_value")
    return (wh.m("stg_snapshot_economic").where(v.rlike(NUMBER_PATTERN)).groupBy("code_name").agg(
        F.count(F.lit(1)).alias("numeric_answers"),
        F.sum(F.when(parse_number(v).isNull(), 1).otherwise(0)).cast("long").alias("too_large")))
