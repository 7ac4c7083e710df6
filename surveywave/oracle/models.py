"""DuckDB formulation of the raw tables and models (the correctness oracle).

Plain SQL over the driver views (region, nation, customer, part, orders,
lineitem), written from the stated meaning of each model and by other means than
the Spark code: a running number is a count of the rows not after it, the last
row of a group an arg_max, a previous value a join on the number before, a flag
a membership test, a name a lookup.  ``oracle(final)`` prefixes a query with
exactly the CTEs it references (transitively).
"""

from __future__ import annotations

import re

AUDIT = "TIMESTAMP '2020-01-01 00:00:00'"
EPOCH = "cast(epoch(o_orderdate) as bigint)"

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.replace("{AUDIT}", AUDIT).replace("{EPOCH}", EPOCH)


# --------------------------------------------------------------------------
# raw tables (fixture mapping, FIXTURES.md §2)
# --------------------------------------------------------------------------
cte("raw_applications", """
select cast(r_regionkey as bigint) id, r_name name, concat('hub ', r_name) description,
       true is_active, concat(chr(65 + r_regionkey), 'X') country_code,
       {AUDIT} created_date, {AUDIT} last_modified_date
from region""")

cte("raw_organizations", """
select cast(n_nationkey as bigint) id, cast(n_regionkey as bigint) application_id, n_name name,
       cast(null as varchar) description, cast(null as boolean) is_active,
       concat(chr(65 + n_nationkey), 'X') country_code, 'en' language,
       {AUDIT} created_date, {AUDIT} last_modified_date
from nation""")

cte("raw_countries", """
select cast(n_nationkey as bigint) id, n_name country, concat(chr(65 + n_nationkey), 'X ') alfa_2_code
from nation""")

cte("raw_projects", """
select id, cast(null as bigint) organization_id, title, cast(null as varchar) description,
       cast(null as boolean) active, cast(null as date) from_date, cast(null as date) to_date,
       cast(null as timestamp) created_at
from (select distinct cast(case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
             when 'FURNITURE' then 3 else 4 end as bigint) id, c_mktsegment title
      from customer where c_mktsegment <> 'MACHINERY') p""")

cte("raw_family", """
select c_custkey family_id,
       case when c_custkey % 500 = 7 then null else cast(c_nationkey as bigint) end country,
       cast(n_regionkey as bigint) application_id, cast(c_nationkey as bigint) organization_id,
       cast(case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
            when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 end as bigint) project_id,
       true is_active, c_custkey % 10 = 0 anonymous,
       case when c_custkey % 97 = 0 then 'n/a' when c_custkey % 101 = 0 then ''
            else cast(cast(c_acctbal / 50 as decimal(12,3)) as varchar) end latitude,
       case when c_custkey % 89 = 0 then null
            else cast(cast(c_acctbal / 25 as decimal(12,3)) as varchar) end longitude,
       {AUDIT} created_date, {AUDIT} last_modified_date
from customer join nation on c_nationkey = n_nationkey""")

cte("raw_family_members", """
select c_custkey id, case when c_custkey % 200 = 3 then null else c_custkey end family_id,
       cast(null as boolean) first_participant, cast(null as boolean) active,
       cast(null as boolean) anonymous,
       case c_custkey % 9 when 0 then 'M' when 1 then 'F' when 2 then 'MASCULINO' when 3 then 'FEMENINO'
            when 4 then 'LALAKI' when 5 then 'FI' when 6 then 'O' when 7 then 'ANON_DATA' end gender,
       case when c_custkey % 7 = 0 then '' when c_custkey % 11 = 0 then null else n_name end birth_country,
       {AUDIT} created_date, {AUDIT} last_modified_date
from customer join nation on c_nationkey = n_nationkey""")

cte("raw_survey_definition", """
select id, cast(null as varchar) survey_code, title, cast(null as varchar) description,
       cast(null as varchar) lang, cast(null as boolean) active, country_code,
       cast(null as timestamp) created_at, cast(null as timestamp) updated_at
from (select distinct cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) id, o_orderpriority title,
             concat(chr(64 + cast(regexp_extract(o_orderpriority, '^[0-9]+') as int)), 'X') country_code
      from orders) s""")

cte("raw_survey_stoplight_dimension", """
select cast(n_nationkey as bigint) id,
       case n_nationkey when 0 then 'housingAndInfrastructure.name' when 1 then 'HealthAndEnvironment.name'
            when 2 then ' educationAndCulture.name ' when 3 then 'incomeAndEmployment.name'
            when 4 then 'interiorityAndMotivation.name' when 5 then 'organizationAndParticipation.name'
            else 'aNewDimensionTest.name' end met_name, 'ACTIVE' status,
       {AUDIT} created_date, {AUDIT} last_modified_date
from nation where n_nationkey < 7""")

cte("raw_survey_stoplight_indicator", """
select distinct cast(substr(p_brand, 7) as bigint) id,
       cast(substr(p_brand, 7) as bigint) % 7 survey_dimension_id,
       concat(' ', p_brand, '.name') met_short_name, concat(p_brand, '.description') met_description
from part where cast(substr(p_brand, 7) as int) <> 24""")

cte("raw_survey_stoplight", """
select id, survey_definition_id, survey_indicator_id, survey_dimension_id, code_name,
       cast(null as varchar) short_name, cast(null as varchar) question_text,
       cast(null as varchar) description, cast(null as varchar) definition,
       cast(null as boolean) required, order_number, cast(null as date) created_at, updated_at
from (
  select sd * 100 + b id, sd survey_definition_id, cast(b as bigint) survey_indicator_id,
         cast(b % 8 as bigint) survey_dimension_id,
         case when b % 2 = 0 then concat(' BRAND#', cast(b as varchar), ' ')
              else concat('Brand#', cast(b as varchar)) end code_name,
         cast(b as int) order_number, date '2020-01-01' updated_at
  from (select distinct cast(substr(p_brand, 7) as int) b from part) p
  cross join (select distinct cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) sd from orders) o
  where b % 12 <> sd
  union all
  select cast(9000 as bigint), cast(3 as bigint), cast(5 as bigint), cast(5 as bigint), 'brand#5',
         99, date '2019-01-01'
) x""")

cte("raw_survey_stoplight_color", """
select (sd * 100 + b) * 10 + k id, sd * 100 + b survey_stoplight_id, cast(k as int) value,
       concat('level ', cast(k as varchar), ' of ', cast(b as varchar)) description,
       cast(null as date) created_at, cast(null as date) updated_at
from (select distinct cast(substr(p_brand, 7) as int) b from part) p
cross join (select distinct cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) sd from orders) o
cross join (select cast(r_regionkey as bigint) k from region) r
where b % 12 <> sd and not (b = 6 and k = 2)""")

cte("raw_translation", """
select distinct cast(substr(p_brand, 7) as bigint) id, concat(upper(p_brand), '.NAME') key, 'EN' lang,
       concat('Indicator ', substr(p_brand, 7)) translation from part
union all
select distinct cast(substr(p_brand, 7) as bigint) + 100, concat(p_brand, '.name'), 'ES',
       concat('Indicador ', substr(p_brand, 7)) from part
union all
select distinct cast(substr(p_brand, 7) as bigint) + 200, concat(p_brand, '.description'), 'EN',
       concat('About ', p_brand) from part where cast(substr(p_brand, 7) as int) % 3 <> 0
union all
select cast(n_nationkey as bigint) + 300,
       case n_nationkey when 0 then 'housingAndInfrastructure.name' when 1 then 'healthAndEnvironment.name'
            when 2 then 'educationAndCulture.name' when 3 then 'incomeAndEmployment.name'
            when 4 then 'interiorityAndMotivation.name' else 'organizationAndParticipation.name' end, 'EN',
       case n_nationkey when 0 then 'Housing and Infrastructure' when 1 then 'Health and Environment'
            when 2 then 'Education and Culture' when 3 then 'Income and Employment'
            when 4 then 'Interiority and Motivation' else 'Organization and Participation' end
from nation where n_nationkey < 6""")

cte("raw_snapshot", """
select o_orderkey id, o_custkey family_id, cast(c_nationkey as bigint) organization_id,
       cast(n_regionkey as bigint) application_id,
       cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) survey_definition_id,
       cast(case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
            when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 end as bigint) project_id,
       cast(row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) as smallint) snapshot_number,
       row_number() over (partition by o_custkey order by o_orderkey desc) = 1 is_last,
       c_custkey % 10 = 0 anonymous, o_orderstatus = 'P' stoplight_skipped,
       {EPOCH} snapshot_date, {EPOCH} + o_orderkey % 3600 created_at,
       {AUDIT} last_modified_date
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""")

cte("raw_response_flags", """
select l_orderkey * 100 + cast(substr(p_brand, 7) as int) id, l_orderkey snapshot_id, p_brand code_name,
       min(case when l_quantity = 50 then 4
                when cast(l_quantity as int) % 5 = 4 then 9
                else cast(l_quantity as int) % 5 end) value,
       max(case when l_returnflag = 'R' then 1 else 0 end) pr,
       max(case when l_returnflag = 'A' and l_linestatus = 'F' then 1 else 0 end) ach
from lineitem join part on l_partkey = p_partkey
group by l_orderkey, p_brand""")

cte("raw_snapshot_stoplight", """
select id, snapshot_id, code_name, cast(value as int) value, false additional,
       {AUDIT} created_date, cast(1600000000999 as bigint) updated_at
from raw_response_flags""")

cte("raw_snapshot_stoplight_priority", """
select id, snapshot_stoplight_id, reason, cast(null as varchar) action, cast(null as bigint) estimated_date,
       {AUDIT} created_date, {AUDIT} last_modified_date
from (
  select id * 2 id, id snapshot_stoplight_id, 'first' reason from raw_response_flags where pr = 1
  union all
  select id * 2 + 1, id, 'duplicate' from raw_response_flags where pr = 1 and id % 500 = 11
  union all
  select id * 2 + 1, -id, 'orphan' from raw_response_flags where pr = 1 and id % 900 = 7
) p""")

cte("raw_snapshot_stoplight_achievement", """
select id, id snapshot_stoplight_id, 'action' action, cast(null as varchar) roadmap,
       {AUDIT} created_date, {AUDIT} last_modified_date
from raw_response_flags where ach = 1""")

cte("raw_survey_economic", """
select id, survey_definition_id, code_name, cast(null as varchar) question_text, answer_type,
       cast(null as varchar) answer_options, cast(null as varchar) scope,
       cast(null as boolean) for_family_member, cast(null as varchar) topic,
       cast(null as date) created_at, cast(null as date) updated_at
from (
  select distinct cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) * 10 + q id,
         cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) survey_definition_id,
         case q when 0 then ' householdMonthlyIncome' when 1 then 'currency'
                when 2 then 'housingSituation' else 'visitDate' end code_name,
         case q when 0 then 'number' when 1 then 'string' when 2 then 'checkbox' else 'date' end answer_type
  from orders cross join (select cast(r_regionkey as bigint) q from region where r_regionkey < 4) r
  where cast(regexp_extract(o_orderpriority, '^[0-9]+') as bigint) * 10 + q <> 52
) e""")

cte("raw_snapshot_economic", """
select id, snapshot_id, code_name, answer_type, value, cast(null as varchar) multiple_value,
       case when code_name = 'housingSituation' and snapshot_id % 10 = 0 then 'other ' || o.o_orderstatus end other_text,
       {AUDIT} created_date, {AUDIT} last_modified_date
from (
  select o_orderkey * 10 id, o_orderkey snapshot_id, 'householdMonthlyIncome' code_name,
         case when o_orderkey % 50 = 0 then null else 'string' end answer_type,
         case when o_orderkey % 40 = 0 then 'unknown'
              else cast(cast(o_totalprice as decimal(15,2)) as varchar) end value
  from orders where o_orderkey % 3 <> 2
  union all
  select o_orderkey * 10 + 1, o_orderkey, 'currency', 'string',
         case o_orderkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'BRL' end
  from orders where o_orderkey % 4 <> 1
  union all
  select o_orderkey * 10 + 2, o_orderkey, 'housingSituation', 'checkbox',
         concat(o_orderstatus, '|', o_orderpriority)
  from orders where o_orderkey % 5 = 0
  union all
  select o_orderkey * 10 + 3, o_orderkey, 'visitDate', 'date', cast({EPOCH} * 1000 as varchar)
  from orders where o_orderkey % 7 = 0
) e join orders o on o.o_orderkey = e.snapshot_id""")

# --------------------------------------------------------------------------
# staging
# --------------------------------------------------------------------------
cte("stg_applications", """
select id application_id, name application_name, description application_description,
       is_active application_is_active, country_code, created_date application_created_at,
       last_modified_date application_updated_at
from raw_applications""")

cte("stg_organizations", """
select id organization_id, application_id, name organization_name, description organization_description,
       is_active organization_is_active, country_code, language, created_date organization_created_at,
       last_modified_date organization_updated_at
from raw_organizations""")

cte("stg_projects", """
select id project_id, organization_id, title project_name, description project_description,
       active project_is_active, from_date, to_date, created_at project_created_at
from raw_projects""")

cte("stg_countries", """
select id country_id, trim(alfa_2_code) country_code, country country_name from raw_countries""")

cte("stg_families", """
select family_id, country country_id, application_id, organization_id, project_id,
       is_active family_is_active, anonymous is_anonymous,
       case when regexp_full_match(latitude, '-?[0-9]+\\.?[0-9]*')
                 and try_cast(latitude as decimal(38,18)) between -90 and 90
            then cast(round(try_cast(latitude as decimal(38,18)), 2) as decimal(5,2)) end latitude,
       case when regexp_full_match(longitude, '-?[0-9]+\\.?[0-9]*')
                 and try_cast(longitude as decimal(38,18)) between -180 and 180
            then cast(round(try_cast(longitude as decimal(38,18)), 2) as decimal(5,2)) end longitude,
       created_date family_created_at, last_modified_date family_updated_at
from raw_family""")

cte("stg_family_members", """
select id family_member_id, family_id, first_participant, active family_member_is_active,
       anonymous is_anonymous,
       case when gender in ('M', 'MASCULINO', 'LALAKI', 'GASON', 'Male') then 'Male'
            when gender in ('F', 'FEMENINO', 'BABAE', 'FI', 'Female') then 'Female'
            else 'Other' end gender,
       coalesce(nullif(birth_country, ''), 'Unknown') birth_country,
       created_date family_member_created_at, last_modified_date family_member_updated_at
from raw_family_members where family_id is not null""")

cte("stg_snapshots", """
select id snapshot_id, family_id, organization_id, application_id, survey_definition_id, project_id,
       snapshot_number, is_last, anonymous is_anonymous, stoplight_skipped,
       make_timestamp(snapshot_date * 1000000) snapshot_date,
       make_timestamp(created_at * 1000000) snapshot_created_at,
       last_modified_date snapshot_updated_at
from raw_snapshot""")

cte("stg_snapshot_stoplight", """
select id snapshot_stoplight_id, snapshot_id, lower(trim(code_name)) indicator_code_name,
       value indicator_status_value, additional is_additional,
       created_date snapshot_stoplight_created_at,
       make_timestamp((updated_at // 1000) * 1000000) snapshot_stoplight_updated_at
from raw_snapshot_stoplight where value in (0, 1, 2, 3, 9)""")

cte("stg_snapshot_stoplight_priority", """
select id snapshot_stoplight_priority_id, snapshot_stoplight_id, reason, action, estimated_date,
       created_date priority_created_at, last_modified_date priority_updated_at
from raw_snapshot_stoplight_priority
qualify row_number() over (partition by snapshot_stoplight_id order by id) = 1""")

cte("stg_snapshot_stoplight_achievement", """
select id snapshot_stoplight_achievement_id, snapshot_stoplight_id, action, roadmap,
       created_date achievement_created_at, last_modified_date achievement_updated_at
from raw_snapshot_stoplight_achievement
qualify row_number() over (partition by snapshot_stoplight_id order by id) = 1""")

cte("stg_survey_definitions", """
select id survey_definition_id, survey_code, title survey_title, description survey_description,
       lang survey_language, active survey_is_active, country_code, created_at survey_created_at,
       updated_at survey_updated_at
from raw_survey_definition""")

cte("stg_survey_stoplight", """
select id survey_indicator_id, survey_definition_id, survey_indicator_id indicator_template_id,
       survey_dimension_id, lower(trim(code_name)) indicator_code_name,
       short_name indicator_short_name, question_text indicator_question_text,
       description indicator_description, definition indicator_definition,
       required indicator_is_required, order_number,
       created_at survey_indicator_created_at, updated_at survey_indicator_updated_at
from raw_survey_stoplight
qualify row_number() over (partition by survey_definition_id, lower(trim(code_name))
                           order by updated_at desc nulls first, id asc) = 1""")

cte("stg_survey_stoplight_indicator", """
select id indicator_template_id, survey_dimension_id dimension_id,
       lower(trim(met_short_name)) indicator_template_short_name,
       lower(trim(met_description)) indicator_template_description
from raw_survey_stoplight_indicator""")

cte("stg_survey_stoplight_dimension", """
select id dimension_id, lower(trim(met_name)) dimension_met_name, status dimension_is_active,
       lower(trim(met_name)) in ('housingandinfrastructure.name', 'healthandenvironment.name',
           'educationandculture.name', 'incomeandemployment.name', 'interiorityandmotivation.name',
           'organizationandparticipation.name') is_core_dimension,
       created_date dimension_created_at, last_modified_date dimension_updated_at
from raw_survey_stoplight_dimension""")

cte("stg_survey_stoplight_color", """
select id survey_stoplight_color_id, survey_stoplight_id survey_indicator_id, value color_value,
       description color_description, created_at color_created_at, updated_at color_updated_at
from raw_survey_stoplight_color""")

cte("stg_translations", """
select id translation_id, lower(trim(key)) translation_key, lang language_code,
       translation translation_text
from raw_translation where lang = 'EN'""")

cte("stg_survey_economic", """
select id survey_economic_id, survey_definition_id, lower(trim(code_name)) code_name, question_text,
       case when answer_type = 'string' then 'text' else answer_type end answer_type,
       answer_options, scope, for_family_member is_for_family_member, topic,
       created_at survey_economic_created_at, updated_at survey_economic_updated_at
from raw_survey_economic""")

cte("stg_snapshot_economic", """
select id snapshot_economic_id, snapshot_id, lower(trim(code_name)) code_name,
       coalesce(case when answer_type = 'string' then 'text' else answer_type end, 'text') answer_type,
       value answer_value, multiple_value answer_multiple_value, other_text answer_other_text,
       created_date snapshot_economic_created_at, last_modified_date snapshot_economic_updated_at
from raw_snapshot_economic""")

# --------------------------------------------------------------------------
# dimensions
# --------------------------------------------------------------------------
cte("dim_date", """
select cast(strftime(d, '%Y%m%d') as integer) date_key, cast(d as date) date_actual,
       strftime(d, '%A') day_of_week, cast(isodow(d) as smallint) day_of_week_number,
       cast(day(d) as smallint) day_of_month, cast(dayofyear(d) as smallint) day_of_year,
       cast(week(d) as smallint) week_of_year, cast(month(d) as smallint) month_number,
       strftime(d, '%B') month_name, strftime(d, '%b') month_abbr,
       cast(quarter(d) as smallint) quarter_number, 'Q' || cast(quarter(d) as varchar) quarter_name,
       cast(year(d) as smallint) year_number,
       cast(year(d) as varchar) || '-Q' || cast(quarter(d) as varchar) year_quarter,
       strftime(d, '%Y-%m') year_month, isodow(d) in (6, 7) is_weekend
from (select cast(unnest(generate_series(date '2011-01-01', date '2035-12-31', interval 1 day)) as date) d) g""")

cte("dim_organization", """
select o.organization_id, a.application_id, a.application_name, a.application_description,
       a.application_is_active, ac.country_code application_country_code,
       ac.country_name application_country_name, a.application_created_at, a.application_updated_at,
       o.organization_name, o.organization_description, o.organization_is_active,
       oc.country_code organization_country_code, oc.country_name organization_country_name,
       o.language organization_language, o.organization_created_at, o.organization_updated_at
from stg_organizations o
join stg_applications a on o.application_id = a.application_id
left join stg_countries oc on o.country_code = oc.country_code
left join stg_countries ac on a.country_code = ac.country_code""")

cte("dim_family", """
select f.family_id, f.application_id, f.organization_id, f.project_id, f.is_anonymous,
       f.family_is_active, c.country_code, c.country_name, f.latitude, f.longitude,
       f.family_created_at, f.family_updated_at
from stg_families f left join stg_countries c on f.country_id = c.country_id""")

cte("dim_survey_definition", """
select s.survey_definition_id, s.survey_code, s.survey_title, s.survey_description, s.survey_language,
       s.survey_is_active, c.country_code survey_country_code, c.country_name survey_country_name,
       s.survey_created_at, s.survey_updated_at
from stg_survey_definitions s left join stg_countries c on s.country_code = c.country_code""")

cte("dim_economic_questions", """
select se.survey_economic_id, se.survey_definition_id, sd.survey_code, sd.survey_title,
       sd.survey_description, sd.survey_language, sd.survey_is_active, se.code_name, se.question_text,
       se.answer_type, se.answer_options, se.scope, se.topic, se.is_for_family_member,
       sd.survey_created_at, sd.survey_updated_at, se.survey_economic_created_at,
       se.survey_economic_updated_at
from stg_survey_economic se
left join stg_survey_definitions sd on se.survey_definition_id = sd.survey_definition_id""")

cte("color_criteria_pivot", """
select survey_indicator_id, max(color_description) filter (color_value = 1) red_criteria_description,
       max(color_description) filter (color_value = 2) yellow_criteria_description,
       max(color_description) filter (color_value = 3) green_criteria_description
from stg_survey_stoplight_color
group by survey_indicator_id having count(*) filter (color_value between 1 and 3) > 0""")

cte("word_of", """
select translation_key word, any_value(translation_text) said from stg_translations group by word""")

cte("indicator_templates_translated", """
select *, (select said from word_of where word = indicator_template_short_name) indicator_name,
       (select said from word_of where word = indicator_template_description) indicator_description
from stg_survey_stoplight_indicator""")

# one row of the survey's indicators, looked up in its template, dimension and colours
cte("dim_indicator_questions", """
select q.survey_indicator_id, q.survey_definition_id, dm.dimension_id,
       (select said from word_of where word = dm.dimension_met_name) dimension_name,
       dm.dimension_is_active, dm.is_core_dimension, q.indicator_template_id, t.indicator_name,
       t.indicator_description, q.indicator_code_name survey_indicator_code_name,
       q.indicator_short_name survey_indicator_short_name,
       q.indicator_question_text survey_indicator_question_text,
       q.indicator_description survey_indicator_description, q.indicator_definition,
       q.indicator_is_required survey_indicator_is_required, q.order_number,
       colours[1] red_criteria_description, colours[2] yellow_criteria_description,
       colours[3] green_criteria_description, dm.dimension_created_at, dm.dimension_updated_at,
       q.survey_indicator_created_at, q.survey_indicator_updated_at
from (select s.*, [(select max(c.color_description) from stg_survey_stoplight_color c
                    where c.survey_indicator_id = s.survey_indicator_id and c.color_value = 1),
                   (select max(c.color_description) from stg_survey_stoplight_color c
                    where c.survey_indicator_id = s.survey_indicator_id and c.color_value = 2),
                   (select max(c.color_description) from stg_survey_stoplight_color c
                    where c.survey_indicator_id = s.survey_indicator_id and c.color_value = 3)] colours
      from stg_survey_stoplight s) q
join indicator_templates_translated t using (indicator_template_id)
left join stg_survey_stoplight_dimension dm on dm.dimension_id = q.survey_dimension_id""")

# --------------------------------------------------------------------------
# facts
# --------------------------------------------------------------------------
# place: sortable position of a snapshot in time, unknown times after known ones
cte("snapshot_place", """
select snapshot_id, coalesce(family_id, -1) family, coalesce(survey_definition_id, -1) survey,
       {'a': snapshot_date is null, 'b': coalesce(snapshot_date, timestamp '1970-01-01'),
        'c': snapshot_created_at is null, 'd': coalesce(snapshot_created_at, timestamp '1970-01-01'),
        'e': snapshot_id} place
from stg_snapshots""")

cte("snapshot_round", """
select me.snapshot_id, me.family, me.survey, count(*) round
from snapshot_place me join snapshot_place it
  on it.family = me.family and it.survey = me.survey and it.place <= me.place
group by all""")

cte("family_latest", """
select arg_max(snapshot_id, place) snapshot_id from snapshot_place group by family""")

cte("round_span", """
select family, survey, max(round) rounds, min(snapshot_id) filter (round = 1) first_id from snapshot_round group by all""")

cte("fact_snapshots", """
select s.snapshot_id, s.family_id, s.organization_id, s.application_id, s.survey_definition_id, s.project_id,
       year(s.snapshot_date)::integer * 10000 + month(s.snapshot_date)::integer * 100 + day(s.snapshot_date)::integer date_key,
       s.snapshot_date, r.round snapshot_number, s.snapshot_id in (select snapshot_id from family_latest) is_last,
       r.round = 1 is_baseline, span.rounds max_snapshot_number,
       date_diff('day', first.snapshot_date::date, s.snapshot_date::date)::integer days_since_baseline,
       date_diff('day', prior.snapshot_date::date, s.snapshot_date::date)::integer days_since_previous,
       s.stoplight_skipped, s.is_anonymous, s.snapshot_created_at, s.snapshot_updated_at
from stg_snapshots s
join snapshot_round r using (snapshot_id)
join round_span span on span.family = r.family and span.survey = r.survey
left join stg_snapshots first on first.snapshot_id = span.first_id
left join snapshot_round before on before.family = r.family and before.survey = r.survey and before.round = r.round - 1
left join stg_snapshots prior on prior.snapshot_id = before.snapshot_id""")

cte("fi_resolved", """
select a.snapshot_stoplight_id, a.snapshot_id, a.indicator_status_value, q.survey_indicator_id
from stg_survey_stoplight q
join (select r.*, s.survey_definition_id from stg_snapshot_stoplight r join stg_snapshots s using (snapshot_id)) a
  on a.survey_definition_id = q.survey_definition_id and a.indicator_code_name = q.indicator_code_name""")

# the answers of known families, organizations and surveys, with a place in their line
cte("answer_line", """
select r.snapshot_stoplight_id, r.snapshot_id, r.survey_indicator_id, s.family_id, s.snapshot_number,
       nullif(r.indicator_status_value, 9) score,
       r.snapshot_stoplight_id in (select snapshot_stoplight_id from stg_snapshot_stoplight_priority) chosen,
       r.snapshot_stoplight_id in (select snapshot_stoplight_id from stg_snapshot_stoplight_achievement) reached
from fi_resolved r join fact_snapshots s using (snapshot_id)
where s.family_id in (select family_id from dim_family)
  and s.organization_id in (select organization_id from dim_organization)
  and s.survey_definition_id in (select survey_definition_id from dim_survey_definition)""")

cte("answer_step", """
select me.snapshot_stoplight_id, me.family_id, me.survey_indicator_id, count(*) step
from answer_line me join answer_line it
  on it.family_id = me.family_id and it.survey_indicator_id = me.survey_indicator_id
 and (it.snapshot_number < me.snapshot_number
      or it.snapshot_number = me.snapshot_number and it.snapshot_stoplight_id <= me.snapshot_stoplight_id)
group by all""")

cte("answer_start", """
select family_id, survey_indicator_id, max(score) score from answer_line where snapshot_number = 1 group by all""")

cte("fact_indicators", """
select a.snapshot_stoplight_id, s.snapshot_id, s.family_id, s.organization_id, a.survey_indicator_id,
       s.survey_definition_id, s.project_id, s.date_key, s.snapshot_number, s.is_last, s.is_baseline,
       s.max_snapshot_number, a.score current_score, start.score baseline_score, earlier.score previous_score,
       a.chosen is_priority, a.reached has_achievement, earlier.chosen was_priority_in_previous
from answer_line a
join answer_step here using (snapshot_stoplight_id)
join fact_snapshots s using (snapshot_id)
left join answer_start start on start.family_id = a.family_id and start.survey_indicator_id = a.survey_indicator_id
left join answer_step back on back.family_id = a.family_id and back.survey_indicator_id = a.survey_indicator_id
                          and back.step = here.step - 1
left join answer_line earlier on earlier.snapshot_stoplight_id = back.snapshot_stoplight_id""")

# --------------------------------------------------------------------------
# dashboard marts
# --------------------------------------------------------------------------
cte("flow_aggregate", """
select unnest(flow), count(*) family_count, sum(gain)::bigint net_change_numeric
from (select {'organization_id': organization_id, 'survey_indicator_id': survey_indicator_id,
              'survey_definition_id': survey_definition_id, 'project_id': project_id,
              'snapshot_number': snapshot_number, 'is_last': is_last, 'max_snapshot_number': max_snapshot_number,
              'baseline_score': baseline_score, 'previous_score': previous_score, 'current_score': current_score,
              'is_priority': is_priority, 'has_achievement': has_achievement,
              'was_priority_in_previous': was_priority_in_previous} flow,
             current_score - baseline_score gain
      from fact_indicators)
group by flow""")


def _label(col: str, other: str) -> str:
    return f"coalesce(['Skipped', 'Red', 'Yellow', 'Green'][{col} + 1], '{other}')"


cte("mart_indicators", f"""
select hub.application_id, hub.application_name hub_name, hub.organization_name,
       (select project_name from stg_projects p where p.project_id = flow.project_id) project_name,
       asked.indicator_name, asked.dimension_name, form.survey_title,
       coalesce(['Baseline', '1st Follow-up', '2nd Follow-up', '3rd Follow-up', '4th Follow-up'][flow.snapshot_number],
                concat(flow.snapshot_number - 1, 'th Follow-up')) snapshot_type,
       flow.snapshot_number, flow.is_last, flow.max_snapshot_number,
       {_label('flow.baseline_score', 'N/A')} baseline_label,
       {_label('flow.previous_score', 'N/A')} previous_label,
       {_label('flow.current_score', 'Unknown')} current_label,
       flow.is_priority, flow.has_achievement, flow.was_priority_in_previous, flow.net_change_numeric,
       flow.family_count
from (select * from dim_indicator_questions where is_core_dimension) asked
join flow_aggregate flow using (survey_indicator_id)
join dim_survey_definition form on form.survey_definition_id = flow.survey_definition_id
join dim_organization hub on hub.organization_id = flow.organization_id""")

cte("mart_surveys", """
select fs.snapshot_id, coalesce(f.country_name, 'Unknown') country_name, fs.is_last,
       fs.days_since_previous, fs.days_since_baseline, fs.snapshot_number, fs.is_baseline,
       fs.snapshot_date, o.application_id, o.application_name hub_name, o.organization_name,
       p.project_name, f.latitude, f.longitude, f.is_anonymous, d.survey_title, 1 survey_count
from fact_snapshots fs
join dim_organization o on fs.organization_id = o.organization_id
join dim_family f on fs.family_id = f.family_id
join dim_survey_definition d on fs.survey_definition_id = d.survey_definition_id
left join stg_projects p on fs.project_id = p.project_id""")


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str, known) -> list[str]:
    words = set(_WORD.findall(sql))
    return [n for n in known if n in words]


def oracle(final_sql: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` every CTE the final query needs, dependencies first."""
    pool = dict(CTES)
    pool.update(extra or {})
    order: list[str] = []

    def visit(name: str, stack=()):
        if name in order:
            return
        for dep in _deps(pool[name], pool):
            if dep != name and dep not in stack:
                visit(dep, stack + (name,))
        order.append(name)

    for name in _deps(final_sql, pool):
        visit(name)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} as ({pool[n]}\n)" for n in order)
    head = final_sql.lstrip()
    if head[:5].lower() == "with ":
        return f"with {body},\n{head[5:]}"
    return f"with {body}\n{final_sql}"
