"""DuckDB text of the metric layer (oracle side, written independently)."""

from __future__ import annotations


def _cnt(cond: str) -> str:
    return f"cast(sum(case when {cond} then family_count else 0 end) as bigint)"


def _pct(cond: str, den: str = "sum(family_count)") -> str:
    return (f"cast(sum(case when {cond} then family_count else 0 end) as double)"
            f" / nullif(cast({den} as double), 0)")


INDICATOR_SQL: dict[str, str] = {"count": "cast(sum(family_count) as bigint)"}
for _lab in ["Green", "Yellow", "Red", "Skipped"]:
    INDICATOR_SQL[f"count_{_lab.lower()}"] = _cnt(f"current_label = '{_lab}'")
for _lab in ["Green", "Yellow", "Red", "Skipped"]:
    INDICATOR_SQL[f"pct_{_lab.lower()}"] = _pct(f"current_label = '{_lab}'")
for _stage in ["baseline", "previous"]:
    for _lab in ["Green", "Yellow", "Red"]:
        INDICATOR_SQL[f"count_{_lab.lower()}_{_stage}"] = _cnt(f"{_stage}_label = '{_lab}'")
    for _lab in ["Green", "Yellow", "Red"]:
        INDICATOR_SQL[f"pct_{_lab.lower()}_{_stage}"] = _pct(f"{_stage}_label = '{_lab}'")
INDICATOR_SQL["count_priorities"] = _cnt("is_priority")
INDICATOR_SQL["count_achieved"] = _cnt("has_achievement")
INDICATOR_SQL["priority_success_rate"] = _pct(
    "is_priority and current_label = 'Green'",
    "sum(case when is_priority then family_count else 0 end)")
INDICATOR_SQL["achievement_rate"] = _pct(
    "has_achievement", "sum(case when was_priority_in_previous then family_count else 0 end)")
INDICATOR_SQL["avg_improvement_steps"] = (
    "cast(sum(net_change_numeric) as double) / nullif(cast(sum(family_count) as double), 0)")

SURVEY_SQL: dict[str, str] = {
    "count": "count(*)",
    "count_families_active": "cast(sum(case when is_last then 1 else 0 end) as bigint)",
    "count_baselines": "cast(sum(case when snapshot_number = 1 then 1 else 0 end) as bigint)",
    "count_followups": "cast(sum(case when snapshot_number > 1 then 1 else 0 end) as bigint)",
    "avg_days_since_previous": "avg(days_since_previous)",
    "avg_days_since_baseline": "avg(days_since_baseline)",
}


def ordered_label_sql(col: str) -> str:
    return (f"case when {col} = 'Green' then '1 - Green' when {col} = 'Yellow' then '2 - Yellow' "
            f"when {col} = 'Red' then '3 - Red' when {col} = 'Skipped' then '4 - Skipped' "
            f"else '5 - Unknown' end")
