"""Metric layer over the two dashboard tables.

A metric is a named aggregate Column; a dataset lists its metrics, its
calculated columns and which columns may be grouped or filtered.
``metric_query`` validates a request against those flags and compiles it to
one ``filter → groupBy → agg`` (partial + final hash aggregate, one shuffle).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveywave.functions.columns import cond_sum, label_ordered, ratio, survey_type

def N() -> Column:
    return F.col("family_count")


def _n_sum() -> Column:
    return F.sum(N()).cast("long")


def _count_if(label_col: str, label: str) -> Column:
    return cond_sum(F.col(label_col) == label)


def _pct_if(label_col: str, label: str) -> Column:
    return ratio(cond_sum(F.col(label_col) == label), F.sum(N()))


def _indicator_metrics() -> dict[str, Column]:
    m: dict[str, Column] = {"count": _n_sum()}
    for lab in ["Green", "Yellow", "Red", "Skipped"]:
        m[f"count_{lab.lower()}"] = _count_if("current_label", lab)
    for lab in ["Green", "Yellow", "Red", "Skipped"]:
        m[f"pct_{lab.lower()}"] = _pct_if("current_label", lab)
    for stage in ["baseline", "previous"]:
        for lab in ["Green", "Yellow", "Red"]:
            m[f"count_{lab.lower()}_{stage}"] = _count_if(f"{stage}_label", lab)
        for lab in ["Green", "Yellow", "Red"]:
            m[f"pct_{lab.lower()}_{stage}"] = _pct_if(f"{stage}_label", lab)
    m["count_priorities"] = cond_sum(F.col("is_priority"))
    m["count_achieved"] = cond_sum(F.col("has_achievement"))
    m["priority_success_rate"] = ratio(
        cond_sum(F.col("is_priority") & (F.col("current_label") == "Green")),
        cond_sum(F.col("is_priority")))
    # numerator ignores was_priority_in_previous (as defined); may exceed 1
    m["achievement_rate"] = ratio(cond_sum(F.col("has_achievement")),
                                  cond_sum(F.col("was_priority_in_previous")))
    m["avg_improvement_steps"] = ratio(F.sum("net_change_numeric"), F.sum(N()))
    return m


def _survey_metrics() -> dict[str, Column]:
    return {
        "count": F.count(F.lit(1)),
        "count_families_active": F.sum(F.when(F.col("is_last"), 1).otherwise(0)).cast("long"),
        "count_baselines": F.sum(F.when(F.col("snapshot_number") == 1, 1).otherwise(0)).cast("long"),
        "count_followups": F.sum(F.when(F.col("snapshot_number") > 1, 1).otherwise(0)).cast("long"),
        "avg_days_since_previous": F.avg("days_since_previous"),
        "avg_days_since_baseline": F.avg("days_since_baseline"),
    }


@dataclass
class Dataset:
    """Metrics and calculated columns are built on use (Columns need a
    running session)."""
    name: str
    metric_builder: Callable[[], dict[str, Column]]
    calculated_builder: Callable[[], dict[str, Column]] = dict
    metric_names: tuple[str, ...] = ()
    calculated_names: tuple[str, ...] = ()
    not_groupable: frozenset[str] = frozenset()
    not_filterable: frozenset[str] = frozenset()
    time_column: str | None = None

    @property
    def metrics(self) -> dict[str, Column]:
        return self.metric_builder()

    @property
    def calculated(self) -> dict[str, Column]:
        return self.calculated_builder()


INDICATOR_METRICS = (
    ["count"] + [f"count_{c}" for c in ["green", "yellow", "red", "skipped"]]
    + [f"pct_{c}" for c in ["green", "yellow", "red", "skipped"]]
    + [f"{k}_{c}_{st}" for st in ["baseline", "previous"] for k in ["count", "pct"]
       for c in ["green", "yellow", "red"]]
    + ["count_priorities", "count_achieved", "priority_success_rate", "achievement_rate",
       "avg_improvement_steps"])
SURVEY_METRICS = ["count", "count_families_active", "count_baselines", "count_followups",
                  "avg_days_since_previous", "avg_days_since_baseline"]

INDICATORS = Dataset(
    "Indicators", _indicator_metrics,
    lambda: {
        "current_label_ordered": label_ordered("current_label"),
        "baseline_label_ordered": label_ordered("baseline_label"),
        "previous_label_ordered": label_ordered("previous_label"),
    },
    metric_names=tuple(INDICATOR_METRICS),
    calculated_names=("current_label_ordered", "baseline_label_ordered", "previous_label_ordered"),
    not_groupable=frozenset({"family_count"}), not_filterable=frozenset({"family_count"}))

SURVEYS = Dataset(
    "Surveys", _survey_metrics, lambda: {"survey_type": survey_type("snapshot_number")},
    metric_names=tuple(SURVEY_METRICS), calculated_names=("survey_type",),
    not_groupable=frozenset({"days_since_previous", "days_since_baseline"}),
    time_column="snapshot_date")

DATASETS = {"Indicators": INDICATORS, "Surveys": SURVEYS}

_OPS = {
    "==": lambda c, v: c == v, "!=": lambda c, v: c != v, ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)), "not in": lambda c, v: ~c.isin(list(v)),
    "is null": lambda c, v: c.isNull(), "is not null": lambda c, v: c.isNotNull(),
}


class MetricError(ValueError):
    pass


def with_calculated(df: DataFrame, ds: Dataset, names: Sequence[str]) -> DataFrame:
    calc = ds.calculated
    extra = [calc[n].alias(n) for n in dict.fromkeys(names) if n in calc and n not in df.columns]
    return df.select("*", *extra) if extra else df


def metric_query(df: DataFrame, dataset: str | Dataset, metrics: Sequence[str],
                 group_by: Sequence[str] = (), filters: Sequence[tuple] = (),
                 order_by: Sequence[tuple[str, str]] = (), limit: int | None = None) -> DataFrame:
    """Compile a chart request: filters (column, op, value) → group → metrics.

    order_by items are (name, 'asc'|'desc'); a limit is applied only when asked
    (top-k charts)."""
    ds = DATASETS[dataset] if isinstance(dataset, str) else dataset
    known = set(df.columns) | set(ds.calculated_names)
    for m in metrics:
        if m not in ds.metric_names:
            raise MetricError(f"unknown metric {m!r} for {ds.name}")
    for g in group_by:
        if g not in known:
            raise MetricError(f"unknown column {g!r}")
        if g in ds.not_groupable:
            raise MetricError(f"column {g!r} is not groupable")
    for f in filters:
        if f[0] not in known:
            raise MetricError(f"unknown column {f[0]!r}")
        if f[0] in ds.not_filterable:
            raise MetricError(f"column {f[0]!r} is not filterable")
        if f[1] not in _OPS:
            raise MetricError(f"unknown operator {f[1]!r}")
    df = with_calculated(df, ds, [*group_by, *[f[0] for f in filters]])
    for col, op, *val in filters:
        df = df.filter(_OPS[op](F.col(col), val[0] if val else None))
    defs = ds.metrics
    aggs = [defs[m].alias(m) for m in metrics]
    out = df.groupBy(*group_by).agg(*aggs) if group_by else df.agg(*aggs)
    if order_by:
        cols = []
        for name, direction in order_by:
            c = F.col(name)
            cols.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
        out = out.orderBy(*cols)
    return out.limit(limit) if limit is not None else out


def scope_table(applications: DataFrame) -> DataFrame:
    """Row-level security as data: each hub's user sees its own hub; the
    'all-hubs' user sees every hub.  (user_name, application_id)."""
    own = applications.select(F.concat(F.lit("hub:"), F.col("application_name")).alias("user_name"),
                              "application_id")
    admin = applications.select(F.lit("all-hubs").alias("user_name"), "application_id")
    return own.unionByName(admin)


def scoped(df: DataFrame, scope: DataFrame, user: str | None = None) -> DataFrame:
    """Rows a user may see: a join on application_id with the (small) scope."""
    s = scope if user is None else scope.filter(F.col("user_name") == user)
    return df.join(s, "application_id", "inner")


# What the metrics of the Indicators table are computed from.
_INDICATOR_PARTS = ["baseline_label", "previous_label", "current_label", "is_priority", "has_achievement", "was_priority_in_previous"]


def scoped_metrics(mart_indicators: DataFrame, scope: DataFrame, metrics: Sequence[str],
                   group_by: Sequence[str] = ("user_name",)) -> DataFrame:
    """Indicator metrics for every user over what that user may see.

    The table is summed up to one row for each hub and combination of labels and
    flags (and other group columns) before it meets the users: what is repeated
    for each user is a few hundred rows a hub, not the table."""
    own = [g for g in group_by if g not in scope.columns]
    keys = dict.fromkeys(["application_id", *_INDICATOR_PARTS, *own])
    small = mart_indicators.groupBy(*keys).agg(
        F.sum("family_count").cast("long").alias("family_count"), F.sum("net_change_numeric").alias("net_change_numeric"))
    return metric_query(scoped(small, scope), "Indicators", metrics, group_by)


def metric_columns(metric: str) -> set[str]:
    """The columns of the Indicators table, besides the sums, that a metric looks at."""
    if metric == "priority_success_rate":
        return {"is_priority", "current_label"}
    if metric == "achievement_rate":
        return {"has_achievement", "was_priority_in_previous"}
    if metric in ("count", "avg_improvement_steps"):
        return set()
    flags = {"count_priorities": "is_priority", "count_achieved": "has_achievement"}
    if metric in flags:
        return {flags[metric]}
    stage = metric.rsplit("_", 1)[-1]
    return {f"{stage}_label" if stage in ("baseline", "previous") else "current_label"}


_CALCULATED_FROM = {f"{stage}_label_ordered": f"{stage}_label" for stage in ("current", "baseline", "previous")}


def request_columns(metrics: Sequence[str], group_by: Sequence[str] = (), filters: Sequence[tuple] = ()) -> set[str]:
    """All columns that an Indicators request needs of a rollup."""
    named = {_CALCULATED_FROM.get(c, c) for c in [*group_by, *[f[0] for f in filters]]}
    return named.union(*[metric_columns(m) for m in metrics])


def indicator_rollups(mart_indicators: DataFrame):
    """Rollups of the dashboard table; its measures are sums already."""
    from surveywave.plans.rollups import Rollups
    return Rollups(mart_indicators, {c: (lambda c=c: F.col(c)) for c in ("family_count", "net_change_numeric")})


def rollup_query(rollups, metrics: Sequence[str], group_by: Sequence[str] = (), filters: Sequence[tuple] = (),
                 order_by: Sequence[tuple[str, str]] = (), limit: int | None = None) -> DataFrame:
    """``metric_query`` on the smallest rollup that covers the request."""
    rows = rollups.table(request_columns(metrics, group_by, filters))
    return metric_query(rows, "Indicators", metrics, group_by, filters, order_by, limit)
