"""Model registry: each model is built once per Warehouse as a lazy DataFrame.

``Warehouse(spark, source)`` wires staging → dimensions → facts → marts as the
model graph does; ``materialize`` writes the mart layer (SNK-02/03/04)
so dashboards and metric queries read stored Parquet instead of rebuilding.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from surveywave.session import checkpoint_dir
from surveywave.operators.sequence import stored_table
from surveywave.plans import dims, facts, marts
from surveywave.plans.staging import STAGING
from surveywave.plans.store import TableStore


# Mart output names (aliases of the dashboard tables).
MODEL_ALIASES = {"mart_indicators": "Indicators", "mart_surveys": "Surveys"}
MODEL_SCHEMAS = {  # custom schema per layer
    "staging": "staging", "core": "marts", "dashboards": "superset",
}
CORE_MODELS = ["dim_date", "dim_organization", "dim_family", "dim_survey_definition",
               "dim_economic_questions", "dim_indicator_questions", "fact_snapshots",
               "fact_indicators"]
DASHBOARD_MODELS = ["mart_indicators", "mart_surveys"]
# Layout of the stored tables: partition columns (few values, filtered on) and
# the columns that files are sorted by, so Parquet min/max statistics skip row
# groups.  They are the index columns of the source system's tables.
PARTITION_COLUMNS = {"mart_indicators": ["is_last"], "mart_surveys": ["is_last"], "mart_indicators_wide": ["dimension_name"]}
CLUSTER_COLUMNS = {
    "mart_indicators": ["application_id", "dimension_name", "indicator_name", "current_label", "baseline_label", "hub_name",
                        "organization_name", "project_name", "snapshot_number"],
    "mart_surveys": ["application_id", "country_name", "organization_name", "snapshot_date"],
    "mart_indicators_wide": ["has_followup_data", "application_id", "indicator_name", "baseline_label", "latest_followup_label"],
    "fact_snapshots": ["organization_id", "survey_definition_id", "snapshot_date"],
    "fact_indicators": ["survey_indicator_id", "organization_id", "snapshot_number"],
}


def output_schema(custom: str | None, default: str = "analytics", target: str = "dev") -> str:
    """Schema naming rule: custom schema bare in prod or for the dashboard
    schema, else ``<default>_<custom>``; no custom → default."""
    if not custom:
        return default
    custom = custom.strip()
    if target == "prod" or custom == "superset":
        return custom
    return f"{default}_{custom}"


def output_name(model: str) -> str:
    return MODEL_ALIASES.get(model, model)


class Warehouse:
    def __init__(self, spark: SparkSession, source, *, epoch_unit: str = "s",
                 pg_padding: bool = False, stage_facts: bool = True):
        self.spark = spark
        self.source = source
        self.epoch_unit = epoch_unit
        self.pg_padding = pg_padding
        self.stage_facts = stage_facts
        self._materializing = False
        self._ranged: list[str] = []  # ranged rows of facts that materialize is about to store
        self.replayed = None  # streaming.maintain keeps its replay of this source here
        self.wide_rollups = None  # and questions the rollups of the wide mart
        self._few: bool | None = None  # whether every family has few snapshots, once it is known
        checkpoint_dir(spark)
        self._pinned: set[str] = set()
        self._models: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "dim_date": lambda: dims.dim_date(self.spark, pg_padding=self.pg_padding),
            "dim_organization": lambda: self._dim(lambda: dims.dim_organization(
                self.m("stg_organizations"), self.m("stg_applications"), self.m("stg_countries"))),
            "dim_family": lambda: dims.dim_family(self.m("stg_families"), self.m("stg_countries")),
            "dim_survey_definition": lambda: self._dim(lambda: dims.dim_survey_definition(
                self.m("stg_survey_definitions"), self.m("stg_countries"))),
            "dim_economic_questions": lambda: dims.dim_economic_questions(
                self.m("stg_survey_economic"), self.m("stg_survey_definitions")),
            "color_criteria_pivot": lambda: dims.color_criteria_pivot(self.m("stg_survey_stoplight_color")),
            "indicator_templates_translated": lambda: dims.indicator_templates_translated(
                self.m("stg_survey_stoplight_indicator"), self.m("stg_translations")),
            "dim_indicator_questions": lambda: self._dim(lambda: dims.dim_indicator_questions(
                self.m("stg_survey_stoplight"), self.m("stg_survey_stoplight_indicator"),
                self.m("stg_survey_stoplight_color"), self.m("stg_survey_stoplight_dimension"),
                self.m("stg_translations"))),
            "fact_snapshots": lambda: self._fact(lambda store: facts.fact_snapshots(
                self.m("stg_snapshots"), store, self._few_snapshots())),
            "fact_indicators": lambda: self._fact(lambda store: facts.fact_indicators(
                self.m("fact_snapshots"), self.m("stg_snapshot_stoplight"), self.m("stg_survey_stoplight"),
                self.m("dim_family"), self.m("dim_organization"), self.m("dim_survey_definition"),
                self.m("stg_snapshot_stoplight_priority"), self.m("stg_snapshot_stoplight_achievement"), store,
                self._few_snapshots())),
            "mart_indicators": lambda: marts.mart_indicators(
                self.m("fact_indicators"), self.m("dim_organization"), self.m("dim_indicator_questions"),
                self.m("dim_survey_definition"), self.m("stg_projects")),
            "mart_surveys": lambda: marts.mart_surveys(
                self.m("fact_snapshots"), self.m("dim_family"), self.m("dim_organization"),
                self.m("dim_survey_definition"), self.m("stg_projects")),
        }

    # -- registry ---------------------------------------------------------
    def register(self, name: str, builder: Callable[[], DataFrame]) -> None:
        self._builders[name] = builder

    def has(self, name: str) -> bool:
        return name in self._builders or name in self._models

    def use(self, name: str, df: DataFrame) -> None:
        """Pin a model to a given DataFrame; ``materialize`` keeps the pin."""
        self._models[name] = df
        self._pinned.add(name)
        self.wide_rollups = self._few = None

    def raw(self, name: str) -> DataFrame:
        return self.source.table(name)

    def m(self, name: str) -> DataFrame:
        if name not in self._models:
            if name in STAGING:
                table, fn = STAGING[name]
                raw = self.raw(table)
                self._models[name] = fn(raw, self.epoch_unit) if name == "stg_snapshots" else fn(raw)
            elif name in self._builders:
                self._models[name] = self._builders[name]()
            else:
                raise KeyError(f"unknown model {name!r}")
        return self._models[name]

    model = m

    def stage(self, df: DataFrame) -> DataFrame:
        """Cut lineage at a fact boundary: a table in the shared
        ``spark.checkpoint.dir``, which survives executor loss as a reliable
        checkpoint does, but is computed once and read by column.  The source
        system materialises facts as tables too."""
        return stored_table(df, f"{checkpoint_dir(self.spark).rstrip('/')}/stored-{uuid.uuid4().hex}") if self.stage_facts else df

    def _dim(self, build: Callable[[], DataFrame]) -> DataFrame:
        """A dimension that facts look up, stored like a fact: the planner then
        knows its size, and a small one is broadcast before the fact is shuffled
        for it (the estimate of a plan of joins is their product)."""
        df = build()
        return df if self._materializing else self.stage(df)

    def _fact(self, build: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
        """A fact, stored, unless ``materialize`` is about to write it (the
        stored table cuts the lineage instead).  The ranged rows that its windows
        are made from are tables of their own, removed as soon as the fact is
        stored; without staging they stay, as the fact still reads them."""
        held: list[str] = []

        def store(df: DataFrame) -> DataFrame:
            held.append(f"{checkpoint_dir(self.spark).rstrip('/')}/sequence-{uuid.uuid4().hex}")
            return stored_table(df, held[-1])

        df = build(store)
        if self._materializing:
            self._ranged += held
            return df
        if self.stage_facts:
            df = self.stage(df)
            self._remove(held)
        return df

    def _few_snapshots(self) -> bool:
        """Facts whose groups are small need no ranged rows, if they are stored
        once: what reads an unstaged fact again would compute its joins again."""
        if self._few is None:
            self._few = (self.stage_facts or self._materializing) and facts.few_snapshots(self.m("stg_snapshots"))
        return self._few

    def _remove(self, paths: list[str]) -> None:
        for p in paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    # -- sinks ------------------------------------------------------------
    def materialize(self, out_root: str, models=None, target: str = "dev",
                    default_schema: str = "analytics") -> dict[str, str]:
        """Drop and recreate the marts as Parquet under ``out_root``.

        Every call rebuilds from the raw tables (or from models pinned with
        ``use``), never from what an earlier call stored.  A table is written
        beside the old one and takes its place when it is whole.  Later models
        and queries of this Warehouse read the stored tables."""
        self._models = {k: v for k, v in self._models.items() if k in self._pinned}
        self.wide_rollups = self._few = None
        written: dict[str, str] = {}
        stored: set[str] = set()
        self._materializing = True
        try:
            for name in models or CORE_MODELS + DASHBOARD_MODELS:
                layer = "dashboards" if name in DASHBOARD_MODELS else "core"
                out_schema = output_schema(MODEL_SCHEMAS[layer], default_schema, target)
                written[name] = f"{out_root.rstrip('/')}/{out_schema}/{output_name(name)}"
                self._models[name] = self._store(name, written[name])
                stored.add(name)
        finally:
            self._materializing = False
            # what was built on the way and not stored is built anew when it is asked for
            self._models = {k: v for k, v in self._models.items() if k in self._pinned or k in stored}
            self._remove(self._ranged)
            self._ranged = []
        return written

    def create_views(self, prefix: str = "", models=None) -> list[str]:
        """Temporary views over models (the staging layer if none are named), for
        SQL users: ``<prefix><model>``.  A view reads what the model reads, so
        nothing is computed here; models stored since are views of their tables."""
        names = list(STAGING) if models is None else list(models)
        for name in names:
            self.m(name).createOrReplaceTempView(f"{prefix}{name}")
        return [f"{prefix}{name}" for name in names]

    def publish(self, root: str, models=None, target: str = "dev", default_schema: str = "analytics") -> dict[str, TableStore]:
        """Publish models as versions (``plans.store``): readers see whole tables
        at any time, and one of two writers wins.  Paths are those of
        ``materialize``; a table is replaced by a new version, never in place."""
        done: dict[str, TableStore] = {}
        for name in models or CORE_MODELS + DASHBOARD_MODELS:
            layer = "dashboards" if name in DASHBOARD_MODELS else "core"
            path = f"{root.rstrip('/')}/{output_schema(MODEL_SCHEMAS[layer], default_schema, target)}/{output_name(name)}"
            done[name] = TableStore(self.spark, path)
            start = (done[name].versions() or [0])[-1]  # before the model is computed
            done[name].replace(self.m(name), start, by=PARTITION_COLUMNS.get(name, []), sort=CLUSTER_COLUMNS.get(name, []))
        return done

    def _store(self, name: str, path: str) -> DataFrame:
        df = self.m(name)
        by, cluster = PARTITION_COLUMNS.get(name, []), CLUSTER_COLUMNS.get(name)
        columns, schema = df.columns, df.schema
        fresh = f"{path}__{uuid.uuid4().hex}"
        if by:
            # rows of a partition value meet, so it has few files; a value that is
            # too large for a task is split again (AQE)
            df = df.hint("rebalance", *by)
        if cluster:
            df = df.sortWithinPartitions(*by, *cluster)
        writer = df.write.partitionBy(*by) if by else df.write
        writer.parquet(fresh)
        replace_folder(self.spark, fresh, path)
        # read with the declared schema (partition values are typed too)
        return self.spark.read.schema(schema).parquet(path).select(*columns)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the folder ``fresh`` in the place of ``path``; the old one goes last."""
    jvm = spark._jvm.org.apache.hadoop.fs
    old = jvm.Path(f"{path}__old_{uuid.uuid4().hex}")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    there = fs.exists(jvm.Path(path))
    if there and not fs.rename(jvm.Path(path), old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(jvm.Path(fresh), jvm.Path(path)):
        raise OSError(f"cannot move {fresh} to {path}")
    if there:
        fs.delete(old, True)


# Sessions as weak keys: a new session never meets frames of one that is gone.
_WAREHOUSES: WeakKeyDictionary[SparkSession, dict[tuple, Warehouse]] = WeakKeyDictionary()


def warehouse_for(spark: SparkSession, root: str, **kwargs) -> Warehouse:
    """One Warehouse per (session, input directory): models derived once are
    reused by every query of that session."""
    from surveywave.sources import open_source

    known = _WAREHOUSES.setdefault(spark, {})
    key = (root.rstrip("/"), tuple(sorted(kwargs.items())))
    if key not in known or known[key].spark.sparkContext._jsc is None:
        known[key] = Warehouse(spark, open_source(spark, root), **kwargs)
    return known[key]
