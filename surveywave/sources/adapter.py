"""Derive the 18 raw survey tables from the driver's TPC-H-like Parquet.

Map: region = hub (application), nation = organisation and country,
customer = family, order priority = survey definition, order = snapshot,
part brand = indicator, line items of one (order, brand) = one response,
return flag = priority / achievement.  The two large ones that others are made
from, responses and snapshots with their family, are derived once and stored as
tables in the shared folder; what is built on them is lazy.

The mapping is the fixture specification of FIXTURES.md §2; the DuckDB oracle
states the same mapping in SQL independently.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveywave.operators.sequence import stored_table
from surveywave.session import checkpoint_dir
from surveywave.sources.schemas import AUDIT_COLUMNS, RAW_SCHEMAS

DRIVER_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")

# Fixed values of the fixture mapping (FIXTURES.md §2).
SEGMENT_PROJECT = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
DIMENSION_MET_NAMES = [
    "housingAndInfrastructure.name", "HealthAndEnvironment.name",
    " educationAndCulture.name ", "incomeAndEmployment.name",
    "interiorityAndMotivation.name", "organizationAndParticipation.name",
]
DIMENSION_OTHER_NAME = "aNewDimensionTest.name"
DIMENSION_TRANSLATION_KEYS = [
    "housingAndInfrastructure.name", "healthAndEnvironment.name", "educationAndCulture.name",
    "incomeAndEmployment.name", "interiorityAndMotivation.name",
    "organizationAndParticipation.name",
]
DIMENSION_TRANSLATIONS = [
    "Housing and Infrastructure", "Health and Environment", "Education and Culture",
    "Income and Employment", "Interiority and Motivation", "Organization and Participation",
]
GENDER_BY_MOD9 = ["M", "F", "MASCULINO", "FEMENINO", "LALAKI", "FI", "O", "ANON_DATA"]
ECON_QUESTIONS = [  # (code_name, answer_type) by question number 0..3
    (" householdMonthlyIncome", "number"), ("currency", "string"),
    ("housingSituation", "checkbox"), ("visitDate", "date"),
]
AUDIT_TS = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == F.lit(key), F.lit(value)) if expr is None else expr.when(col == F.lit(key), F.lit(value))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _brand_no(brand: Column) -> Column:
    return F.substring(brand, 7, 16).cast("int")


def _survey_no(priority: Column) -> Column:
    """The whole number in front of the order priority."""
    return F.regexp_extract(priority, r"^[0-9]+", 0).try_cast("long")


def _epoch(ts_ntz: Column) -> Column:
    """Seconds since the epoch of a zone-less timestamp read in UTC."""
    return F.unix_timestamp(ts_ntz.cast("timestamp"))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in order; absent ones become typed NULLs
    (audit columns get the fixed audit timestamp)."""
    present = set(df.columns)
    cols = []
    for field in RAW_SCHEMAS[table].fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name in AUDIT_COLUMNS:
            cols.append(F.expr(AUDIT_TS).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


class DriverAdapter:
    """Lazy raw tables over one driver directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    def table(self, name: str) -> DataFrame:
        key = f"raw:{name}"
        if key not in self._cache:
            self._cache[key] = conform(getattr(self, f"_{name}")(), name)
        return self._cache[key]

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        """df as a table in the shared folder: joined and grouped once, however many
        models and batches read it.  It goes when the driver's file systems close."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/raw-{name}-{uuid.uuid4().hex}"
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
        return stored_table(df, path)

    # -- small code tables -------------------------------------------------
    def _segment_project(self) -> Column:
        return _case(F.col("c_mktsegment"), SEGMENT_PROJECT)

    def _applications(self) -> DataFrame:
        r = self.driver("region")
        return r.select(
            F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
            F.concat(F.lit("hub "), "r_name").alias("description"),
            F.lit(True).alias("is_active"),
            F.concat(F.chr(F.col("r_regionkey") + 65), F.lit("X")).alias("country_code"))

    def _organizations(self) -> DataFrame:
        n = self.driver("nation")
        return n.select(
            F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("application_id"),
            F.col("n_name").alias("name"),
            F.concat(F.chr(F.col("n_nationkey") + 65), F.lit("X")).alias("country_code"),
            F.lit("en").alias("language"))

    def _countries(self) -> DataFrame:
        n = self.driver("nation")
        return n.select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("country"),
            F.concat(F.chr(F.col("n_nationkey") + 65), F.lit("X ")).alias("alfa_2_code"))

    def _projects(self) -> DataFrame:
        c = self.driver("customer")
        return (c.filter(F.col("c_mktsegment") != "MACHINERY")
                .select(_case(F.col("c_mktsegment"), SEGMENT_PROJECT, 4).alias("id"),
                        F.col("c_mktsegment").alias("title"))
                .distinct())

    def _family(self) -> DataFrame:
        c = self.driver("customer").join(
            self.driver("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        k = F.col("c_custkey")
        return c.select(
            k.alias("family_id"),
            F.when(k % 500 == 7, None).otherwise(F.col("c_nationkey")).alias("country"),
            F.col("n_regionkey").alias("application_id"),
            F.col("c_nationkey").alias("organization_id"),
            self._segment_project().alias("project_id"),
            F.lit(True).alias("is_active"), (k % 10 == 0).alias("anonymous"),
            F.when(k % 97 == 0, "n/a").when(k % 101 == 0, "")
             .otherwise((F.col("c_acctbal") / 50).cast("decimal(12,3)").cast("string"))
             .alias("latitude"),
            F.when(k % 89 == 0, None)
             .otherwise((F.col("c_acctbal") / 25).cast("decimal(12,3)").cast("string"))
             .alias("longitude"))

    def _family_members(self) -> DataFrame:
        c = self.driver("customer").join(
            self.driver("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        k = F.col("c_custkey")
        return c.select(
            k.alias("id"),
            F.when(k % 200 == 3, None).otherwise(k).alias("family_id"),
            _case(k % 9, dict(enumerate(GENDER_BY_MOD9))).alias("gender"),
            F.when(k % 7 == 0, "").when(k % 11 == 0, None).otherwise(F.col("n_name"))
             .alias("birth_country"))

    def _survey_ids(self) -> DataFrame:
        return (self.driver("orders")
                .select(_survey_no(F.col("o_orderpriority")).alias("sd")).distinct())

    def _brand_ids(self) -> DataFrame:
        return self.driver("part").select(_brand_no(F.col("p_brand")).alias("b")).distinct()

    def _survey_definition(self) -> DataFrame:
        o = self.driver("orders")
        sd = _survey_no(F.col("o_orderpriority"))
        return o.select(
            sd.alias("id"), F.col("o_orderpriority").alias("title"),
            F.concat(F.chr(sd.cast("int") + 64), F.lit("X")).alias("country_code")).distinct()

    def _survey_stoplight_dimension(self) -> DataFrame:
        n = self.driver("nation").filter(F.col("n_nationkey") < 7)
        return n.select(
            F.col("n_nationkey").alias("id"),
            _case(F.col("n_nationkey"), dict(enumerate(DIMENSION_MET_NAMES)),
                  DIMENSION_OTHER_NAME).alias("met_name"),
            F.lit("ACTIVE").alias("status"))

    def _survey_stoplight_indicator(self) -> DataFrame:
        p = self.driver("part")
        b = _brand_no(F.col("p_brand"))
        return (p.filter(b != 24).select(
            b.cast("long").alias("id"),
            F.concat(F.lit(" "), "p_brand", F.lit(".name")).alias("met_short_name"),
            F.concat("p_brand", F.lit(".description")).alias("met_description"),
            (b % 7).cast("long").alias("survey_dimension_id")).distinct())

    def _each(self, rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        """rows with every one of the few ids: the ids as one array, exploded."""
        held = ids.agg(F.collect_set(name).alias("_ids")).withColumn("_one", F.lit(1))
        return (rows.withColumn("_one", F.lit(1)).join(F.broadcast(held), "_one")
                .withColumn(name, F.explode("_ids")).drop("_ids", "_one"))

    def _survey_indicator_pairs(self) -> DataFrame:
        """Every template in every survey that exists, but for the left-out ones."""
        pairs = self._each(self._brand_ids(), self._survey_ids(), "sd").select("b", "sd")
        return pairs.filter((F.col("b") % 12) != F.col("sd"))

    def _survey_stoplight(self) -> DataFrame:
        b, sd = F.col("b"), F.col("sd")
        main = self._survey_indicator_pairs().select(
            (sd * 100 + b).alias("id"), sd.alias("survey_definition_id"),
            b.cast("long").alias("survey_indicator_id"),
            (b % 8).cast("long").alias("survey_dimension_id"),
            F.when(b % 2 == 0, F.concat(F.lit(" BRAND#"), b.cast("string"), F.lit(" ")))
             .otherwise(F.concat(F.lit("Brand#"), b.cast("string"))).alias("code_name"),
            b.alias("order_number"), F.expr("DATE '2020-01-01'").alias("updated_at"))
        extra = self.spark.range(1).select(
            F.lit(9000).cast("long").alias("id"), F.lit(3).cast("long").alias("survey_definition_id"),
            F.lit(5).cast("long").alias("survey_indicator_id"),
            F.lit(5).cast("long").alias("survey_dimension_id"), F.lit("brand#5").alias("code_name"),
            F.lit(99).alias("order_number"), F.expr("DATE '2019-01-01'").alias("updated_at"))
        return main.unionByName(extra)

    def _survey_stoplight_color(self) -> DataFrame:
        b, sd, k = F.col("b"), F.col("sd"), F.col("k")
        levels = self.driver("region").select(F.col("r_regionkey").cast("long").alias("k"))
        rows = (self._each(self._survey_indicator_pairs(), levels, "k").select("b", "sd", "k")
                .filter(~((b == 6) & (k == 2))))
        return rows.select(
            ((sd * 100 + b) * 10 + k).alias("id"), (sd * 100 + b).alias("survey_stoplight_id"),
            k.cast("int").alias("value"),
            F.concat(F.lit("level "), k.cast("string"), F.lit(" of "), b.cast("string"))
             .alias("description"))

    def _translation(self) -> DataFrame:
        p = self.driver("part")
        bno = F.substring("p_brand", 7, 16)
        b = bno.cast("long")
        names_en = p.select((b).alias("id"), F.concat(F.upper("p_brand"), F.lit(".NAME")).alias("key"),
                            F.lit("EN").alias("lang"),
                            F.concat(F.lit("Indicator "), bno).alias("translation")).distinct()
        names_es = p.select((b + 100).alias("id"), F.concat("p_brand", F.lit(".name")).alias("key"),
                            F.lit("ES").alias("lang"),
                            F.concat(F.lit("Indicador "), bno).alias("translation")).distinct()
        desc_en = (p.filter(bno.cast("int") % 3 != 0)
                   .select((b + 200).alias("id"), F.concat("p_brand", F.lit(".description")).alias("key"),
                           F.lit("EN").alias("lang"),
                           F.concat(F.lit("About "), "p_brand").alias("translation")).distinct())
        n = self.driver("nation").filter(F.col("n_nationkey") < 6)
        dims = n.select(
            (F.col("n_nationkey") + 300).cast("long").alias("id"),
            _case(F.col("n_nationkey"), dict(enumerate(DIMENSION_TRANSLATION_KEYS[:5])),
                  DIMENSION_TRANSLATION_KEYS[5]).alias("key"),
            F.lit("EN").alias("lang"),
            _case(F.col("n_nationkey"), dict(enumerate(DIMENSION_TRANSLATIONS[:5])),
                  DIMENSION_TRANSLATIONS[5]).alias("translation"))
        return reduce(DataFrame.unionByName, [names_en, names_es, desc_en, dims])

    def _placed_orders(self) -> DataFrame:
        """Orders with what a snapshot takes from their customer and its nation."""
        key = "raw:_placed_orders"
        if key not in self._cache:
            o = (self.driver("orders")
                 .join(self.driver("customer"), F.col("o_custkey") == F.col("c_custkey"))
                 .join(self.driver("nation"), F.col("c_nationkey") == F.col("n_nationkey")))
            self._cache[key] = self._stored("orders", o.select(
                "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate",
                "c_custkey", "c_nationkey", "c_mktsegment", "n_regionkey"))
        return self._cache[key]

    def _snapshot(self) -> DataFrame:
        o = self._placed_orders()
        epoch = _epoch(F.col("o_orderdate"))
        by_survey = Window.partitionBy("o_custkey", "o_orderpriority").orderBy("o_orderkey")
        by_family = Window.partitionBy("o_custkey").orderBy(F.col("o_orderkey").desc())
        return o.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("family_id"),
            F.col("c_nationkey").alias("organization_id"),
            F.col("n_regionkey").alias("application_id"),
            _survey_no(F.col("o_orderpriority")).alias("survey_definition_id"),
            self._segment_project().alias("project_id"),
            F.row_number().over(by_survey).cast("short").alias("snapshot_number"),
            (F.row_number().over(by_family) == 1).alias("is_last"),
            (F.col("o_orderstatus") == "P").alias("stoplight_skipped"),
            (F.col("c_custkey") % 10 == 0).alias("anonymous"),
            epoch.alias("snapshot_date"),
            (epoch + F.col("o_orderkey") % 3600).alias("created_at"))

    def _responses(self) -> DataFrame:
        """One response per (order, brand): score and the two flag sources."""
        key = "raw:_responses"
        if key not in self._cache:
            li = self.driver("lineitem").join(
                self.driver("part"), F.col("l_partkey") == F.col("p_partkey"))
            q = F.col("l_quantity")
            score = (F.when(q == 50, 4).when(q.cast("int") % 5 == 4, 9)
                     .otherwise(q.cast("int") % 5))
            self._cache[key] = self._stored("responses", (
                li.groupBy("l_orderkey", "p_brand").agg(
                    F.min(score).alias("value"),
                    F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("pr"),
                    F.max(F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), 1)
                          .otherwise(0)).alias("ach"))
                .select((F.col("l_orderkey") * 100 + _brand_no(F.col("p_brand"))).alias("id"),
                        F.col("l_orderkey").alias("snapshot_id"),
                        F.col("p_brand").alias("code_name"), "value", "pr", "ach")))
        return self._cache[key]

    def _snapshot_stoplight(self) -> DataFrame:
        return self._responses().select(
            "id", "snapshot_id", "code_name", "value", F.lit(False).alias("additional"),
            F.lit(1600000000999).cast("long").alias("updated_at"))

    def _snapshot_stoplight_priority(self) -> DataFrame:
        r = self._responses().filter(F.col("pr") == 1)
        i = F.col("id")
        first = r.select((i * 2).alias("id"), i.alias("snapshot_stoplight_id"),
                         F.lit("first").alias("reason"))
        dup = r.filter(i % 500 == 11).select((i * 2 + 1).alias("id"), i.alias("snapshot_stoplight_id"),
                                             F.lit("duplicate").alias("reason"))
        orphan = r.filter(i % 900 == 7).select((i * 2 + 1).alias("id"), (-i).alias("snapshot_stoplight_id"),
                                               F.lit("orphan").alias("reason"))
        return first.unionByName(dup).unionByName(orphan)

    def _snapshot_stoplight_achievement(self) -> DataFrame:
        r = self._responses().filter(F.col("ach") == 1)
        return r.select("id", F.col("id").alias("snapshot_stoplight_id"), F.lit("action").alias("action"))

    def _survey_economic(self) -> DataFrame:
        q, sd = F.col("q"), F.col("sd")
        questions = self.driver("region").filter(F.col("r_regionkey") < 4).select(
            F.col("r_regionkey").cast("long").alias("q"))
        rows = self._each(self._survey_ids(), questions, "q").select("sd", "q").filter(sd * 10 + q != 52)
        return rows.select(
            (sd * 10 + q).alias("id"), sd.alias("survey_definition_id"),
            _case(q, {i: c for i, (c, _) in enumerate(ECON_QUESTIONS)}).alias("code_name"),
            _case(q, {i: t for i, (_, t) in enumerate(ECON_QUESTIONS)}).alias("answer_type"))

    def _snapshot_economic(self) -> DataFrame:
        o = self.driver("orders")
        k = F.col("o_orderkey")
        income = o.filter(k % 3 != 2).select(
            (k * 10).alias("id"), k.alias("snapshot_id"), F.lit("householdMonthlyIncome").alias("code_name"),
            F.when(k % 50 == 0, None).otherwise(F.lit("string")).alias("answer_type"),
            F.when(k % 40 == 0, "unknown")
             .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("value"))
        currency = o.filter(k % 4 != 1).select(
            (k * 10 + 1).alias("id"), k.alias("snapshot_id"), F.lit("currency").alias("code_name"),
            F.lit("string").alias("answer_type"),
            _case(k % 3, {0: "USD", 1: "EUR"}, "BRL").alias("value"))
        housing = o.filter(k % 5 == 0).select(
            (k * 10 + 2).alias("id"), k.alias("snapshot_id"), F.lit("housingSituation").alias("code_name"),
            F.lit("checkbox").alias("answer_type"),
            F.concat("o_orderstatus", F.lit("|"), "o_orderpriority").alias("value"),
            F.when(k % 10 == 0, F.concat(F.lit("other "), "o_orderstatus")).alias("other_text"))
        visit = o.filter(k % 7 == 0).select(
            (k * 10 + 3).alias("id"), k.alias("snapshot_id"), F.lit("visitDate").alias("code_name"),
            F.lit("date").alias("answer_type"),
            (_epoch(F.col("o_orderdate")) * 1000).cast("string").alias("value"))
        return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [housing, income, currency, visit])
