"""Dropdown values kept as a dictionary with reference counts.

The values of a filter column are the distinct values of a table, which a scan
gives at the price of the table.  Here each (field, value) is stored with the
number of rows that have it.  Inserted rows count it up, deleted ones down, and
at 0 it goes.  A batch is summed by value and replaces the buckets its values
lie in; NULL is a value like others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveywave.plans.store import TableStore, Version, bucket_of

KEYS = ["field", "value"]


def value_counts(rows: DataFrame, fields: Sequence[str], sign: int = 1) -> DataFrame:
    """(field, value, n) of the rows: one scan, counted before the shuffle."""
    pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("p"))
    return pairs.select("p.*").groupBy(*KEYS).agg((sign * F.count(F.lit(1))).alias("n"))


class ValueDictionary:
    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str], buckets: int = 8):
        self.fields, self.buckets = list(fields), buckets
        self.store = TableStore(spark, path)

    def apply(self, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> Version | None:
        """Count rows in and out."""
        parts = [value_counts(df, self.fields, s) for df, s in ((inserted, 1), (deleted, -1)) if df is not None]
        if not parts:
            return self.store.version()
        fresh = self._summed(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).checkpoint(eager=True)
        now = self.store.version()
        if now is None:
            return self.store.replace(fresh, 0, keys=KEYS, buckets=self.buckets)
        # at most one number for each bucket
        touched = sorted(r[0] for r in fresh.select(bucket_of(KEYS, self.buckets)).distinct().collect())
        if not touched:
            return now
        return self.store.replace_buckets(self._summed(self.store.read(now.number, touched).unionByName(fresh)), touched, now.number)

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*KEYS).agg(F.sum("n").cast("long").alias("n")).where("n <> 0")

    def values(self, field: str | None = None) -> DataFrame:
        """(field, value) of all fields, or of one."""
        rows = self.store.read().select(*KEYS)
        return rows if field is None else rows.where(F.col("field") == field)
