"""Raw-table readers (SRC-01 … SRC-18) and the generated date spine (SRC-19).

Two interchangeable sources expose ``table(name) -> DataFrame``:

* ``ParquetRawSource`` — an export of the operational database, one Parquet
  dataset per raw table (``<root>/<name>``), read with the declared schema so
  nothing is inferred and filters / column pruning reach the scan.
* ``DriverAdapter`` — the same tables derived from the driver's TPC-H-like
  files (see ``adapter.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveywave.sources.adapter import DriverAdapter
from surveywave.sources.schemas import RAW_SCHEMAS


# Text columns that raw documents also hold as arrays of text.
ARRAY_OR_TEXT = [("snapshot_economic", "multiple_value")]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system, so object stores and HDFS work."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


class ParquetRawSource:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            path = f"{self.root}/{name}"
            if not path_exists(self.spark, path) and path_exists(self.spark, path + ".parquet"):
                path += ".parquet"
            self._cache[name] = self._read(name, path)
        return self._cache[name]

    def _read(self, name: str, path: str) -> DataFrame:
        """With the declared schema.  A text column that the export has as an
        array (checkbox answers) is read as such and given as JSON text."""
        schema = RAW_SCHEMAS[name]
        maybe = [c for t, c in ARRAY_OR_TEXT if t == name]
        if not maybe:
            return self.spark.read.schema(schema).parquet(path)
        found = self.spark.read.parquet(path).schema  # a footer
        arrays = [c for c in maybe if c in found.names and isinstance(found[c].dataType, T.ArrayType)]
        fields = [T.StructField(f.name, found[f.name].dataType) if f.name in arrays else f for f in schema.fields]
        df = self.spark.read.schema(T.StructType(fields)).parquet(path)
        return df.withColumns({c: F.to_json(c) for c in arrays}) if arrays else df


class FrameSource:
    """In-memory raw tables (tests, incremental batches)."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def table(self, name: str) -> DataFrame:
        return self.frames[name]


def open_source(spark: SparkSession, root: str):
    """Pick the reader for a directory: driver files or a raw export."""
    if path_exists(spark, f"{root.rstrip('/')}/lineitem.parquet"):
        return DriverAdapter(spark, root)
    return ParquetRawSource(spark, root)


def write_raw(source, out_root: str, tables=None) -> None:
    """Export raw tables as Parquet, in the layout that ParquetRawSource reads."""
    for name in tables or RAW_SCHEMAS:
        source.table(name).write.mode("overwrite").parquet(f"{out_root.rstrip('/')}/{name}")
