"""Shared helpers: scratch tables in the shared folder and row identity."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every text contract: space and U+0009..U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Only a local master may go without it (tests); a temporary folder is then
    set.  On a cluster a machine-local folder would lose data, so it raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="surveywave-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Scratch:
    """Written tables that cut lineage: a lost executor re-reads files instead
    of recomputing, and ids assigned before the write never change after it.

    The folder is removed when the driver's file systems close.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        jpath = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def hash128(*cols: Column, seed: int = 0) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of the columns, NULLs told apart."""
    parts = [p for c in cols for p in (c, c.isNull())]
    return (F.xxhash64(F.lit(2 * seed + 1), *parts), F.xxhash64(F.lit(2 * seed + 2), *parts))


def with_row_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds key1, key2: a content key that does not depend on partitioning.

    Rows share it only if id and text are equal, so a filter by it survives
    re-execution; rows that repeat in full are told apart by nothing.
    """
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    return docs.withColumns({"_key1": k1, "_key2": k2})


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose key is in kept(_key1, _key2), one row a key.

    A semi join on the 128-bit key; the text moves once.  Fully repeated rows
    (same id, same text) collapse to one, which needs no further shuffle.
    """
    keys = ["_key1", "_key2"]
    k1, k2 = hash128(F.col(id_col), F.col(text_col))
    # a struct, as docs may have columns named like the keys
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), k1.alias("_key1"), k2.alias("_key2"))
    return rows.join(kept.select(*keys), keys, "left_semi").dropDuplicates(keys).select("_doc.*")
