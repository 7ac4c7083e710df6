"""Spark session defaults for the library.

The library never creates a session behind the caller's back: callers (tests,
bench, driver) pass one in.  ``build_session`` is a convenience for local runs
and tests; on a cluster the session comes from the platform and only the SQL
settings in ``SQL_DEFAULTS`` matter.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run relies on.  UTC pins the epoch → timestamp → date chain
# (to_char/::date semantics of the source system); AQE re-plans joins from real
# shuffle sizes, coalesces small partitions and splits skewed join partitions.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Join sides below this size are broadcast by the planner from statistics
    # and, with AQE, from the measured shuffle output.  It is a size check, not
    # a promise: anything larger falls back to a sort-merge join.  The statistics
    # are bytes of compressed columns, of which a hash table on the driver takes
    # many times as many (under 32 MB of files were 9 million ids, 609 MB, and
    # sorted ids take less); the shuffle output is measured in rows as they are in
    # memory, a hash table of which takes several times as many.
    "spark.sql.autoBroadcastJoinThreshold": str(256 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(2 * 1024 * 1024),
    # What a task reads is coalesced to this (compressed; several times that when
    # it is sorted), so sorts and windows of a task stay in memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    # And of a file: grouping by keys that hardly repeat keeps a task's rows in memory.
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
}


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "surveywave",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session.  Spark UI stays off (no server, no port)."""
    master = master or os.environ.get("SURVEYWAVE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SURVEYWAVE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_defaults(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is read from the session.  Only a local master may go without it (tests):
    a scratch folder is made then.  Anywhere else a machine-local folder would
    lose data, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="surveywave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
