"""What the driver may be asked to broadcast under the library's settings."""

import pytest
from pyspark.sql import functions as F

from surveywave.operators.sequence import stored_table
from surveywave.session import apply_sql_defaults


@pytest.fixture(scope="module")
def sides(spark):
    apply_sql_defaults(spark)
    key = F.col("id")
    wide = spark.range(2_000_000).select(key, (key % 5).alias("survey"), (key % 7).cast("string").alias("note"), (key * 3).alias("other"))
    return stored_table(wide), stored_table(wide.limit(1000)), stored_table(spark.range(0, 4_000_000, 2).repartition(4))


def plan_of(df):
    assert df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_million_ids_in_small_files_are_not_broadcast(sides):
    """A hash table of them takes 100 MB and more, whatever their files take."""
    large, _, ids = sides
    assert "BroadcastHashJoin" not in plan_of(ids.join(large.select("id", "survey"), "id").groupBy("survey").count())


def test_a_small_dimension_is_broadcast(sides):
    _, small, ids = sides
    assert "BroadcastHashJoin" in plan_of(ids.join(small.select("id", "survey"), "id").groupBy("survey").count())


def test_measured_rows_that_are_many_are_not_broadcast(sides):
    """Rows after a shuffle: 24 MB of them in memory make no broadcast."""
    large, _, ids = sides
    few = large.where("id % 2 = 0").groupBy("id").agg(F.max("survey").alias("survey"))
    assert "BroadcastHashJoin" not in plan_of(few.join(ids, "id").groupBy("survey").count())
