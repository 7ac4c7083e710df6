"""Exact dedup by block naming against grouping by the text itself."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from surveywave.llm.common import Scratch, hash128, keep_rows
from surveywave.llm.exact_dedup import exact_dedup

SCHEMA = "doc_id long, text string, name string, _row long, group_size string"


def fixture():
    rows = [(1, "same text"), (2, " same\ttext\n"), (3, "sametext"), (4, "other"), (5, None), (6, ""), (7, " \r\n\x0b\x0c "),
            (8, "nbsp stays"), (9, "nbspstays"), (10, "abcd" * 40), (11, "abcd " * 40), (12, "abcd" * 39 + "abce"), (13, "abcd" * 41),
            (14, "ab"), (15, "a b"), (None, "null id"), (16, "null  id"), (None, "alone"), (17, "twice"), (17, "twice"),
            (18, "é😀" * 30), (19, "é😀 " * 30), (20, "x" * 100_000), (21, "x" * 99_999 + " x"), (22, "x" * 100_001)]
    return [(i, t, "n", 1, "clash") for i, t in rows] + [(100 + k, "hot copy " * 5, None, None, None) for k in range(200)]


def brute(rows):
    groups = {}
    for k, (i, t, *_) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i if i is not None else 0, k, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        out += [(m[4], best[4], len(members), m is best, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [4, 4096])
def test_against_grouping_by_text(spark, block):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(exact_dedup(df, Scratch(spark, "t"), block_chars=block)) == brute(rows)


def test_a_poor_hash_is_found_out_and_replaced(spark):
    def poor(*cols, seed=0):
        return (F.length(cols[0]).cast("long"), F.lit(0).cast("long")) if seed == 0 else hash128(*cols, seed=seed)
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(exact_dedup(df, Scratch(spark, "t"), block_chars=8, hashing=poor)) == brute(rows)


def test_kept_rows_come_back_whole(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    out = keep_rows(df, exact_dedup(df, Scratch(spark, "t")).where("kept"))
    assert out.columns == df.columns
    assert out.count() == sum(r[3] for r in brute(rows))


def test_empty_table(spark):
    assert got(exact_dedup(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))) == []
