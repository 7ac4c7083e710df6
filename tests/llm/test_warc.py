"""WARC: exact round trips, payloads that imitate the format, copies, NULLs."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from surveywave.llm.common import Scratch
from surveywave.llm.warc import archive_records, read_archives, resolve_revisits, write_archives

SCHEMA = "page_id long, url string, html string, digest string"


def run(spark, pages, files=4):
    scratch = Scratch(spark, "test-warc")
    path = scratch.path("archives")
    df = spark.createDataFrame(pages, SCHEMA).repartition(files)
    write_archives(archive_records(df, scratch), path, records_per_file=3)
    return read_archives(spark, path)


@pytest.fixture(scope="module")
def pages():
    tricky = ["a\r\n\r\nb", "ends\r\n", "ends\r\n\r\n", "\r\n\r\n", "\r\n", "x\r\n\r", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "", None,
              "é😀\r\n\r\nß" * 3, "y" * 200_000, "\n\n", "\r"]
    rows = [(k, f"http://a/{k}", h, "clash") for k, h in enumerate(tricky)]
    rows += [(100 + k, None if k % 2 else "http://b/\r\nX: 1", "copy", None) for k in range(40)]  # one payload, many pages
    rows += [(None, "http://c/", "copy", None), (7, "http://same/", "twice", None), (7, "http://same/", "twice", None)]
    return rows


def test_round_trip_against_a_plain_loop(spark, pages):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in resolve_revisits(run(spark, pages)).collect()), key=str)
    largest = {}
    for page, _, html, _ in pages:
        key = html or ""
        largest[key] = max(largest.get(key, -1), -1 if page is None else page)
    expected, used = [], set()
    for page, _, html, _ in pages:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        top = largest[html or ""]
        first = page == top and (html or "") not in used
        used |= {html or ""} if first else set()
        expected.append((page, len(data), digest, "response" if first else "revisit", None if first else top))
    assert got == sorted(expected, key=str)


def test_header_digest_is_the_payload_digest(spark, pages):
    read = run(spark, pages, files=1)
    wrong = read.where("record_type = 'response' and digest <> payload_digest")
    assert wrong.count() == 0
    assert read.count() == len(pages)
    assert read.select("record_id").distinct().count() == len(pages)


def test_rerun_writes_the_same_records(spark, pages):
    one = run(spark, pages, 2).agg(F.bit_xor(F.xxhash64("record_id", "refers_to_id")).alias("x")).first()
    two = run(spark, pages, 5).agg(F.bit_xor(F.xxhash64("record_id", "refers_to_id")).alias("x")).first()
    assert one == two


def test_short_payloads_stay_responses(spark):
    scratch = Scratch(spark, "test-warc")
    df = spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcdef", ""), (4, "u", "abcdef", "")], SCHEMA)
    path = scratch.path("archives")
    write_archives(archive_records(df, scratch, min_bytes=5), path)
    got = {r.page_id: (r.record_type, r.refers_to) for r in resolve_revisits(read_archives(spark, path)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_empty_table(spark):
    assert resolve_revisits(run(spark, [])).count() == 0
