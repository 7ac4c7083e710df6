"""Mixing: targets against repeated resharing, exact quotas, disjoint draws, reruns."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveywave.llm.common import Scratch
from surveywave.llm.mixing import _base, _halves, mix_documents, mix_plan, mix_report

SCHEMA = "doc_id long, text string, source string, n_chars long, words long, _row string"
rng = random.Random(5)


def fixture():
    rows = []
    for n, (source, docs) in enumerate([("b", 300), ("a", 40), (None, 15), ("é", 3), ("Z", 1), ("tiny", 2), ("void", 2)]):
        for k in range(docs):
            words = 0 if source == "void" else rng.choice([1, 2, 3, 30, 400])
            rows.append((1000 * n + k, " ".join(f"w{j}" for j in range(words)), source))
    rows += [(None, "null id", "a"), (7, None, "a"), (7, None, "a"), (8, "twice here", "b"), (8, "twice here", "b"), (9, " \n", "b")]
    return [(i, t, s, len(t or ""), 5, "clash") for i, t, s in rows]


def targets(size):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * size[s] for s in capped)
        out = {s: 3.0 * size[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        over = [s for s in free if out[s] > 3 * size[s]]
        if not over:
            return out
        capped |= set(over)


def test_report_against_plain_targets(spark):
    rows = fixture()
    out = mix_report(spark.createDataFrame(rows, SCHEMA).repartition(7), Scratch(spark, "t")).toPandas()
    size = {}
    for _, t, s, *_ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    expected = targets(size)
    assert len(out) == len(rows)
    out["source"] = out["source"].where(out["source"].notna(), None)
    for source, part in out.groupby(out["source"].map(lambda s: s if s is not None else "\0null")):
        source = None if source == "\0null" else source
        assert (part["source_size"] == size[source]).all()
        assert np.allclose(part["target"], expected[source])
        # whole blocks where they come within a thousandth, else exactly the rounded target
        assert abs(part["taken"].sum() - expected[source]) <= max(0.5, 0.001 * expected[source])
    assert (out["taken"] <= 3 * out["size"]).all()


def test_reruns_agree_however_the_rows_lie(spark):
    df = spark.createDataFrame(fixture(), SCHEMA)
    runs = [sorted(map(str, mix_report(df.repartition(n), Scratch(spark, "t")).select("doc_id", "source", "size", "taken").collect())) for n in (2, 9)]
    assert runs[0] == runs[1]


def test_draws_fill_the_shards_and_are_disjoint(spark):
    base = Scratch(spark, "t").table(_base(spark.createDataFrame(fixture(), SCHEMA), "doc_id", "text", "source"), "base")
    draws, _, shards = mix_plan(base, Scratch(spark, "t"))
    draws = draws.toPandas()
    assert shards == 8
    assert not draws.duplicated(["_row", "epoch"]).any()
    sizes = draws.groupby("shard").size()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1
    for _, part in draws.groupby("shard"):
        assert sorted(part["place"]) == list(range(1, len(part) + 1))


def test_halves_are_exact_and_hypergeometric():
    quota = np.array([1000, 10, 0, 3000])
    lefts = []
    for seed in range(200):
        out = _halves(seed, 0)(pd.DataFrame({"node": 0, "sid": range(4), "quota": quota, "start": 0}))
        left, right = (out[out["node"] == k]["quota"].to_numpy() for k in (0, 1))
        assert (left + right == quota).all() and left.sum() == quota.sum() // 2 and (left >= 0).all()
        lefts.append(left[0])
    assert abs(np.mean(lefts) - 500) < 6 and 10 < np.std(lefts) < 18  # sd of the law: 13.7
    big = _halves(1, 0)(pd.DataFrame({"node": 0, "sid": [0, 1], "quota": [3 * 10**9, 10**9 + 1], "start": 0}))
    assert big["quota"].sum() == 4 * 10**9 + 1 and abs(big["quota"].iloc[0] - 1.5 * 10**9) < 10**6


def test_documents_come_out_whole_with_their_columns(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_documents(df, Scratch(spark, "t"))
    assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
    got = sorted(map(str, map(tuple, out.collect())))
    known = set(map(str, rows))
    assert got and all(r in known for r in got)  # every column of every draw, the text with it
    plan = mix_report(df, Scratch(spark, "t"), tolerance=None).where("taken > 0").collect()
    assert len(got) == sum(len(r.draws) for r in plan) and all(d.words == r["size"] for r in plan for d in r.draws)
    # a source's last block is the one left that comes nearest, so large sources lie close to their targets
    taken = {}
    for r in plan:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[r.source] - r.target) <= 0.01 * r.target for r in plan if r.source in ("a", "b"))


def test_a_cut_block_keeps_its_white_space(spark):
    text = " one\ttwo\n\nthree  four five "
    df = spark.createDataFrame([(1, text, "only", len(text), 0, ""), (2, "a b c d e", "other", 9, 0, "")], SCHEMA)
    got = mix_documents(df, Scratch(spark, "t"), tolerance=0.0).collect()
    cut = [r.text for r in got if r.doc_id == 1 and r.text != text]
    assert cut and all(text.startswith(t) and not t[-1].isspace() for t in cut) and all(r.n_chars == len(r.text) for r in got)


def test_per_shard_quotas_from_the_report(spark):
    """Each shard holds its quota of every source, in one gapless order."""
    df = spark.createDataFrame(fixture(), SCHEMA)
    out = mix_report(df, Scratch(spark, "t"), shard_words=2000)
    draws = out.select("source", F.explode("draws").alias("d")).select("source", "d.*").toPandas()
    total = draws["words"].sum()
    shards = 1 << max(3, int(total // 2000).bit_length())
    assert shards > 8 and draws["shard"].nunique() <= shards
    sizes = draws.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and sizes.sum() == len(draws)
    for _, part in draws.groupby("shard"):
        assert sorted(part["place"]) == list(range(1, len(part) + 1))
    # the law of the tree: a large source is spread over all shards by its share of the draws
    share = (draws["source"] == "b").mean()
    got = draws[draws["source"] == "b"].groupby("shard").size().reindex(range(shards), fill_value=0)
    assert abs(got - share * sizes.mean()).max() < 6 * np.sqrt(sizes.mean() * share * (1 - share)) + 1


def test_draws_of_a_shard_against_plain_order(spark):
    """The draws of a source, ranked over its passes, go to shards in runs as long as the quotas."""
    base = Scratch(spark, "t").table(_base(spark.createDataFrame(fixture(), SCHEMA), "doc_id", "text", "source"), "base")
    draws, _, shards = mix_plan(base, Scratch(spark, "t"), shard_words=3000)
    keys = {r._row: (r._key1, r._key2, r.source) for r in base.collect()}
    hashes = spark.createDataFrame([(r._row, r.epoch, *keys[r._row][:2]) for r in draws.collect()], "r long, epoch long, _key1 long, _key2 long").select(
        "r", "epoch", F.xxhash64(F.lit(17), "epoch", "_key1", "_key2").alias("h")).collect()
    h = {(r.r, r.epoch): r.h & 0xFFFFFFFFFFFFFFFF for r in hashes}
    by_source = {}
    for r in draws.collect():
        by_source.setdefault(keys[r._row][2], []).append((r.epoch, h[r._row, r.epoch], r.shard, r.words < r["size"]))
    for rows in by_source.values():
        rows.sort()
        # the pick that fills up the last pass comes last in rank, wherever its hash lies
        order = [r[2] for r in rows]
        moves = sum(a > b for a, b in zip(order, order[1:]))
        assert moves <= 2


def test_a_very_long_text(spark):
    rows = [(k, "w " * (300_000 if k == 3 else 50), "s" if k % 2 else "t", 0, 0, "") for k in range(40)]
    out = mix_report(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t")).collect()
    assert max(r["size"] for r in out) == 300_000 and all(r.taken <= 3 * r["size"] for r in out)


@pytest.mark.parametrize("rows", [[], [(1, None, None, 0, 0, "")]])
def test_nothing_to_mix(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert mix_report(df, Scratch(spark, "t")).agg(F.sum("taken")).first()[0] in (None, 0)
    assert mix_documents(df, Scratch(spark, "t")).count() == 0
