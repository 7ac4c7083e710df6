"""Epsilon grid order join against all pairs."""

import numpy as np
import pytest

from surveywave.llm import embed_dedup as E
from surveywave.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, node string, x double"


def fixture(seed=1, d=16, n=300):
    gen = np.random.default_rng(seed)
    base = gen.normal(size=(n // 6, d))
    rows = [list(map(float, np.float32(base[k % len(base)] + gen.normal(size=d) * gen.choice([0, 0.05, 0.2, 0.4])))) for k in range(n)]
    rows += [rows[0]] * 30 + [[2 * v for v in rows[1]]]  # equal vectors, a scaled one
    rows += [None, [], [0.0] * d, [float("nan")] + [1.0] * (d - 1), [float("inf")] + [0.0] * (d - 1), [None] + [1.0] * (d - 1)]
    rows += [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1e-30, 1e-31], [1e30, 1e29]]  # another dimension, extreme lengths
    out = [(k * 3, r, 0, "clash", 1.0) for k, r in enumerate(rows)]
    return out + [(None, rows[2], 0, "clash", 1.0), (0, rows[0], 0, "clash", 1.0)]


def brute(rows, threshold):
    def usable(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if usable(v) else None for _, v, *_ in rows]
    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k)), i == least.get(find(k))) for k, (i, *_) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("block,partners", [(512, 256), (16, 3)])
def test_against_all_pairs(spark, monkeypatch, block, partners):
    monkeypatch.setattr(E, "PARTNERS", partners)
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(E.embedding_dedup(df, Scratch(spark, "t"), block=block)) == brute(rows, 0.9)


def test_distant_blocks_are_skipped_and_no_near_one(spark):
    gen = np.random.default_rng(2)
    boxes, points = [], gen.normal(size=(64, 1, 3)) + gen.normal(size=(64, 5, 3)) * 0.1
    points = points[np.lexsort(np.floor(points.mean(axis=1) / 0.5).T[::-1])]
    for seq, p in enumerate(points):
        boxes.append((seq, 3, *map(float, p.min(axis=0)), *map(float, p.max(axis=0))))
    names = ["seq long", "d int", *(f"low{k} double" for k in range(3)), *(f"high{k} double" for k in range(3))]
    pairs = E.block_pairs(spark.createDataFrame(boxes, ", ".join(names)), Scratch(spark, "t"), 3, 0.5, fan=3)
    found = {(r.a, r.b) for r in pairs.collect()}
    near = {(a, b) for a in range(64) for b in range(a, 64)
            if (np.linalg.norm(points[a][:, None] - points[b][None], axis=2) <= 0.5).any()}
    assert near <= found and len(found) < 64 * 65 / 4


def test_empty_table(spark):
    assert got(E.embedding_dedup(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))) == []
    only = spark.createDataFrame([(5, None, 0, "", 0.0)], SCHEMA)
    assert got(E.embedding_dedup(only, Scratch(spark, "t"))) == [(5, 0, 5, True)]
