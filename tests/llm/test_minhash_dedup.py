"""MinHash dedup with tensored banding against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest

from surveywave.llm import minhash_dedup as M
from surveywave.llm.common import Scratch
from surveywave.llm.shingles import shingle_sets, word_hashes

SCHEMA = "doc_id long, text string, node long, tile string, keys string"
rng = random.Random(11)
WORDS = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(400)]


def prose(n):
    return [rng.choice(WORDS) for _ in range(n)]


def edited(words, share):
    return [rng.choice(WORDS) + "x" if rng.random() < share else w for w in words]


def fixture():
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "One  TWO"), (5, "one two three"), (6, "a b c d"), (7, "A B\nC D"), (8, "É b c d"), (9, "é b c d")]
    n = 10
    for size in (12, 60, 150, 900):  # near copies of growing distance, chains included
        base = prose(size)
        for k in range(14):
            base = edited(base, 0.012) if k % 3 else base
            rows.append((n, " ".join(edited(base, 0.004 * k))))
            n += 1
    common = prose(60)
    rows += [(n + k, " ".join(common + prose(30))) for k in range(25)]  # a passage that many share
    n += 25
    rows += [(n + k, " ".join(prose(40))) for k in range(20)]
    rows += [(n + 30, " ".join(prose(20_000))), (None, "no id at all here"), (None, "no id at all here"), (n + 31, "no id at all here"), (3, "one two")]
    return [(i, t, 1, "clash", None) for i, t in rows]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                up[find(i)] = find(j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    out = []
    for k, (i, *_) in enumerate(rows):
        c = least.get(find(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("tile", [256, 6])
def test_against_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(M, "TILE_TEXTS", tile)  # 6: large clusters are cut into many tiles
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(M.minhash_dedup(df, Scratch(spark, "t"))) == brute(rows)


def test_shingles_against_tuples():
    texts = [t for _, t, *_ in fixture()]
    for text, found in zip(texts, shingle_sets(texts, 4)):
        assert len(found) == len(shingles(text))
    a, b, c = shingle_sets(["A b c d e", "a B c\td  e", "a b d c e"], 4)
    assert (a == b).all() and len(np.intersect1d(a, c)) == 0


def test_long_data_are_hashed_alike_in_pieces(monkeypatch):
    from surveywave.llm import shingles as S
    data = " ".join(prose(3000)).encode() + b" " + b"y" * 500
    whole = word_hashes(data)
    monkeypatch.setattr(S, "CHUNK_BYTES", 64)
    parts = word_hashes(data)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_tensor_meets_similar_texts():
    """Table (i, j) is the pair of keys: at 0.8 a pair meets in nearly all trials, at 0.25 hardly ever."""
    tensor, gen = M.Tensor(), np.random.default_rng(5)

    def met(s):
        n, hits = 400, 0
        for _ in range(60):
            shared = round(2 * n * s / (1 + s))
            x = gen.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
            ka, kb = tensor.keys([np.unique(x[:n]), np.unique(x[n - shared:])])
            same = ka == kb
            hits += same[:tensor.parts].any() and same[tensor.parts:].any()
        return hits / 60
    assert met(0.82) >= 0.98 and met(0.25) <= 0.05


def test_empty_table(spark):
    assert got(M.minhash_dedup(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"))) == []


def test_lower_thresholds_are_refused(spark):
    with pytest.raises(ValueError, match="percent 60"):
        M.minhash_dedup(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"), percent=60)
