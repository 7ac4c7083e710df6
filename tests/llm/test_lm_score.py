"""Pseudo-likelihood: vectorised scores against a loop over tokens, gradients, learning."""

import math
import random

import numpy as np
import pytest

from surveywave.llm import lm_score as S
from surveywave.llm.common import Scratch
from surveywave.llm.shingles import word_hashes

SCHEMA = "doc_id long, text string, n_tokens string, w int"


def sentences(n, seed=1):
    """Even places hold one kind of word, odd places another."""
    rng = random.Random(seed)
    kinds = [[f"a{k}" for k in range(30)], [f"b{k}" for k in range(30)]]
    return [" ".join(rng.choice(kinds[j % 2]) for j in range(rng.randrange(5, 60))) for _ in range(n)]


def small_tokens(texts, vocabulary=40):
    count = {}
    for t in texts:
        for h in word_hashes(t.encode())[0].tolist():
            count[h] = count.get(h, 0) + 1
    top = sorted(count, key=lambda h: (-count[h], h))[:vocabulary]
    other = np.zeros(8)
    for h in count:
        if h not in top:
            other[h % 8] += count[h]
    return S.Tokens(np.array(top, np.uint64).view(np.int64), np.array([count[h] for h in top], float), other, 16)


def test_the_query_against_a_loop(spark):
    """The registered path, token by token: class, token in its class, word in its
    bucket, and what the corpus has between the same neighbours."""
    shared = "rare passage of several uncommon words that two documents have"
    texts = [*sentences(40), "", None, "unknown words only", "one", f"x {shared} y", f"z {shared} q", "twice here twice here twice here"]
    size = dict(vocabulary=12, buckets=8, classes=16, listed=9, least=8)
    df = spark.createDataFrame([(k, t, "", 1) for k, t in enumerate(texts)], SCHEMA).repartition(5)
    got = {r.doc_id: r for r in S.score_documents(df, Scratch(spark, "t"), **size).collect()}
    source = df.selectExpr("doc_id", "text _t")
    tokens, counts = S.learn_tokens(source.select("_t"), Scratch(spark, "t"), **size)
    flat = S.train_network(source, tokens, counts, 16, S.SHARD_TOKENS)
    net = S.Network(16, flat)
    p = {k: v.astype(float) for k, v in net.p.items()}
    words = [(t or "").split() for t in texts]
    count, places = {}, {}
    for line in words:
        for t, w in enumerate(line):
            count[w] = count.get(w, 0) + 1
            between = (line[t - 1] if t else None, w, line[t + 1] if t + 1 < len(line) else None)
            places[between] = places.get(between, 0) + 1
    hashed = {w: int(word_hashes(w.encode())[0][0]) for w in count}
    number = {w: int(tokens.number(np.array([h], np.uint64))[0]) for w, h in hashed.items()}
    listed = {w for w, h in hashed.items() if h in set(tokens.listed.tolist())}
    assert listed and len({w for w in count if number[w] >= len(tokens.words)} - listed) > 20
    mass = {}
    for w, n in count.items():
        mass[number[w]] = mass.get(number[w], S.UNSEEN) + n
    for k, line in enumerate(words):
        classes = [16, 16, *(int(tokens.of[number[w]]) for w in line), 16, 16]
        expected = 0.0
        for t, w in enumerate(line):
            x = np.concatenate([p["e"][classes[t + 2 + s]] for s in (-2, -1, 1, 2)])
            z = np.tanh(x @ p["w"] + p["b"]) @ p["v"] + p["c"]
            own = z[tokens.of[number[w]]] - math.log(np.exp(z).sum()) + tokens.share[number[w]]
            if number[w] >= len(tokens.words):
                own += math.log(count[w] / mass[number[w]])
                m = places[line[t - 1] if t else None, w, line[t + 1] if t + 1 < len(line) else None] - 1
                own = own if w in listed else math.log((m + math.exp(own)) / (m + 1))
            expected += own
        assert got[k].n_tokens == len(line) and got[k].log_likelihood == pytest.approx(expected, rel=1e-4, abs=1e-6)


def test_one_and_many_partitions_agree(spark):
    texts = [*sentences(400), *(f"only here k{k} and there j{k}" for k in range(200))]
    df = spark.createDataFrame([(k, t, "", 1) for k, t in enumerate(texts)], SCHEMA)
    runs = [{r.doc_id: r.log_likelihood for r in S.score_documents(df.repartition(n), Scratch(spark, "t"), vocabulary=64, buckets=8, classes=16, shard_tokens=2000).collect()}
            for n in (1, 32)]
    assert all(runs[0][k] == pytest.approx(v, rel=1e-6) for k, v in runs[1].items())


def test_documents_that_occur_twice_score_higher(spark):
    rng = random.Random(6)
    weights = [1 / (k + 20) for k in range(20_000)]
    draw = lambda: " ".join(f"w{k}" for k in rng.choices(range(20_000), weights, k=120))
    texts = [draw() for _ in range(600)]
    rows = [(k, t, "", 1) for k, t in enumerate(texts)] + [(1000 + k, texts[k], "", 1) for k in range(30)]
    out = S.score_documents(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "t")).collect()
    twice = [r.mean_log_prob for r in out if r.doc_id < 30 or r.doc_id >= 1000]
    once = sorted(r.mean_log_prob for r in out if 30 <= r.doc_id < 1000)
    assert sum(x > once[int(0.9 * len(once))] for x in twice) > 0.9 * len(twice)


def test_shares_of_a_class_sum_to_one():
    tokens = small_tokens(sentences(50))
    for c in set(tokens.of.tolist()):
        assert np.exp(tokens.share[tokens.of == c]).sum() == pytest.approx(1)


def test_gradient_against_differences():
    gen = np.random.default_rng(3)
    net = S.Network(5)
    sides, target = gen.integers(0, 6, (7, 4)), gen.integers(0, 5, 7)
    start = net.flat.copy()
    net.train(sides, target)
    grad = net.grad.copy()

    def loss(flat):
        z = S.Network(5, flat).forward(sides)[2]
        return -z[np.arange(7), target].astype(float).mean()
    for k in gen.choice(len(start), 40, replace=False):
        step = np.zeros_like(start)
        step[k] = 1e-2
        assert (loss(start + step) - loss(start - step)) / 2e-2 == pytest.approx(grad[k], abs=2e-3)


def test_training_on_all_partitions_beats_word_counts(spark):
    texts = sentences(6000)
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in enumerate(texts)], SCHEMA).repartition(3)
    out = S.score_documents(df, Scratch(spark, "t"), vocabulary=64, buckets=8, classes=16).toPandas()
    assert (out.sort_values("doc_id")["n_tokens"].to_numpy() == [len(t.split()) for t in texts]).all()
    mean = out["log_likelihood"].sum() / out["n_tokens"].sum()
    assert mean > math.log(1 / 60) + 0.3  # counts alone give log 1/60; knowing the kind gives log 1/30
    mixed = spark.createDataFrame([(1, " ".join(sorted(texts[0].split())), "", 1), (0, texts[0], "", 1), *((k, t, "", 1) for k, t in enumerate(texts[1:], 2))], SCHEMA)
    score = {r.doc_id: r.mean_log_prob for r in S.score_documents(mixed, Scratch(spark, "t"), vocabulary=64, buckets=8, classes=16).where("doc_id < 2").collect()}
    assert score[0] > score[1] + 0.2  # the same words in a wrong order score lower


def test_words_of_one_class_are_told_apart(spark, tmp_path, monkeypatch):
    """All words are about as frequent: only who they are tells the kinds apart, in the query too."""
    from surveywave.llm import queries
    texts = sentences(6000)
    rows = [(0, texts[0], "", 1), (1, " ".join(sorted(texts[0].split())), "", 1), *((k, t, "", 1) for k, t in enumerate(texts[1:], 2))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(queries, "_table", lambda *a: df)
    out = queries.op6_lm_score(spark, str(tmp_path)).toPandas().set_index("doc_id")
    assert out["log_likelihood"].sum() / out["n_tokens"].sum() > math.log(1 / 60) + 0.3
    assert out["mean_log_prob"][0] > out["mean_log_prob"][1] + 0.2
    two = S.score_documents(df, Scratch(spark, "t"), vocabulary=64, buckets=8, classes=2, words=True).toPandas()
    assert two["log_likelihood"].sum() / two["n_tokens"].sum() > math.log(1 / 60) + 0.3


def test_words_sum_to_one_and_gradient_against_differences():
    gen = np.random.default_rng(3)
    of = np.array([0, 1, 1, 2, 2, 2, 1, 2])
    net = S.Network(3, of=of, start=gen.normal(0, 1, 8))
    net.p["u"][:] = gen.normal(0, 1, net.p["u"].shape)
    sides, target = gen.integers(0, 9, (9, 4)), gen.integers(0, 8, 9)
    total = sum(np.exp(net.log_prob(sides, np.full(9, t))) for t in range(8))
    assert total == pytest.approx(np.ones(9), rel=1e-4)
    start = net.flat.copy()
    net.train(sides, target)
    grad = net.grad.copy()

    def loss(flat):
        return -S.Network(3, flat, of=of).log_prob(sides, target).astype(float).mean()
    for k in gen.choice(len(start), 80, replace=False):
        step = np.zeros_like(start)
        step[k] = 1e-2
        assert (loss(start + step) - loss(start - step)) / 2e-2 == pytest.approx(grad[k], abs=2e-3)


def word_network(seed=3, spread=1.0):
    gen = np.random.default_rng(seed)
    net = S.Network(3, of=np.array([0, 1, 1, 2, 2, 2, 1, 2]), start=gen.normal(0, 1, 8))
    net.p["u"][:] = gen.normal(0, spread, net.p["u"].shape)
    return net, gen.integers(0, 9, (9, 4)), gen.integers(0, 8, 9)


def test_a_step_takes_every_exponential_once(monkeypatch):
    """Those of the hidden layer, of the classes and of the tokens of the target's class."""
    gen = np.random.default_rng(4)
    net = S.Network(64, of=np.repeat(np.arange(64), 2), start=gen.normal(0, 1, 128))
    taken, exp = [], np.exp
    monkeypatch.setattr(S.np, "exp", lambda x, *a, **k: taken.append(np.size(x)) or exp(x, *a, **k))
    net.train(gen.integers(0, 129, (9, 4)), gen.integers(0, 128, 9))
    assert sum(taken) <= 9 * (S.HIDDEN + 64 + 2)


def test_logits_beyond_the_range_of_exponentials():
    """They are shifted: values and gradients as in double precision."""
    net, sides, target = word_network(spread=200.0)
    net.p["c"][:] = [150, -150, 0]
    start, p, of = net.flat.copy(), {k: v.astype(float) for k, v in net.p.items()}, net.of
    h = np.tanh(p["e"][sides].reshape(9, -1) @ p["w"] + p["b"])
    z, inner = h @ p["v"] + p["c"], (h @ p["q"]) @ p["u"].T + p["o"]
    assert np.abs(inner).max() > 100
    at = np.where(of[net.place.argsort()] == of[target][:, None], inner, -np.inf)  # u and o lie by class
    soft = [np.exp(x - x.max(axis=1, keepdims=True)) for x in (z, at)]
    soft = [x / x.sum(axis=1, keepdims=True) for x in soft]
    with np.errstate(divide="ignore"):
        wanted = sum(x - top - np.log(np.exp(x - top).sum(axis=1, keepdims=True)) for x, top in ((z, z.max(axis=1, keepdims=True)),))[np.arange(9), of[target]]
        top = at.max(axis=1, keepdims=True)
        wanted = wanted + (at - top - np.log(np.exp(at - top).sum(axis=1, keepdims=True)))[np.arange(9), net.place[target]]
    assert net.log_prob(sides, target) == pytest.approx(wanted, rel=1e-3, abs=1e-2)
    net.train(sides, target)
    soft[1][np.arange(9), net.place[target]] -= 1
    alone = np.bincount(of)[of[net.place.argsort()]] == 1
    soft[1][:, alone] = 0
    assert net.g["u"] == pytest.approx(soft[1].T @ (h @ p["q"]) / 9, abs=1e-3)
    soft[0][np.arange(9), of[target]] -= 1
    assert net.g["c"] == pytest.approx(soft[0].mean(axis=0), abs=1e-4)
    assert np.isfinite(net.flat).all() and (net.flat != start).any()


@pytest.mark.parametrize("crowded", [False, True])
def test_numbers_of_words(crowded):
    gen = np.random.default_rng(5)
    words = np.unique(gen.integers(0, 1 << 63, 300, dtype=np.uint64) >> np.uint64(50 if crowded else 0))
    tokens = S.Tokens(words.view(np.int64), np.arange(1.0, len(words) + 1), np.ones(8), 4)
    assert (tokens.steps > S.MOST_STEPS) == crowded
    asked = np.concatenate((words, words + np.uint64(1), gen.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2), np.array([0, 2**64 - 1], np.uint64)))
    known = {w: k for k, w in enumerate(words.tolist())}
    assert tokens.number(asked).tolist() == [known.get(w, len(words) + w % 8) for w in asked.tolist()]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "word here"), (4, "word here"), (4, "word here"), (5, "long " * 200_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = S.score_documents(df, Scratch(spark, "t")).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in out) == sorted((str(i), len((t or "").split())) for i, t in rows)
    assert all((r.mean_log_prob is None) == (r.n_tokens == 0) and r.log_likelihood <= 0 for r in out)
    same = {round(r.log_likelihood, 9) for r in out if r.n_tokens == 2}
    assert len(same) == 1
    assert S.score_documents(spark.createDataFrame([], SCHEMA), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("listed,least", [(0, 8), (10, 1), (1000, 1), (1000, 8)])
def test_every_word_has_its_own_count(spark, listed, least):
    """All 40 words share the one bucket; listed and joined counts are the same."""
    texts = [" ".join(x for j in range(k + 1) for x in (f"w{k}", f"u{k}x{j}")) for k in range(40)]  # no word twice between the same two
    df = spark.createDataFrame([(k, t, "", 1) for k, t in enumerate(texts)], SCHEMA).repartition(3)
    out = S.score_documents(df, Scratch(spark, "t"), vocabulary=0, buckets=1, classes=1, listed=listed, least=least).collect()
    total = 2 * sum(range(1, 41)) + S.UNSEEN
    for row in out:  # one class and one bucket: what is left is the word's share of all counts
        n = row.doc_id + 1
        assert row.log_likelihood == pytest.approx(n * math.log(n / total) + n * math.log(1 / total), rel=1e-6)
