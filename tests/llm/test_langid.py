"""Language ID: gram sets against a loop, the fold against the kernel, held-out accuracy."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from surveywave.llm import langid as L

SF = "/root/testdata/sf0.01"


def plain_grams(text):
    symbols, last = [], None
    for s in L._fold(np.frombuffer((text or "").encode("utf-32-le"), np.uint32)).tolist():
        if s or last != 0:
            symbols.append(s)
        last = s
    if not any(symbols):
        return []
    out = set(symbols)
    out |= {64 + a * 64 + b for a, b in zip(symbols, symbols[1:])}
    out |= {64 + 4096 + a * 4096 + b * 64 + c for a, b, c in zip(symbols, symbols[1:], symbols[2:])}
    return sorted(out)


def test_gram_sets_against_a_loop():
    texts = [None, "", "123 !?", "a", "Ab", "The  cat; sat", "Été à l'école", "日本語 text", "  x  "]
    assert [g.tolist() for g in L.gram_sets(texts)] == [plain_grams(t) for t in texts]


def test_long_texts_lose_no_gram_at_the_cuts(monkeypatch):
    text = "".join(random.Random(1).choice("abcdefgh .,") for _ in range(3000))
    monkeypatch.setattr(L, "PIECE", 50)
    assert set(plain_grams(text)) - set(L.gram_sets([text])[0].tolist()) == set()


def test_folded_weights_equal_the_kernel_machine():
    rng = random.Random(2)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(60))
    texts = [make("abc ") for _ in range(12)] + [make("cde ") for _ in range(12)] + [make("efg ") for _ in range(12)]
    labels = ["x"] * 12 + ["y"] * 12 + ["z"] * 12
    sets = L.gram_sets(texts)
    model = L.fit(sets, labels, landmarks=5)
    marks = [sets[k] for k in (*range(5), *range(12, 17), *range(24, 29))]
    kernel = np.array([[len(set(a) & set(b)) / np.sqrt(len(a) * len(b)) for b in marks] for a in sets])
    assert np.allclose(kernel, L._shared(sets, marks), atol=1e-6)
    names, scores = L.predict(model, texts)
    assert names == labels and ((scores > 1 / 3) & (scores <= 1)).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.identify(docs, L.train(docs)).toPandas()
    assert len(out) == docs.count()
    assert (out["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"]]).all()
    long = out[out["held_out"] & (out["n_chars"] > 50)]
    assert (long["lang"] == long["lang_pred"]).mean() > 0.98
    assert out["score"].between(0, 1).all()


def test_only_text_decides_and_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300).cache()
    one = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(docs, L.train(docs)).collect()}
    wrong = docs.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    two = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(wrong, L.train(wrong)).collect()}
    assert one == two


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string, rank int"
    rows = [(1, "the cat and the dog", "en", "clash", 1), (3, "der hund und die katze", "de", None, 1), (4, None, "en", None, 1), (5, "", None, None, 1),
            (6, "1234 !!", "en", None, 1), (None, "the house", None, None, 1), (7, "the cat and the dog", "en", None, 1), (7, "the cat and the dog", "en", None, 1),
            (8, "und die " * 50_000, None, None, 1)]
    docs = spark.createDataFrame(rows, schema)
    out = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in L.identify(docs, L.train(docs)).collect()}
    assert out[(4, None)] == out[(5, "")] == out[(6, "1234 !!")] == ("und", 0.0)
    assert out[(None, "the house")][0] == "en" and out[(8, "und die " * 50_000)][0] == "de"
    empty = spark.createDataFrame([], schema)
    assert L.identify(empty, L.train(empty)).count() == 0
    assert {r.lang_pred for r in L.identify(docs, L.train(empty)).collect()} == {"und"}
