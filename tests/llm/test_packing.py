"""Packing: every id once, gapless, ids equal to the tokenizer's own."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surveywave.llm import packing as P
from surveywave.llm.common import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, bin long"


def fixture():
    rng = random.Random(4)
    texts = [None, "", " \n", "Hello, World!", "it's, don't... (we'll)?! x***. a.b", "<|endoftext|> in a text <|STARTOFTEXT|>", "É́Ａß ÀÉ İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ",
             "a b c\x1cd\x85e", "1,234.56 €9", "日本語テキスト。", "Café café, é.", "kK! ẞ", "tab\tnew\nline\x0b\x0c", "don't'll 's's"]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(100 + k, " ".join(rng.choice(["alpha", "Beta.", "gamma,", "x1y2", "zzz"]) for _ in range(rng.choice([1, 40, 700, 6000])))) for k in range(60)]
    rows += [(None, "no id"), (50, "twice"), (50, "twice"), (51, "word " * 120_000)]
    return [(i, t, "clash", 9) for i, t in rows]


def test_word_by_word_ids_are_the_tokenizers():
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t for _, t, *_ in fixture() if t is None or len(t) < 5000]
    for text, ids in zip(texts, P.WordEncoder(PATH).encode(texts)):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_the_cache_may_be_cleared(monkeypatch):
    monkeypatch.setattr(P, "CACHE_WORDS", 3)
    encoder = P.WordEncoder(PATH)
    texts = ["one two three four five", "six seven"]
    assert [a.tolist() for a in encoder.encode(texts)] == [a.tolist() for a in encoder.encode(texts)]


@pytest.mark.parametrize("parts,fan", [(1, 32), (7, 2)])
def test_round_trip(spark, monkeypatch, parts, fan):
    monkeypatch.setattr(P, "FAN_IN", fan)
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    pieces = P.pack_documents(df, Scratch(spark, "t"), PATH, open_windows=8).toPandas()
    encoder = P.WordEncoder(PATH)
    expected = [(i, np.append(ids, 2)) for (i, *_), ids in zip(rows, encoder.encode([t for _, t, *_ in rows]))]
    # pieces say what they hold
    for piece in pieces.itertuples():
        assert zlib.crc32(piece.ids) == piece.ids_crc32 and len(piece.ids) == 4 * piece.length
    # each id of each document in exactly one piece
    for doc, ids in expected:
        own = pieces[pieces["doc_id"].isna() if doc is None else pieces["doc_id"] == doc].sort_values(["start", "sequence_id"])
        times = sum(d == doc for d, _ in expected)
        assert (own["doc_tokens"] == len(ids)).all() and own["length"].sum() == len(ids) * times
        if times == 1:
            assert np.concatenate([np.frombuffer(x, "<u4") for x in own["ids"]]).tolist() == ids.tolist()
            assert own["start"].tolist() == np.concatenate(([0], own["length"].cumsum()[:-1])).tolist()
    # sequences are gapless and at most a window
    padding = total = 0
    for _, sequence in pieces.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == np.concatenate(([0], sequence["length"].cumsum()[:-1])).tolist()
        n = int(sequence["length"].sum())
        assert n <= P.WINDOW
        total += n
        padding += 0 if n & (n - 1) == 0 else P.WINDOW - n
    assert padding < 0.05 * total


def test_best_fit_and_the_fullest_go():
    packer = P.Packer(0, 16, 2, True, 0)
    ids = lambda n: np.arange(n, dtype=np.uint32)
    for doc, n in enumerate((10, 6, 4, 9, 13)):
        packer.add(doc, 0, ids(n), n)
    # 10 | 10, 6 fills the window; 4 | 4, 9; then 13 opens the second
    assert [(r[0], r[2]) for r in packer.rows] == [(0, 0), (1, 10)]
    packer.add(9, 0, ids(15), 15)  # none fits: two windows of 13 are open, the first goes
    assert [r[0] for r in packer.rows] == [0, 1, 2, 3]


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], SCHEMA), Scratch(spark, "t"), PATH).count() == 0
