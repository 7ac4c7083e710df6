"""The pipeline's stages against plain versions, odd rows, and the registration."""

import random
import re

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline as P
from surveywave.llm.common import Scratch
from surveywave.llm.langid import held_out
from surveywave.llm.mixing import mix_report
from surveywave.llm.packing import WordEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row int, shard string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = {"en": "the of and to in is that for it was house water tree".split(), "de": "der die und das ist nicht ein haus wasser baum mit".split()}
    out = []
    for k in range(120):
        lang = rng.choice(["en", "de"])
        out.append((k, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(30, 200))), lang, f"s{k % 3}"))
    out += [(200, out[0][1] + " ", "en", "s0"), (201, out[1][1], None, None), (202, out[2][1] + " extra", None, "s1"),  # copies, a near copy
            (203, None, "en", "s1"), (204, "", "de", "s1"), (205, "123 456 !!", "en", "s2"), (206, " \n ", None, None), (207, "und", None, "s2"),
            (None, "the tree and the house " * 3, "en", None), (208, "the water of the house " * 8000, "en", "s2")]
    return [(i, t, lang, s, len(t or ""), 7, "clash") for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_language_keeps_clean_documents(spark, rows, docs):
    out = P.language_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert ids(out) == sorted((r[0] for r in rows if r[0] not in (203, 204, 205, 206)), key=str)


def test_exact_against_grouping(spark, rows, docs):
    out = P.exact_stage(spark, docs, "")
    best = {}
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        best.setdefault(norm, []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    assert out.columns == docs.columns
    assert ids(out) == sorted((min(v)[3] for v in best.values()), key=str)


def test_minhash_against_all_pairs(spark, rows, docs):
    out = P.minhash_stage(spark, docs, "")
    sets = {}
    for r in rows:
        w = (r[1] or "").lower().split()
        sets[r[0]] = frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()
    group = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]) and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    kept = {min((x for x in g if x is not None), default=None) for g in map(frozenset, group.values())}
    assert out.columns == docs.columns and ids(out) == sorted(kept, key=str)


def test_mixing_and_packing(spark, rows, docs):
    mixed = P.mixing_stage(spark, docs, "").cache()
    assert mixed.columns == docs.columns
    drawn = mixed.collect()
    texts = [r.text for r in drawn]
    known = set(map(str, rows))
    assert all(str(tuple(r)) in known for r in drawn)  # whole documents, every column as it was
    # whole documents miss a source's target by half of its largest one at most
    size, largest, taken = {}, {}, {}
    for r in rows:
        n = len((r[1] or "").split())
        size[r[3]], largest[r[3]] = size.get(r[3], 0) + n, max(largest.get(r[3], 0), n)
    for r in drawn:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    target = {r.source: r.target for r in mix_report(docs, Scratch(spark, "t")).collect()}
    assert all(abs(taken.get(k, 0) - t) <= largest[k] / 2 + 0.5 for k, t in target.items())
    pieces = P.packing_stage(spark, mixed, "").toPandas()
    ids = WordEncoder(public_tokenizers.path("word_bpe_49k.json")).encode(texts)
    assert pieces["length"].sum() == sum(len(x) + 1 for x in ids)
    assert (np.frombuffer(b"".join(pieces["ids"]), "<u4") == 2).sum() >= len(texts)


def test_run_chains_the_stages(spark, tmp_path, rows, docs):
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    out = P.run(spark, f"file://{tmp_path}").toPandas()
    # the stages one by one, on plain frames
    left = P.minhash_stage(spark, P.exact_stage(spark, P.language_stage(spark, docs, ""), "").cache(), "").collect()
    words, longest = sum(len(r.text.split()) for r in left), max(len(r.text.split()) for r in left)
    drawn = out.drop_duplicates(["doc_id", "start", "sequence_id", "offset"])
    assert len(drawn) == len(out) and set(out["doc_id"].dropna()) <= {r.doc_id for r in left}
    ends = (np.frombuffer(b"".join(out["ids"]), "<u4") == 2).sum()
    assert out["length"].sum() - ends >= words - longest  # a word has a token at least, and documents are drawn whole


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() == 0
    assert P.packing_stage(spark, docs, "").count() == 0


def test_all_operators_are_registered():
    names = list(__spark_entry__.queries())
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert "op10_exact_dedup" in __spark_entry__.oracle_sql()
    assert len(P.STAGES) == 5 and held_out is not None


def test_language_rejects_what_is_in_no_learned_language(spark, rows, docs):
    rng = random.Random(4)
    noise = [(300, " ".join("".join(rng.choice("bcfgjkpqvxyz") for _ in range(7)) for _ in range(60))), (301, "xqzjvk" * 30), (302, "привет как дела " * 9)]
    bad = spark.createDataFrame([(i, t, None, "s0", len(t), 7, "clash") for i, t in noise], SCHEMA)
    clean = ids(P.language_stage(spark, docs, ""))
    assert ids(P.language_stage(spark, docs.unionByName(bad), "")) == clean and len(clean) == len(rows) - 4


@pytest.mark.parametrize("label", ["NULL", "if(crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 4 = 2, lang, NULL)"])
def test_language_keeps_texts_where_nothing_could_be_learned(spark, rows, docs, label):
    blank = docs.selectExpr("doc_id", "text", f"cast({label} as string) lang", "source", "n_chars", "_row", "shard")
    assert ids(P.language_stage(spark, blank, "")) == sorted((r[0] for r in rows if r[0] not in (203, 204, 205, 206)), key=str)
