import random
import re

import numpy as np
from pyspark.sql import functions as F

from surveywave.llm import queries
from surveywave.llm.common import Scratch
from surveywave.llm.quality_rules import RULES, bucket_of, fences, measures, merge, quality_rules, quartiles, sketch

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(lines))


def test_measures_against_plain_python(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "\n\n", "a", "# $ & | <b>", "a\r\na\r\n", "é\U0001F600 *\x0bx\x0c", "w " * 8, "w " * 9, "  a  b  ", "x y\nx y\n\nx y "]
    for _ in range(60):
        text = "".join(rng.choice(["a", "b", "c"]) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randrange(60)))
        texts.append(text + " " + text[:40])
    texts.append(" ".join(str(i % 4999) for i in range(20_000)))
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in measures(df).collect():
        assert tuple(r)[3:] == plain(texts[r.doc_id]), texts[r.doc_id]


def test_buckets_are_narrow_and_ordered(spark):
    values = sorted({*range(300), *(int(1.07 ** k) for k in range(1, 300))})
    got = dict(spark.createDataFrame([(v,) for v in values], "v long").select("v", bucket_of("v")).collect())
    assert [got[v] for v in values] == sorted(got[v] for v in values)
    edges = {}
    for v in values:
        edges.setdefault(got[v], []).append(v)
    assert all(max(vs) - min(vs) <= max(min(vs) // 32, 0) for vs in edges.values())


def test_merged_sketches_equal_the_sketch_of_all(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f"l{i % 2}", f"s{i % 5}", int(a), int(b), int(c), 0, int(d), 9) for i, (a, b, c, d) in enumerate(rng.integers(1, 5000, (2000, 4)))]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    key = ["rule", "bucket"]
    merged = sorted(map(tuple, merge(merge(sketch(df, ["lang", "source"]), ["lang"]), []).select(*key, "n").collect()))
    assert merged == sorted(map(tuple, sketch(df.repartition(7), []).select(*key, "n").collect()))
    near = {r.rule: r for r in quartiles(sketch(df, []), []).collect()}
    for rule in RULES:
        exact = np.array(sorted(rule.scale * r[{"n_words": 3, "word_chars": 4, "n_symbols": 5, "n_dup_lines": 6, "n_repeat_words": 7}[rule.top]]
                                // r[{"n_words": 3, "word_chars": 4, "n_lines": 8}[rule.bottom]] for r in rows))
        lo, hi = exact[len(exact) // 4 - 1], exact[-(-3 * len(exact) // 4) - 1]
        assert lo - lo / 32 - 1 <= near[rule.name].q1 <= lo and hi <= near[rule.name].q3 <= hi + hi / 32 + 1


def test_fences_follow_language_and_source(spark):
    def doc(i, source, word, extra=""):
        return (i, " ".join(f"{word}{(i * 37 + k) % 101}" for k in range(30)) + extra, "en", source, 0)
    # one source writes symbols in every word, the other never
    rows = [doc(i, "code", "a#&") for i in range(120)] + [doc(1000 + i, "prose", "wo") for i in range(120)]
    rows += [doc(5000, "prose", "a#&"), doc(5001, "code", "a#&"), doc(5002, "few", "wo"), doc(5003, "prose", "wo", " #"), doc(5004, None, "wo")]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SHAPE), Scratch(spark, "t-quality")).collect()}
    assert not got[5000].kept and "symbol_share" in got[5000].failed
    assert got[5001].kept and got[5002].kept and got[5003].kept and got[5004].kept
    assert sum(r.kept for r in got.values()) == len(rows) - 1


def test_few_documents_have_no_fence(spark):
    q = quartiles(sketch(spark.createDataFrame([(1, 50, 9000)], "n_lines long, n_words long, word_chars long").selectExpr(
        "*", "0L n_symbols", "0L n_dup_lines", "0L n_repeat_words"), []), [])
    assert all(v is None for v in fences(q, [], 4, 100).first())


def test_edge_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", None, 0), (None, "a " * 40, None, "s", 1), (3, "w" * 500_000, "en", "s", 1)]
    spark.createDataFrame(rows, SHAPE).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(7)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_quality_rules(spark, str(tmp_path)).collect()
    assert len(got) == 5 and all(r.base_failed and not r.kept for r in got)
    assert [r.word_chars for r in got if r.doc_id == 3] == [500_000]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_quality_rules(spark, str(tmp_path)).count() == 0
