import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surveywave.llm import queries
from surveywave.llm.common import Scratch
from surveywave.llm.merkle import as_hex, build_manifest, folded, leaf_digest, proof_text, proofs

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text=None):
    doc_id, own, lang, source, n = row
    return sha("".join(map(enc, (doc_id, source, lang, n, own if text is None else text))))


def tree(digests):
    """The root and, for each leaf, its siblings' digests level by level."""
    levels, paths = [list(digests)], [[] for _ in digests]
    while len(levels[-1]) > 1:
        cur = levels[-1]
        levels.append([sha("".join(cur[i:i + 3])) for i in range(0, len(cur), 3)])
    for k in range(len(digests)):
        at = k
        for level in levels[:-1]:
            first = at // 3 * 3
            paths[k].append((level[first:at], level[at + 1:first + 3]))
            at //= 3
    return levels[-1][0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        inner[s] = (own, *tree([leaf_of(r) for r in own]))
    root, tops = tree([inner[s][1] for s in names])
    out = []
    for s, top in zip(names, tops):
        own, subroot, paths = inner[s]
        for r, path in zip(own, paths):
            path = path + top
            seen = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and seen is not None:
                seen = seen.replace("\n", "")
            fold = leaf_of(r, seen)
            for left, right in path:
                fold = sha("".join(left) + fold + "".join(right))
            proof = sha("".join("".join(a) + "".join(b) for a, b in path))
            out.append((r[0], leaf_of(r), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def answer(spark, tmp_path, rows):
    spark.createDataFrame(rows, SHAPE).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_merkle_manifest(spark, str(tmp_path))
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.select(*cols).collect()), key=str)


def test_against_a_tree_in_memory(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a\nb", "é\n", "x" * 50, "", None]), rng.choice(["en", None]), rng.choice(["s1", "s1", "s1", "é", "Z", "", None]), i % 7)
            for i in range(130)]
    rows += [rows[5], rows[5], (None, "t\n", None, "s1", None), (None, None, None, None, None), (7, "other\ntext", "en", "s1", 2)]
    assert answer(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10])
def test_small_trees(spark, tmp_path, n):
    rows = [(i, "a\n" * i, "en", "s", 1) for i in range(n)]
    assert answer(spark, tmp_path, rows) == brute(rows)


def test_many_equal_rows_and_a_long_text(spark, tmp_path):
    rows = [(1, "same\n", "en", "hot", 5)] * 70 + [(2, "long\n" * 200_000, "en", "hot", 1_000_000)]
    assert answer(spark, tmp_path, rows) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert answer(spark, tmp_path, []) == []


def test_requests_descend_only_where_asked(spark):
    rows = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 4).cast("string").alias("source"), F.lit("note").alias("digest"),
                                   leaf_digest([F.col("id")]).alias("leaf"))
    manifest = build_manifest(rows, Scratch(spark, "t-merkle"))
    every = {r.doc_id: r for r in proofs(manifest, Scratch(spark, "t-merkle")).collect()}
    asked = manifest.leaves.where("doc_id in (0, 41, 99)").select("group_rank", "rank")
    some = proofs(manifest, Scratch(spark, "t-merkle"), asked).collect()
    assert {r.doc_id for r in some} == {0, 41, 99}
    assert all(r.proof == every[r.doc_id].proof and r.digest == "note" for r in some)


def test_the_store_is_content_addressed(spark):
    same = spark.range(12).select(F.lit(1).alias("doc_id"), F.lit("s").alias("source"), leaf_digest([F.lit("x")]).alias("leaf"))
    manifest = build_manifest(same, Scratch(spark, "t-merkle"))
    # 12 equal leaves: four equal runs are one record, then a run of three and a run of one, then the root
    assert manifest.records().count() == 4
    got = proofs(manifest, Scratch(spark, "t-merkle")).select(as_hex(folded(F.col("leaf"), F.col("proof"))).alias("f"), as_hex(F.col("root")).alias("r"),
                                                              F.length(proof_text(F.col("proof"))).alias("n"))
    assert all(r.f == r.r for r in got.collect())
    assert sorted(r.n // 64 for r in got.collect()) == [3] * 3 + [5] * 9


def test_a_descent_meets_by_merges_whatever_the_sizes(spark):
    """Paths are small in files and large in memory: no size check may broadcast them."""
    rows = spark.createDataFrame([(k, f"s{k % 2}", bytes([k])) for k in range(40)], "doc_id long, source string, leaf binary")
    scratch = Scratch(spark, "t")
    found = proofs(build_manifest(rows, scratch), scratch).select("proof", "leaf")
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "HashJoin" in x]
    assert "SortMergeJoin" in plan and not any("digest" in x or "lone" in x for x in joins)
