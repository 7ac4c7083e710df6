"""The registered queries of the package: each applies one operator, with
production parameters, to its whole table and returns the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch
from .oracle import OP10_SQL, OP11_SQL, OP12_SQL, OP13_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup
    out = exact_dedup(_table(spark, sf_dir, "documents"), Scratch(spark, "op10"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import embedding_dedup
    return embedding_dedup(_table(spark, sf_dir, "embeddings"), Scratch(spark, "op1"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_report
    out = mix_report(_table(spark, sf_dir, "documents"), Scratch(spark, "op2"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "draws")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, train
    docs = _table(spark, sf_dir, "documents")
    out = identify(docs, train(docs), carry=["doc_id"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(_table(spark, sf_dir, "documents"), Scratch(spark, "op5"), path, with_ids=False)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash_dedup import minhash_dedup
    out = minhash_dedup(_table(spark, sf_dir, "documents"), Scratch(spark, "op3"))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score_documents
    return score_documents(_table(spark, sf_dir, "documents"), Scratch(spark, "op6"), words=True)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_conversations, read_back
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(turns.unionByName(extra), Scratch(spark, "op7")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_records, read_archives, resolve_revisits, write_archives
    scratch = Scratch(spark, "op8")
    path = scratch.path("archives")
    write_archives(archive_records(_table(spark, sf_dir, "pages"), scratch), path)
    read = scratch.table(read_archives(spark, path), "read")
    return resolve_revisits(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_main_text
    return extract_main_text(_table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import as_hex, build_manifest, leaf_digest, proof_text, proofs, verify
    scratch = Scratch(spark, "op11")
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", leaf_digest([F.col(f) for f in fields]).alias("leaf"),
                       leaf_digest([*[F.col(f) for f in fields[:-1]], tampered]).alias("seen"))
    found = verify(proofs(build_manifest(scratch.table(rows, "rows"), scratch), scratch), scratch, "seen")
    return found.select("doc_id", *[as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                        F.sha2(proof_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
                        as_hex(F.col("folded_root")).alias("folded_root"), "verified")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import quality_rules
    out = quality_rules(_table(spark, sf_dir, "documents"), Scratch(spark, "op12"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, repair_report
    scratch = Scratch(spark, "op13")
    turns = _table(spark, sf_dir, "conversations")
    found = repair_report(damaged(turns), scratch)
    every = turns.select(F.col("conv_id").alias("_id")).distinct()
    # conversations that lost all their rows have nothing to report
    out = every.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES = {"op6_lm_score": op6_lm_score, "op1_embedding_dedup": op1_embedding_dedup, "op7_chat": op7_chat, "op9_html_text": op9_html_text, "op8_warc": op8_warc, "op4_language_id": op4_language_id, "op5_packing": op5_packing, "op2_mixing": op2_mixing, "op3_minhash_dedup": op3_minhash_dedup, "op10_exact_dedup": op10_exact_dedup,
           "op11_merkle_manifest": op11_merkle_manifest, "op12_quality_rules": op12_quality_rules, "op13_structure_repair": op13_structure_repair}
ORACLE = {"op10_exact_dedup": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_quality_rules": OP12_SQL, "op13_structure_repair": OP13_SQL}
