"""A corpus pipeline of five training-data operators.

STAGES lists them in order; each function takes (spark, docs, sf_dir), works on
all that its predecessor kept and returns a DataFrame.  All but the last return
the columns of documents.  run() applies them to the documents of sf_dir, each
result written as Parquet and read again, so a lost executor never sets the
pipeline back by more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveywave.llm.common import Scratch, keep_rows
from surveywave.llm.exact_dedup import exact_dedup
from surveywave.llm.langid import identify, train
from surveywave.llm.minhash_dedup import minhash_dedup
from surveywave.llm.mixing import mix_documents
from surveywave.llm.packing import pack_documents

# Language ID, MinHash and the drawing of a mix have no SQL form.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like one of the labelled languages: the share of
    their grams that the fitted model knows is at least half of what is usual in
    its sample.  Letter noise, texts in other scripts, NULL texts and texts
    without a letter go.  Short texts have low scores, so a score rejects
    nothing.  Where no row could be learned from, every text with a letter stays."""
    known = identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                                 F.col("doc_id"), F.col("text")), train(docs), carry=["doc", "doc_id"], decide=True)
    return known.where("recognised").select("doc.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the least doc_id."""
    return keep_rows(docs, exact_dedup(docs, Scratch(spark, "stage-exact")).where("kept"))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the least doc_id."""
    return keep_rows(docs, minhash_dedup(docs, Scratch(spark, "stage-minhash")).where("kept"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each draw of the mix, up to three of a document, whole and in
    shuffled order.  NULL texts and texts without words are never drawn; a source
    that is NULL is a source of its own.  No documents give no rows."""
    return mix_documents(docs, Scratch(spark, "stage-mixing"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their token ids; a draw of a document is packed as a
    document.  A NULL text is its end id alone.  No documents give no pieces."""
    import public_tokenizers
    return pack_documents(docs, Scratch(spark, "stage-packing"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_stage), ("exact_dedup", exact_stage), ("minhash_dedup", minhash_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
