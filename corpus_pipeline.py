"""Corpus preparation: quality rules, near-duplicate removal, benchmark decontamination,
secret masking and byte-level BPE, each an operator of ``quayside.llm``, over documents.

Every stage works on all rows its predecessor kept and returns the columns it was given, but
for the last, which returns the token digests.  SQL cannot express the near-duplicate stage
(hashed sampling, components) or BPE, so the pipeline has no oracle; tests hold each stage
against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bpe, catalog, minhash, rules, secret_scan, winnow
from quayside.session import ensure_checkpoint_dir, shared_scratch
from quayside.sources.tables import table_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: documents that the rules reject go."""
    return rules.judge(docs, out="_judged").where("_judged.kept").drop("_judged")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4: one document of each class of near duplicates stays, that of the least id."""
    return minhash.deduplicate(docs, idf="full")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: documents with at least a twentieth of their words in benchmark passages go."""
    judged = winnow.decontaminate(docs, catalog.table(spark, sf_dir, "benchmark"), out="_judged")
    return judged.where("NOT _judged.contaminated").drop("_judged")


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 6: secrets are masked in the text; ``n_chars`` follows where the column is there."""
    masked = secret_scan.redact(secret_scan.scan(docs, out="_spans"), spans="_spans")
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(
            F.size("_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: the kept texts as token ids; digests of the ids and of the decoded bytes."""
    return bpe.op8(docs, public_tokenizers.path(catalog.BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("secret_masking", secret_masking),
          ("byte_bpe", byte_bpe)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents, each written as Parquet and reread by the next."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        folder = shared_scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
