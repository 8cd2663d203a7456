"""One registered query per operator, over its whole table, with its SQL where there is one."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import (bpe, classifier, frames, minhash, oracles, pages, prefix_trie, rules,
                          secret_scan, substring, toxicity, warc, whitening, winnow)
from quayside.session import ensure_checkpoint_dir
from quayside.sources.tables import table_path

Builder = Callable[[SparkSession, str], DataFrame]

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"

QUERIES: dict[str, Builder] = {}


def query(fn: Builder) -> Builder:
    """Register ``fn`` under its name; the shared folder is known before it runs."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@query
def op1_winnow_decontamination(spark, sf_dir):
    return winnow.op1(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_toxicity(spark, sf_dir):
    return toxicity.op2(spark, table(spark, sf_dir, "documents"),
                        table(spark, sf_dir, "labels"))


@query
def op3_quality_rules(spark, sf_dir):
    return rules.op3(table(spark, sf_dir, "documents"))


@query
def op4_near_duplicates(spark, sf_dir):
    return minhash.op4(table(spark, sf_dir, "documents"), idf="full")


@query
def op5_quality_classifier(spark, sf_dir):
    return classifier.op5(spark, table(spark, sf_dir, "documents"),
                          table(spark, sf_dir, "labels"))


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.op6(table(spark, sf_dir, "documents"))


@query
def op7_main_text(spark, sf_dir):
    return pages.op7(table(spark, sf_dir, "pages"))


@query
def op8_byte_bpe(spark, sf_dir):
    return bpe.op8(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_RANKS),
                   public_tokenizers.PATTERN)


@query
def op9_token_frames(spark, sf_dir):
    return frames.op9(spark, table(spark, sf_dir, "documents"),
                      public_tokenizers.path(WORD_BPE))


@query
def op10_repeated_substrings(spark, sf_dir):
    return substring.op10(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.op11(table(spark, sf_dir, "embeddings"))


@query
def op12_conversation_trie(spark, sf_dir):
    return prefix_trie.op12(table(spark, sf_dir, "conversations"))


@query
def op13_warc(spark, sf_dir):
    return warc.op13(spark, table(spark, sf_dir, "pages"))


ORACLES = oracles.SQL
