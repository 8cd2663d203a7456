"""op5: quality classifier by supervised subword embeddings.

A text is a bag of tokens: its words and every run of 3 to 5 characters (code points; blanks mark
word borders).  Tokens are hashed to ``BUCKETS`` learned vectors, which are averaged over the
text; a softmax layer gives the two classes.  Vectors and layer are trained by stochastic gradient
descent in numpy, inside one task over a bounded sample.

One token is an addition to the method: each 3-word window that has occurred before in the text
gives ``AGAIN``, as an average of n-grams can't tell a text from one that repeats itself.

The softmax of two classes depends on the difference of their outputs only, and that is linear
in the averaged vector; so scoring needs one number a bucket, its vector's share of that
difference.  This table (``BUCKETS`` floats) is all that goes to the tasks.

Labelled rows beyond ``SAMPLE_ROWS`` (those of least hash are taken) are not used; every text is
scored whole.  A null or empty text has no tokens and gets the score of the bias alone; without
labels of both kinds nothing is learned and every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DoubleType, StructField, StructType)

from quayside.llm import batches as B
from quayside.session import shared_scratch

BITS = 18
BUCKETS = 1 << BITS
DIMENSIONS = 8
EPOCHS, RATE, DECAY = 8, 1.0, 1e-6
SAMPLE_ROWS = 3_000
GRAMS = (3, 4, 5)
AGAIN = np.uint64(0xA6A1)  # the token of a repeated window
MIX = np.uint64(0x100000001B3)  # odd factor of the characters' running hash
TOKEN_STEP = 30  # a token's share of a text is small: its vector takes so many steps, one at most

REPORT = StructType([StructField("score", DoubleType())])


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of every token of the texts, one kind of token at a time."""
    raw, offsets = B.utf8(column)
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    starts, ends, bounds = B.word_spans(raw, offsets, B.NOT_BLANK)
    words = B.span_hashes(raw, starts, ends)
    rows = B.row_of(bounds)
    yield _bucket(words), rows
    windows = B.window_hashes(words, 3)
    if len(windows):
        inside = rows[:-2] == rows[2:]
        again = pd.Series(B.mix(windows + rows[:-2].astype(np.uint64))).duplicated().to_numpy()
        at = rows[:-2][inside & again]
        yield _bucket(np.full(len(at), AGAIN)), at
    code, row = characters(raw, row)
    for n in GRAMS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        gram = code[:size].copy()
        for k in range(1, n):
            gram = gram * MIX + code[k:size + k]
        inside = row[:size] == row[n - 1:]
        yield _bucket(gram[inside] * MIX + np.uint64(n)), row[:size][inside]


def characters(raw: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point, row) of the characters of valid UTF-8 bytes."""
    starts = np.flatnonzero(raw & 0xC0 != 0x80)
    lead = raw[starts].astype(np.uint64)
    code = lead.copy()
    padded = np.append(raw & 0x3F, np.zeros(3, np.uint8)).astype(np.uint64)
    for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero(lead >= least)
        value = lead[at] & np.uint64(mask)
        for k in range(1, more + 1):
            value = value << np.uint64(6) | padded[starts[at] + k]
        code[at] = value
    return code, row[starts]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct buckets and their shares of the text's tokens."""
    parts = [*tokens(column)]
    keys = np.concatenate([row * BUCKETS + bucket for bucket, row in parts])
    distinct, counts = np.unique(keys, return_counts=True)
    borders = np.searchsorted(distinct, np.arange(len(column) + 1) * BUCKETS)
    out = []
    for a, b in zip(borders[:-1], borders[1:]):
        share = counts[a:b] / max(counts[a:b].sum(), 1)
        out.append(((distinct[a:b] % BUCKETS).astype(np.int32), share.astype(np.float32)))
    return out


def descend(examples: list, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Train vectors and softmax layer; per bucket its share of the output difference."""
    rng = np.random.default_rng(5)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    vectors = vectors.astype(np.float32)
    layer = rng.uniform(-1, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    weight = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(examples)):
            ids, share = examples[k]
            rate = np.float32(RATE * (1 - step / steps) * min(weight[labels[k]], 4))
            step += 1
            held = vectors[ids]
            mean = share @ held
            output = mean @ layer + bias
            p = np.exp(output - output.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= np.float32(0.1) * rate * p
            pull = rate * np.minimum(np.float32(TOKEN_STEP) * share, np.float32(1))
            vectors[ids] = held * (1 - np.float32(DECAY)) - np.outer(pull, back)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def train(spark: SparkSession, labelled: DataFrame, *, text: str = "text", label: str = "label",
          rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Learn from texts with labels 0 and 1 (at most ``rows`` distinct texts, in one task)."""
    folder = shared_scratch(spark, "classifier")
    words = F.coalesce(F.col(text), F.lit(""))
    given = labelled.where(F.col(label).isin(0, 1)).select(
        F.xxhash64(words).alias("key"), words.alias("text"),
        F.col(label).cast("int").alias("label"))
    # Chosen by hash, so that only chosen texts (``rows`` of them) are sorted.
    chosen = given.select("key").distinct().orderBy("key").limit(rows)
    sample = (given.join(F.broadcast(chosen), "key")
              .groupBy("key").agg(F.min("text").alias("text"), F.max("label").alias("label")))

    def run(batches):
        examples, labels = [], []
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                examples += bags(piece.column("text"))
                labels += piece.column("label").to_pylist()
        if len(set(labels)) == 2:
            table, bias = descend(examples, np.array(labels))
            yield pa.RecordBatch.from_arrays(
                [pa.array([table.astype("<f4").tobytes()], pa.binary()), pa.array([bias])],
                ["shares", "bias"])

    kind = StructType([StructField("shares", BinaryType()), StructField("bias", DoubleType())])
    (sample.repartition(1).sortWithinPartitions("key").select("text", "label")
     .mapInArrow(run, kind).write.parquet(folder))
    found = spark.read.schema(kind).parquet(folder).collect()
    if not found:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(found[0]["shares"], "<f4"), found[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], *, text: str = "text",
          out: str = "quality_score") -> DataFrame:
    """``docs`` with a struct ``out`` holding score, the probability of label 1."""
    table, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))  # 1 MB

    def judge(piece: pa.RecordBatch) -> pa.Array:
        n = piece.num_rows
        total, count = np.zeros(n), np.zeros(n)
        for bucket, row in tokens(piece.column(text)):
            total += np.bincount(row, shared.value[bucket], n)
            count += np.bincount(row, minlength=n)
        scores = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
        return pa.StructArray.from_arrays([pa.array(scores)], ["score"])

    return B.annotate(docs, out, REPORT, text, judge)


def op5(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: learn outside the held-out third, score every document."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    marked = labels.where(~held_out & F.col("quality").isNotNull()).select(
        "doc_id", F.col("quality").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    model = train(spark, docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    value = F.col("quality_score.score")
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), value.alias("score"),
        (value >= 0.5).cast("int").alias("predicted"))
