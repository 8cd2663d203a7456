"""op2: toxicity by a weighted lexicon over folded text.

Folding lower-cases, strips accents and compatibility forms, maps look-alike letters and the
digits and signs that stand for letters, and takes ``i``, ``l``, ``1``, ``!`` and ``|`` as one
letter, so that disguised spellings of a term meet its one folded form.

The lexicon is learned from labelled rows: folded words that toxic documents hold far more
often than others, with their log-odds as weights.  A term must stand between several different
neighbours, so words of a text that merely has many copies don't count.  Exception phrases are
two-word phrases with a term that are no sign of toxicity; a hit inside one doesn't count.

All terms and phrases are matched at once by an Aho-Corasick automaton.  A text's features are
the weight of its hits and that weight by its length in words; a logistic curve fitted to the
labelled rows maps them to a score.

Labelled rows beyond ``SAMPLE_ROWS`` (those of least hash are taken) are not used, which bounds
the training and, as a term or phrase needs ``MIN_DOCS`` of them, the lexicon; every document is scored whole.  A null or empty text has no hits and gets the
score of that; without labels of both kinds nothing is learned and every score is 0.5.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField,
                               StructType)

from quayside.llm import batches as B
from quayside.session import shared_scratch

SAMPLE_ROWS = 20_000
MIN_DOCS, MIN_NEIGHBOURS, MIN_ODDS = 5, 4, 2.0

# Letters of other scripts and signs that look like Latin letters.
LOOK_ALIKES = dict(zip("абвгеёзикмнорстухьіѕјԁɡαβεηικνορτυχω", "a6bregeukmhopctyxbisjdgabenikvoptuxw"))
DIGITS = dict(zip("013456789", "oleasbtbg"))
SIGNS = dict(zip("@$!|", "asii"))
ONE_LETTER = {"l": "i"}


def _folds() -> dict[int, str]:
    table: dict[int, str] = {}
    for low, high in ((0x41, 0x5B), (0xC0, 0x250), (0x391, 0x530), (0x1E00, 0x1F00),
                      (0xFF21, 0xFF5B), (0x1D400, 0x1D7FF)):
        for code in range(low, high):
            base = unicodedata.normalize("NFKD", chr(code))
            base = "".join(c for c in base if not unicodedata.combining(c)).lower()
            table[code] = "".join(LOOK_ALIKES.get(c, c) for c in base) or chr(code)
    for c, to in (*LOOK_ALIKES.items(), *DIGITS.items(), *SIGNS.items(), *ONE_LETTER.items()):
        table[ord(c)] = to
    for code, to in table.items():
        table[code] = "".join(ONE_LETTER.get(c, c) for c in to)
    for code in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF):
        table[code] = ""
    return table


FOLDS = _folds()
_signs = re.compile(r"[@$!|]+(?![^\W_])")
_digits_alone = re.compile(r"(?<![^\W_])\d+(?![^\W_])")
_has_sign = re.compile(r"[@$!|]")
_word = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """The folded text; signs fold only where a letter follows, numbers alone stay out."""
    if _has_sign.search(text):
        text = _signs.sub(" ", text)
    return _digits_alone.sub(" ", text).translate(FOLDS)


@dataclass
class Lexicon:
    """What is learned: weights of terms, excusing phrases, and the curve's coefficients."""

    terms: dict[str, float] = field(default_factory=dict)
    phrases: list[str] = field(default_factory=list)
    curve: tuple[float, ...] = (0.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (term, weight))
        for phrase in self.phrases:
            found.add_word(phrase, (phrase, None))
        if len(found):
            found.make_automaton()
        return found


def hits(automaton, folded: str) -> list[tuple[str, float]]:
    """Terms found as whole words outside of exception phrases, with their weights."""
    if not len(automaton):
        return []
    found, excused = [], []
    for end, (word, weight) in automaton.iter(folded):
        start = end - len(word) + 1
        if (start and folded[start - 1].isalnum()) or (
                end + 1 < len(folded) and folded[end + 1].isalnum()):
            continue
        if weight is None:
            excused.append((start, end))
        else:
            found.append((start, end, word, weight))
    if excused:
        cover = np.array(excused)
        found = [f for f in found if not ((cover[:, 0] <= f[0]) & (f[1] <= cover[:, 1])).any()]
    return [(word, weight) for _, _, word, weight in found]


def features(total, n_words):
    """The weight of the hits, and that weight by length."""
    return np.stack([np.ones(len(total)), np.log1p(total),
                     np.log1p(100 * total / np.maximum(n_words, 1))], axis=1)


REPORT = StructType([
    StructField("score", DoubleType()), StructField("weight", DoubleType()),
    StructField("n_words", LongType()), StructField("terms", ArrayType(StringType()))])


def score(docs: DataFrame, lexicon: Lexicon, *, text: str = "text",
          out: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``out``: score, weight, n_words, terms (hits in text order)."""
    curve = np.array(lexicon.curve)
    made: list = []

    def judge(piece: pa.RecordBatch) -> pa.Array:
        if not made:
            made.append(lexicon.automaton())
        weights, sizes, terms = [], [], []
        for t in pc.fill_null(piece.column(text), "").to_pylist():
            folded = fold(t)
            found = hits(made[0], folded)
            weights.append(sum(w for _, w in found))
            sizes.append(len(folded.split()))
            terms.append([t for t, _ in found])
        total, n_words = np.array(weights, float), np.array(sizes, np.int64)
        scores = 1 / (1 + np.exp(-features(total, n_words) @ curve))
        return pa.StructArray.from_arrays(
            [pa.array(scores), pa.array(total), pa.array(n_words),
             pa.array(terms, pa.list_(pa.string()))], [f.name for f in REPORT.fields])

    return B.annotate(docs, out, REPORT, text, judge)


def word_rows(sample: DataFrame) -> DataFrame:
    """(term, before, after, label) for each distinct folded word of each text."""
    kind = "term string, before string, after string, label int"

    def run(batches):
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                out: list[tuple] = []
                for t, label in zip(piece.column("text").to_pylist(),
                                    piece.column("label").to_pylist()):
                    words = ["", *_word.findall(fold(t or "")), ""]
                    first: dict[str, int] = {}
                    for k in range(1, len(words) - 1):
                        first.setdefault(words[k], k)
                    out += [(w, words[k - 1], words[k + 1], label) for w, k in first.items()]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in list(zip(*out))[:3]]
                        + [pa.array([r[3] for r in out], pa.int32())],
                        ["term", "before", "after", "label"])

    return sample.mapInArrow(run, kind)


def _log_odds(hit, clean, n_hit: int, n_clean: int):
    return F.log((hit + 0.5) / (n_hit + 1)) - F.log((clean + 0.5) / (n_clean + 1))


def train(spark: SparkSession, labelled: DataFrame, *, text: str = "text", label: str = "label",
          rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn a lexicon from texts with labels 0 and 1 (at most ``rows`` distinct texts)."""
    folder = shared_scratch(spark, "toxicity-sample")
    given = (labelled.where(F.col(label).isin(0, 1) & F.col(text).isNotNull())
             .select(F.xxhash64(text).alias("key"), F.col(text).alias("text"),
                     F.col(label).cast("int").alias("label")))
    # Chosen by hash, so that no task sorts texts; the chosen ones (``rows`` longs) find them.
    chosen = given.select("key").distinct().orderBy("key").limit(rows)
    (given.join(F.broadcast(chosen), "key")
     .groupBy("key").agg(F.min("text").alias("text"), F.max("label").alias("label"))
     .select("text", "label").repartition(8).write.parquet(folder))
    sample = spark.read.schema("text string, label int").parquet(folder)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_hit, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_hit or not n_clean:
        return Lexicon()
    words = word_rows(sample)
    stats = (words.groupBy("term").agg(F.sum("label").alias("hit"),
                                       F.sum(1 - F.col("label")).alias("clean"))
             .withColumn("weight", _log_odds(F.col("hit"), F.col("clean"), n_hit, n_clean))
             .where((F.col("hit") >= MIN_DOCS) & (F.col("weight") >= MIN_ODDS)))
    near = words.join(stats, "term")
    spread = (near.where("label = 1").groupBy("term", "before", "after").count()
              .groupBy("term").agg(F.count("*").alias("neighbours")))
    chosen = (stats.join(spread, "term")
              .where((F.col("neighbours") >= MIN_NEIGHBOURS)
                     & (F.col("neighbours") * 4 >= F.col("hit")))
              .select("term", "weight").collect())
    terms = {r["term"]: r["weight"] for r in chosen}
    phrases = (
        near.select("label", F.explode(F.array(F.concat_ws(" ", "before", "term"),
                                               F.concat_ws(" ", "term", "after"))).alias("phrase"))
        .where(F.instr(F.trim("phrase"), " ") > 0)
        .groupBy("phrase").agg(F.sum("label").alias("hit"),
                               F.sum(1 - F.col("label")).alias("clean"))
        .where((F.col("clean") >= MIN_DOCS)
               & (_log_odds(F.col("hit"), F.col("clean"), n_hit, n_clean) <= 0)).collect())
    lexicon = Lexicon(terms, sorted(r["phrase"] for r in phrases
                                    if any(w in terms for w in r["phrase"].split(" "))))
    seen = score(sample, lexicon).select("toxicity.weight", "toxicity.n_words", "label").toPandas()
    lexicon.curve = logistic(features(seen["weight"].to_numpy(), seen["n_words"].to_numpy()),
                             seen["label"].to_numpy(float))
    return lexicon


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Coefficients of a logistic curve by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ beta))
        slope = x.T @ (y - p) - ridge * beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        beta = beta + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def op2(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns: learn outside the held-out fifth, score every document."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    marked = labels.where(~held_out & F.col("toxic").isNotNull()).select(
        "doc_id", F.col("toxic").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    lexicon = train(spark, docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    scored = score(docs.select("doc_id", "text"), lexicon)
    value = F.col("toxicity.score")
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                         value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
