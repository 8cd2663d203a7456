"""op1: benchmark decontamination by winnowing.

Words are runs of ASCII letters and digits (A-Z folded) and of characters beyond ASCII.  An
item's windows are its runs of ``WINDOW`` consecutive words; an item of fewer words is one
window.  Both sides keep, in every ``w`` consecutive k-grams, the one of least hash; with
``k + w - 1`` equal to the window length, every shared window keeps the same k-gram on both
sides, so joining the two sets of fingerprints finds every shared window.  Each hit is then
extended over the words of its document, which settles what is shared exactly.

Short items get a (k, w) of their own length, and documents are fingerprinted for exactly the
lengths that occur among the items (at most ``WINDOW`` of them).

Results in the odd cases: a null or empty text has no words and is clean; items without words
or without an id are ignored; repeated item ids count once; documents that share an id, and
those with a null id, are judged each on its own text; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from quayside.llm import batches as B

WINDOW = 13
# Item fingerprints are broadcast up to this many rows (16 bytes each); more are joined by
# a shuffle.  The result is the same.
BROADCAST_ROWS = 1_000_000

REPORT = StructType([
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("n_items", LongType()), StructField("item_ids", ArrayType(StringType())),
    StructField("contaminated", BooleanType())])


def scheme(words: int) -> tuple[int, int]:
    """(k, w) for windows of so many words: k + w - 1 words are guaranteed."""
    k = (words + 1) // 2
    return k, words - k + 1


def selected(words: np.ndarray, bounds: np.ndarray, length: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """Winnowed k-grams for one window length: (word positions, hashes)."""
    k, w = scheme(length)
    grams = B.window_hashes(words, k, seed=length)
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = B.least_grams(grams, n, w)
    whole = np.ones(n, bool)  # windows that stay within one row
    for cut in bounds[1:-1]:
        whole[max(0, cut - length + 1):cut] = False
    kept = np.unique(at[whole])
    return kept, grams[kept]


def fingerprints(texts: DataFrame, key: str, text: str, lengths: list[int]) -> DataFrame:
    """(key, length, pos, hash) of the winnowed k-grams for each window length.

    For items, pass no lengths: each text then is fingerprinted for its own length only.
    """
    texts = texts.select(key, text)
    kind = StructType([texts.schema[key], StructField("length", LongType()),
                       StructField("pos", LongType()), StructField("hash", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, text):
                words, bounds = B.lowered_words(piece.column(text))
                sizes = np.diff(bounds)
                own = np.minimum(sizes, WINDOW)
                rows = B.row_of(bounds)
                for length in lengths or sorted(set(own[own > 0].tolist())):
                    at, hashes = selected(words, bounds, length)
                    row = rows[at]
                    if not lengths:
                        mine = own[row] == length
                        at, hashes, row = at[mine], hashes[mine], row[mine]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [piece.column(key).take(pa.array(row)),
                             pa.array(np.full(len(at), length)),
                             pa.array(at - bounds[row]), pa.array(hashes.view(np.int64))],
                            [key, "length", "pos", "hash"])

    return texts.mapInArrow(run, kind)


def shared_runs(doc: np.ndarray, item: np.ndarray, shifts) -> list[tuple[int, int]]:
    """Document word ranges covered by the item's windows along the given shifts."""
    least, found = min(WINDOW, len(item)), []
    for shift in shifts:
        low, high = max(0, -shift), min(len(item), len(doc) - shift)
        if high - low < least:
            continue
        same = np.zeros(high - low + 2, np.int8)
        same[1:-1] = doc[low + shift:high + shift] == item[low:high]
        edges = np.flatnonzero(np.diff(same))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= least:
                found.append((low + shift + int(a), low + shift + int(b)))
    return found


def candidates(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str,
               item_text: str, broadcast_rows: int) -> DataFrame:
    """Per document id the items it may share windows with: (item id, item text, shifts)."""
    items = items.where(F.col(item_id).isNotNull()).select(
        F.xxhash64(F.col(item_text)).alias("_item"), F.col(item_id).cast("string").alias("_name"),
        F.col(item_text).alias("_text"))
    marks = fingerprints(items, "_item", "_text", []).distinct()
    lengths = sorted(r[0] for r in marks.select("length").distinct().collect())  # 13 at most
    if not lengths:
        lengths = [WINDOW]
    marks = marks.withColumnRenamed("pos", "item_pos")
    if marks.limit(broadcast_rows + 1).count() <= broadcast_rows:
        marks = F.broadcast(marks)
    hits = (fingerprints(docs, doc_id, text, lengths).join(marks, ["length", "hash"])
            .select(F.col(doc_id).alias("_doc"), "_item",
                    (F.col("pos") - F.col("item_pos")).alias("_shift")))
    shifts = hits.groupBy("_doc", "_item").agg(F.collect_set("_shift").alias("_shifts"))
    texts = items.groupBy("_item", "_text").agg(F.collect_set("_name").alias("_names"))
    return (shifts.join(texts, "_item")
            .groupBy("_doc").agg(F.collect_list(
                F.struct("_names", "_text", "_shifts")).alias("_hits")))


def decontaminate(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  share: int = 20, out: str = "contamination",
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, n_items, item_ids, contaminated.

    ``contaminated`` when at least one word in ``share`` is hit.  ``item_ids`` are strings in
    string order.  An input column named like ``out`` is replaced; others pass through.
    """
    found = candidates(docs, items, doc_id, text, item_id, item_text, broadcast_rows)
    joined = docs.join(found, F.col(doc_id).eqNullSafe(F.col("_doc")), "left")

    def judge(piece: pa.RecordBatch) -> pa.Array:
        words, bounds = B.lowered_words(piece.column(text))
        n_words = np.diff(bounds)
        n_hit, names = np.zeros(len(n_words), np.int64), []
        hits = piece.column("_hits")
        for row in range(len(n_words)):
            named: set[str] = set()
            if hits[row].is_valid and n_words[row]:
                doc = words[bounds[row]:bounds[row + 1]]
                covered = np.zeros(len(doc), bool)
                for hit in hits[row].as_py():
                    item, _ = B.lowered_words(pa.array([hit["_text"]]))
                    runs = shared_runs(doc, item, hit["_shifts"])
                    for a, b in runs:
                        covered[a:b] = True
                    if runs:
                        named.update(hit["_names"])
                n_hit[row] = covered.sum()
            names.append(sorted(named))
        return pa.StructArray.from_arrays(
            [pa.array(n_words), pa.array(n_hit), pa.array([len(x) for x in names], pa.int64()),
             pa.array(names, pa.list_(pa.string())),
             pa.array((n_hit > 0) & (share * n_hit >= n_words))],
            fields=[pa.field(f.name, t) for f, t in zip(REPORT.fields, (
                pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_()))])

    return B.annotate(joined, out, REPORT, text, judge, drop=("_doc", "_hits"))


def op1(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns of ``decontaminate`` over documents and benchmark."""
    found = decontaminate(docs.select("doc_id", "text"), items.select("item_id", "text"))
    report = F.col("contamination")
    return found.select(
        "doc_id", report.n_words.alias("n_words"), report.n_hit.alias("n_hit"),
        report.n_items.alias("n_items"),
        F.sha2(F.concat_ws(",", report.item_ids), 256).alias("items_sha256"),
        report.contaminated.alias("contaminated"))
