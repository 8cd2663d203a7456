"""op10: words in repeated windows are removed, by FM-index shards.

Words are runs between ASCII blanks, unchanged; a window is ``WINDOW`` consecutive words of one
document.  Every word of a window that also starts earlier (in a smaller document id, or
earlier in the same document) is removed.

A window's anchor is its least ``GRAM``-gram by hash, so equal windows have equal anchors.
Consecutive windows with one anchor form a segment.  The steps:

1. anchors are counted over all documents; segments whose anchor occurs once hold no repeat;
2. equal segments are reduced to their first occurrence.  All windows of a later occurrence
   start earlier elsewhere, so they are removed; only first occurrences remain to be compared,
   and only where segments of different content share an anchor;
3. these are dealt by anchor to shards.  A shard is indexed (suffix order, wavelet matrix) and
   its segments are streamed through the index by backward search, which reports for each
   window the interval of its matches; the first of them decides.  Anchors with more than
   ``SHARED`` different segments, too many for one task, have the first occurrences of their
   windows found by a grouped minimum instead;
4. each document gets its repeated segments and drops their words.

Words are compared by 48 bits of their hashes, windows by 64, segments by 128 (their own hash
and their anchor's).

Results in the odd cases: a null or empty text has no words; a null id comes before all others;
rows that share an id are versions of one document, so equal windows at the same place keep
each other; fewer than ``WINDOW`` words are never a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quayside.llm import batches as B
from quayside.llm.fmindex import FMIndex, stream

WINDOW = 20
GRAM = 6
# Bits of the filter of repeated anchors; it only spares a shuffle, an exact join follows.
FILTER_BITS = 26
SHARED = 2_000
SHARD_WORDS = 1 << 20
ALL = (1 << (WINDOW - GRAM + 1)) - 1  # a segment has at most so many windows
NO_ID = -(1 << 63)
# Columns beside the caller's own; no caller should have them.
DOC, VERSION, MARKED_DOC, MARKED_VERSION, MARKS = (
    f"__repeats_{c}" for c in ("doc", "version", "marked_doc", "marked_version", "marks"))

REPORT = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()),
                     StructField("kept", StringType())])


@dataclass
class Segments:
    """Segments of some texts, in text order; ``start`` counts words over all texts."""

    words: np.ndarray
    bounds: np.ndarray
    row: np.ndarray
    start: np.ndarray
    size: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray

    @property
    def place(self) -> np.ndarray:
        return self.start - self.bounds[self.row]


def segments(words: np.ndarray, bounds: np.ndarray) -> Segments:
    n, rows = len(words) - WINDOW + 1, B.row_of(bounds)
    none = np.zeros(0, np.int64)
    if n <= 0:
        return Segments(words, bounds, none, none, none, none.view(np.uint64),
                        none.view(np.uint64))
    grams = B.window_hashes(words, GRAM, seed=GRAM)
    at = B.least_grams(grams, n, WINDOW - GRAM + 1)
    inside = np.flatnonzero(rows[:n] == rows[WINDOW - 1:])
    anchor, row = at[inside], rows[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    start = inside[first]
    size = np.diff(np.append(first, len(inside))) + WINDOW - 1
    return Segments(words, bounds, row[first], start, size, grams[anchor[first]],
                    B.run_hashes(words, start, start + size))


def segments_of(column: pa.Array) -> Segments:
    raw, offsets = B.utf8(column)
    starts, ends, bounds = B.word_spans(raw, offsets, B.NOT_BLANK)
    return segments(B.span_hashes(raw, starts, ends), bounds)


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """Anchors that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                anchors, times = np.unique(segments_of(piece.column("text")).anchor,
                                           return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors.view(np.int64)), pa.array(times)], ["anchor", "n"])

    return B.saved(docs.select("text").mapInArrow(run, "anchor long, n long")
                   .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
                   .select("anchor"), "repeated-anchors")


def anchor_filter(repeated: DataFrame) -> np.ndarray:
    """A fixed number of bits, set for the upper bits of the repeated anchors."""
    cell = F.shiftrightunsigned("anchor", 64 - FILTER_BITS)
    found = (repeated.select(F.shiftright(cell, 6).alias("word"),
                             F.expr("shiftleft(1L, cast(shiftrightunsigned(anchor, "
                                    f"{64 - FILTER_BITS}) & 63 AS INT))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def occurrences(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """(anchor, segment, doc, version, place): each document's first of each segment whose anchor
    is repeated."""
    spread = docs.sparkSession.sparkContext.broadcast(anchor_filter(repeated))  # 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                s = segments_of(piece.column("text"))
                cell = s.anchor >> np.uint64(64 - FILTER_BITS)
                bit = spread.value[(cell >> np.uint64(6)).astype(np.int64)] >> \
                    (cell & np.uint64(63)) & np.uint64(1)
                own = pd.Series(B.mix(s.hash + s.row.astype(np.uint64)))
                kept = np.flatnonzero((bit == 1) & ~own.duplicated().to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.anchor[kept].view(np.int64)), pa.array(s.hash[kept].view(np.int64)),
                     *(piece.column(c).take(pa.array(s.row[kept])) for c in ("doc", "version")),
                     pa.array(s.place[kept].astype(np.int32))],
                    ["anchor", "segment", "doc", "version", "place"])

    found = docs.mapInArrow(
        run, "anchor long, segment long, doc long, version long, place int")
    return B.saved(found.join(repeated, "anchor", "left_semi"), "occurrences")


def contents(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """The words (48 bits each) of the first occurrences ``firsts`` (anchor, segment, doc,
    version, place, shared), or the hashes of their windows where ``shared``."""
    wanted = firsts.groupBy("doc", "version").agg(F.collect_list(
        F.struct("place", "segment", "anchor", "shared")).alias("wanted"))
    joined = docs.join(wanted, ["doc", "version"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "text"):
                s = segments_of(piece.column("text"))
                lists = piece.column("wanted")
                want = lists.flatten()
                row = np.repeat(np.arange(piece.num_rows),
                                lists.value_lengths().to_numpy(zero_copy_only=False))
                # Places and rows of the segments are in order: look the wanted ones up.
                key = row * (1 << 32) + want.field("place").to_numpy()
                have = s.row * (1 << 32) + s.place
                at = np.minimum(np.searchsorted(have, key), max(0, len(have) - 1))
                if not len(have):
                    continue
                good = (have[at] == key) & (s.hash[at].view(np.int64)
                                            == want.field("segment").to_numpy())
                good = np.flatnonzero(good)
                at, want, row = at[good], want.take(pa.array(good)), row[good]
                shared = want.field("shared").to_numpy(zero_copy_only=False)
                size, start = s.size[at], s.start[at]
                packed = s.words[B.ragged(start, np.where(shared, 0, size))]
                packed = (packed >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6]
                windows = np.where(shared, size - WINDOW + 1, 0)
                places = B.ragged(start, windows)
                hashes = B.window_hashes(s.words, WINDOW)[places] if len(places) else \
                    np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [want.field("anchor"), want.field("segment"),
                     piece.column("doc").take(pa.array(row)), want.field("place"),
                     B.binary(packed.reshape(-1), np.where(shared, 0, 6 * size)),
                     pa.ListArray.from_arrays(
                         pa.array(np.concatenate([[0], np.cumsum(windows)]).astype(np.int32)),
                         pa.array(hashes.view(np.int64)))],
                    ["anchor", "segment", "doc", "place", "words", "windows"])

    return joined.mapInArrow(run, "anchor long, segment long, doc long, place int, "
                                  "words binary, windows array<long>")


def search(shard: pd.DataFrame) -> np.ndarray:
    """Per segment of a shard the windows (bits) that start earlier in another segment."""
    sizes = shard["words"].map(len).to_numpy(np.int64) // 6
    raw = np.frombuffer(b"".join(shard["words"]), np.uint8).reshape(-1, 6)
    words = np.zeros((len(raw), 8), np.uint8)
    words[:, :6] = raw
    _, dense = np.unique(words.view(np.uint64).reshape(-1), return_inverse=True)
    size = int(dense.max(initial=-1)) + 2
    # Each segment ends with the symbol 0.
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    text[B.ragged(starts, sizes)] = dense + 1
    _, doc = np.unique(shard["doc"].to_numpy(), return_inverse=True)
    order = np.full(len(text), np.iinfo(np.int64).max)
    own = np.repeat(doc * (1 << 32) + shard["place"].to_numpy(np.int64), sizes) \
        + B.ragged(np.zeros(len(sizes), np.int64), sizes)
    order[B.ragged(starts, sizes)] = own
    index = FMIndex(text, size, WINDOW)
    first = np.minimum.reduceat(order[index.suffixes], index.block_starts)
    masks = np.zeros(len(shard), np.int64)
    for run, place, low in stream(index, text, starts, sizes, WINDOW):
        earlier = first[index.block[low]] < order[place]
        masks[run[earlier]] |= 1 << (place - starts[run])[earlier]
    return masks


def shard_masks(parts: DataFrame, shard_words: int) -> DataFrame:
    """(anchor, segment, mask) by FM-index shards of whole anchors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, words = [], 0

        def flush(rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"anchor": rows["anchor"], "segment": rows["segment"],
                             "mask": search(rows)})

        for batch in batches:
            held.append(batch)
            words += int(batch["words"].map(len).sum()) // 6
            if words >= shard_words:
                rows = pd.concat(held, ignore_index=True)
                last = rows["anchor"] == rows["anchor"].iloc[-1]  # it may go on
                for part in _cut(rows[~last], shard_words):
                    yield flush(part)
                held = [rows[last]]
                words = int(rows[last]["words"].map(len).sum()) // 6
        if held and sum(map(len, held)):
            for part in _cut(pd.concat(held, ignore_index=True), shard_words):
                yield flush(part)

    dealt = parts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "segment", "doc", "place", "words").mapInPandas(
        run, "anchor long, segment long, mask long")


def _cut(rows: pd.DataFrame, shard_words: int) -> Iterator[pd.DataFrame]:
    """Rows (sorted by anchor) in parts of about a shard's size, anchors whole."""
    ends = rows["words"].map(len).cumsum().to_numpy() // 6 // shard_words
    anchors = rows["anchor"].to_numpy()
    first = np.searchsorted(anchors, anchors) if len(rows) else np.zeros(0, np.int64)
    part = ends[first] if len(rows) else ends
    for _, group in rows.groupby(part, sort=True):
        yield group.reset_index(drop=True)


def window_masks(parts: DataFrame) -> DataFrame:
    """(anchor, segment, mask) by the first occurrence of each window hash."""
    windows = parts.select("anchor", "segment", "doc", "place",
                           F.posexplode("windows").alias("k", "window"))
    here = F.struct("doc", (F.col("place") + F.col("k")).alias("at"))
    windows = windows.select("anchor", "segment", "k", "window", here.alias("here"))
    # Written, so that the join deals out both sides itself and can split a window that many
    # segments share.
    first = B.saved(windows.groupBy("window").agg(F.min("here").alias("first")), "first-windows")
    return (windows.join(first, "window").where("first < here")
            .groupBy("anchor", "segment").agg(F.expr("bit_or(shiftleft(1L, k))").alias("mask")))


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                   out: str = "repeats", shared_segments: int = SHARED,
                   shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_removed, kept (words joined by a space).

    An input column named like ``out`` is replaced; the others pass through.
    """
    # Rows are met by id and text, so that rows without an id (one document by the order of
    # documents) do not share one list of marks.
    own = docs.drop(out).withColumns({DOC: F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)),
                                      VERSION: F.xxhash64(F.col(text))})
    keyed = own.select(F.col(DOC).alias("doc"), F.col(VERSION).alias("version"),
                       F.col(text).alias("text"))
    repeated = repeated_anchors(keyed)
    found = occurrences(keyed, repeated)
    segment = ["anchor", "segment"]  # two hashes tell segments apart
    firsts = B.saved(found.groupBy(*segment).agg(
        F.min(F.struct("doc", "place", "version")).alias("first"), F.count("*").alias("times")),
        "firsts")
    shared = B.saved(firsts.groupBy("anchor").agg(F.count("*").alias("segments"))
                     .where("segments > 1"), "shared-anchors")
    compared = firsts.join(shared, "anchor").select(
        *segment, "first.doc", "first.version", "first.place",
        (F.col("segments") > shared_segments).alias("shared"))
    parts = B.saved(contents(keyed, compared), "contents")
    masks = shard_masks(parts.where("length(words) > 0"), shard_words).union(
        window_masks(parts.where("size(windows) > 0"))).where("mask != 0")
    judged = firsts.join(masks, segment, "left").where("times > 1 OR mask IS NOT NULL").select(
        *segment, "first", F.coalesce("mask", F.lit(0)).alias("mask"))
    is_first = (F.col("doc") == F.col("first.doc")) & (F.col("place") == F.col("first.place"))
    marked = (found.join(judged, segment)
              .withColumn("mask", F.when(is_first, F.col("mask")).otherwise(F.lit(ALL)))
              .where("mask != 0")
              .groupBy(F.col("doc").alias(MARKED_DOC), F.col("version").alias(MARKED_VERSION))
              .agg(F.collect_list(F.struct(
                  "place", F.col("segment"), F.col("mask").cast("int").alias("mask")))
                  .alias(MARKS)))
    joined = own.join(marked, (F.col(DOC) == F.col(MARKED_DOC))
                      & (F.col(VERSION) == F.col(MARKED_VERSION)), "left")

    def clean(piece: pa.RecordBatch) -> pa.Array:
        raw, offsets = B.utf8(piece.column(text))
        starts, ends, bounds = B.word_spans(raw, offsets, B.NOT_BLANK)
        s = segments(B.span_hashes(raw, starts, ends), bounds)
        # A segment that occurs earlier in its own document goes whole.
        again = pd.Series(B.mix(s.hash + s.row.astype(np.uint64))).duplicated().to_numpy()
        masks = np.where(again, ALL, 0)
        marks = piece.column(MARKS)
        listed = marks.flatten()
        if len(listed) and len(s.row):
            row = np.repeat(np.arange(piece.num_rows), np.nan_to_num(
                marks.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            key = row * (1 << 32) + listed.field("place").to_numpy()
            have = s.row * (1 << 32) + s.place
            at = np.minimum(np.searchsorted(have, key), len(have) - 1)
            good = (have[at] == key) & (s.hash[at].view(np.int64)
                                        == listed.field("segment").to_numpy())
            masks[at[good]] |= listed.field("mask").to_numpy()[good]
        # Removed words: the union of the marked windows.
        edges = np.zeros(len(starts) + 1, np.int64)
        for k in range(WINDOW - GRAM + 1):
            first = s.start[(masks >> k & 1 == 1) & (k <= s.size - WINDOW)] + k
            np.add.at(edges, first, 1)
            np.add.at(edges, first + WINDOW, -1)
        gone = np.cumsum(edges[:-1]) > 0
        rows = B.row_of(bounds)
        n = piece.num_rows
        left = np.flatnonzero(~gone)
        lengths = (ends - starts)[left]
        data = raw[B.ragged(starts[left], lengths)]
        # Words are joined by a space: each but a text's last kept word takes one more byte.
        last = np.ones(len(left), bool)
        last[:-1] = rows[left][1:] != rows[left][:-1]
        sizes = lengths + ~last
        joined_text = np.full(int(sizes.sum()), 0x20, np.uint8)
        joined_text[B.ragged(np.cumsum(sizes) - sizes, lengths)] = data
        kept = B.binary(joined_text, np.bincount(rows[left], sizes, n).astype(np.int64))
        return pa.StructArray.from_arrays(
            [pa.array(np.diff(bounds)), pa.array(np.bincount(rows[gone], minlength=n)),
             kept.cast(pa.string())], ["n_words", "n_removed", "kept"])

    return B.annotate(joined, out, REPORT, text, clean, 
                      drop=(DOC, VERSION, MARKED_DOC, MARKED_VERSION, MARKS))


def op10(docs: DataFrame) -> DataFrame:
    """The contract's columns of ``remove_repeats`` over documents."""
    report = F.col("repeats")
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", report.n_words.alias("n_words"), report.n_removed.alias("n_removed"),
        F.sha2(report.kept, 256).alias("kept_sha256"))
