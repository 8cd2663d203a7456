"""op9: token ids in seekable zstandard files.

Documents are range-partitioned and sorted by id, encoded, and written as files of
independent zstandard frames of whole documents, following the public seekable format:

* data frames: each holds the ids of some consecutive documents, little-endian unsigned 32-bit;
* a skippable frame (magic 0x184D2A50) with the document index: the number of documents, then
  document ids (int64), null flags (uint8), frame numbers (uint32), id counts (uint64);
* a skippable frame (magic 0x184D2A5E) with the seek table: per frame its compressed size,
  decompressed size and the low half of the content's XXH64; then the number of frames, a
  descriptor byte (128: with checksums) and the magic 0x8F92EAB1.

A reader takes the tail, finds the requested documents, and decompresses only their frames;
each frame's checksum is verified.  Files go through ``pyarrow.fs`` to the shared folder and
get their final name in one move, so a repeated task replaces its own file with the same
bytes.  A manifest (one row a file) gives each file's place in the global order.

Results in the odd cases: a null or empty text has only the end id; null ids come first;
documents that share an id are ordered by text; an empty table gives no files.
"""

from __future__ import annotations

import json
import os
import string
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StringType, StructField,
                               StructType)

from quayside.llm import batches as B
from quayside.session import shared_scratch

# Fixed values of the seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 128

FRAME_IDS = 1 << 17  # a frame is closed once it holds so many ids
FILE_BYTES = 256 << 20  # and a file once it holds so many bytes
TEXT_BYTES = 2 << 20
MARK, GROUP = "\x01", 256  # what sets words apart in a call of the library, and words a call
CLOSING = string.punctuation.replace("'", "")  # none of it joins a letter before it

# What a tokenizer file says whose words can be encoded apart from their text.
APART = {
    "truncation": None, "padding": None,
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
         "use_regex": False}]}}

MANIFEST = StructType([
    StructField("part", IntegerType()), StructField("seq", IntegerType()),
    StructField("file", StringType()), StructField("n_docs", LongType()),
    StructField("n_tokens", LongType())])
ROWS = StructType([StructField("doc_id", LongType()), StructField("start", LongType()),
                   StructField("n_tokens", LongType()), StructField("ids", BinaryType())])


class FrameWriter:
    """Writes one file of frames to an open binary stream."""

    def __init__(self, stream, level: int = 3):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=level)
        self.pending: list[np.ndarray] = []
        self.pending_ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.doc_frames: list[int] = []
        self.counts: list[int] = []
        self.bytes = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.doc_frames.append(len(self.frames))
        self.counts.append(len(ids))
        self.pending.append(ids)
        self.pending_ids += len(ids)
        if self.pending_ids >= FRAME_IDS:
            self._flush()

    def _flush(self) -> None:
        if not self.pending:
            return
        raw = np.concatenate(self.pending).astype("<u4").tobytes()
        packed = self.packer.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.bytes += len(packed)
        self.pending, self.pending_ids = [], 0

    def close(self) -> None:
        self._flush()
        index = b"".join([
            struct.pack("<Q", len(self.counts)),
            np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
            np.array([d is None for d in self.doc_ids], "u1").tobytes(),
            np.array(self.doc_frames, "<u4").tobytes(), np.array(self.counts, "<u8").tobytes()])
        self.stream.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in (
            *self.frames, (len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)))
        footer = struct.pack("<IBI", len(self.frames) + 1, WITH_CHECKSUMS, FOOTER_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)))
        self.stream.write(table + footer)


class FrameReader:
    """Random access to the documents of one file (an open seekable binary stream)."""

    def __init__(self, stream, size: int):
        self.stream = stream
        n_frames, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or descriptor != WITH_CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        start = size - 9 - 12 * n_frames
        table = np.frombuffer(self._at(start, 12 * n_frames), "<u4").reshape(-1, 3)
        ends = np.cumsum(table[:, 0], dtype=np.int64)
        self.places, self.table = ends - table[:, 0], table
        index = self._at(int(self.places[-1]) + 8, int(table[-1, 0]) - 8)
        n = struct.unpack_from("<Q", index)[0]
        self.doc_ids = np.frombuffer(index, "<i8", n, 8)
        self.nulls = np.frombuffer(index, "u1", n, 8 + 8 * n).astype(bool)
        self.doc_frames = np.frombuffer(index, "<u4", n, 8 + 9 * n)
        self.counts = np.frombuffer(index, "<u8", n, 8 + 13 * n).astype(np.int64)
        self.unpacker = zstandard.ZstdDecompressor()

    def _at(self, place: int, size: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(size)

    def frame(self, k: int) -> np.ndarray:
        """The ids of one frame, after its checksum is verified."""
        packed, size, checksum = (int(x) for x in self.table[k])
        raw = self.unpacker.decompress(self._at(int(self.places[k]), packed), size or 1)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, "<u4")

    def documents(self, wanted: set[int] | None = None) \
            -> Iterator[tuple[int, np.ndarray]]:
        """(place in the file, ids) of the wanted documents (all: none given)."""
        at = 0
        for k in range(len(self.table) - 1):
            last = int(np.searchsorted(self.doc_frames, k, "right"))
            chosen = [i for i in range(at, last) if wanted is None
                      or not self.nulls[i] and int(self.doc_ids[i]) in wanted]
            if chosen:
                ids = self.frame(k)
                ends = np.cumsum(self.counts[at:last])
                for i in chosen:
                    yield i, ids[ends[i - at] - self.counts[i]:ends[i - at]]
            at = last


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


class LibraryTexts:
    """Encodes whole texts with any tokenizer file."""

    def __init__(self, path: str):
        self.library = _library(path)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        ids = [self.library.encode(t, add_special_tokens=False).ids
               for t in pc.fill_null(column, "").to_pylist()]
        return (np.concatenate([np.zeros(0, np.int32), *(np.array(x, np.int32) for x in ids)]),
                np.array([len(x) for x in ids], np.int64))


class LibraryWords:
    """Encodes blank-separated words with a tokenizer file, as parts of whole texts.

    The tokenizer's normaliser turns blanks into one space and its split drops spaces, so a
    text's ids are those of its words one after another.  It also folds case, and splits a
    letter from the punctuation behind it; a word therefore goes to the library as its folded
    stem and its closing punctuation, each distinct one of a call once.
    """

    def __init__(self, path: str):
        self.library = _library(path)
        self.mark = self.library.encode(MARK, add_special_tokens=False).ids

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row and their sizes; the library takes many words at once,
        set apart by a mark that is one id, or one by one where a word holds that id."""
        ids, sizes = [], []
        for k in range(0, len(words), GROUP):
            group = words[k:k + GROUP]
            found = np.array(self.library.encode(
                f" {MARK} ".join(group), add_special_tokens=False).ids, np.int32)
            cuts = np.flatnonzero(found == self.mark[0])
            if len(self.mark) == 1 and len(cuts) == len(group) - 1:
                sizes.append(np.diff(np.concatenate([[-1], cuts, [len(found)]])) - 1)
                ids.append(np.delete(found, cuts))
            else:
                each = self.library.encode_batch_fast(group, add_special_tokens=False)
                sizes.append(np.array([len(e.ids) for e in each]))
                ids.append(np.array([i for e in each for i in e.ids], np.int32))
        return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts: dict[str, int] = {}
        order = np.zeros(2 * len(words), np.int64)
        for k, word in enumerate(words):
            stem = word.rstrip(CLOSING)
            if len(stem) == len(word) or not stem or not stem[-1].isalpha():
                stem = word
            folded = stem.lower() if "\u03a3" not in stem else stem
            order[2 * k] = parts.setdefault(folded, len(parts))
            order[2 * k + 1] = parts.setdefault(word[len(stem):], len(parts))
        ids, sizes = self._ids([*parts])
        firsts, lengths = np.cumsum(sizes) - sizes, sizes[order]
        return ids[B.ragged(firsts[order], lengths)], lengths.reshape(-1, 2).sum(axis=1)


_tokenizers: dict[str, B.WordIds | LibraryTexts] = {}


def tokenizer(path: str) -> B.WordIds | LibraryTexts:
    """The encoder of the tokenizer file at ``path``, made once per worker process: by words
    where the file says what :class:`LibraryWords` relies on, else by whole texts."""
    if path not in _tokenizers:
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        apart = all(said.get(part) == value for part, value in APART.items())
        _tokenizers[path] = B.WordIds(LibraryWords(path)) if apart else LibraryTexts(path)
    return _tokenizers[path]


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, *,
                 doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the documents' ids (``end_id`` after each) as files in ``folder``, a URI or path
    that every executor sees, with a Parquet manifest in ``folder``/manifest."""
    order = [F.col(doc_id).cast("long"), F.xxhash64(F.col(text)), F.col(text)]
    ordered = (docs.select(order[0].alias("doc_id"), F.col(text).alias("text"))
               .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text"), F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, seq, out = TaskContext.get().partitionId(), 0, None

        def finish() -> pa.RecordBatch:
            out.close()
            out.stream.close()
            store.move(draft, final)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "file": [final.rsplit("/", 1)[1]],
                 "n_docs": [len(out.counts)], "n_tokens": [sum(out.counts)]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()),
                                  ("file", pa.string()), ("n_docs", pa.int64()),
                                  ("n_tokens", pa.int64())]))

        for batch in batches:
            for piece in B.pieces(batch, "text", TEXT_BYTES):
                ids, counts = tokenizer(path)(piece.column("text"))
                ends = np.cumsum(counts)
                for key, n, end in zip(piece.column("doc_id").to_pylist(), counts, ends):
                    if out is None:
                        final = f"{base}/part-{part:06d}-{seq:04d}.zst"
                        draft = f"{final}.{uuid.uuid4().hex}"
                        out = FrameWriter(store.open_output_stream(draft))
                    out.add(key, np.append(ids[end - n:end], end_id))
                    if out.bytes >= FILE_BYTES:
                        yield finish()
                        seq, out = seq + 1, None
        if out is not None:
            yield finish()

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder.rstrip('/')}/manifest")


def read_tokens(spark: SparkSession, folder: str,
                wanted: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents in ``folder`` (only those ``wanted``).

    ``start`` counts the ids of all documents before, over all files.  Files are read by a
    task each; the running total is over the manifest, one row a file.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(
        F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base"))
    chosen = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(*(batch.column(c).to_pylist() for c in ("file", "base"))):
                where = f"{top}/{name}"
                with store.open_input_file(where) as stream:
                    reader = FrameReader(stream, stream.size())
                    starts = base + np.cumsum(reader.counts) - reader.counts
                    group, held = [], 0
                    for i, ids in reader.documents(chosen):
                        group.append((i, ids))
                        held += len(ids)
                        if held >= FRAME_IDS:
                            yield _rows(reader, starts, group)
                            group, held = [], 0
                    if group:
                        yield _rows(reader, starts, group)

    return placed.repartition(max(1, manifest.count())).mapInArrow(run, ROWS)


def _rows(reader: FrameReader, starts: np.ndarray, group: list) -> pa.RecordBatch:
    at = np.array([i for i, _ in group])
    return pa.RecordBatch.from_arrays(
        [pa.array(reader.doc_ids[at], mask=reader.nulls[at]), pa.array(starts[at]),
         pa.array(reader.counts[at]), pa.array([ids.tobytes() for _, ids in group], pa.binary())],
        ["doc_id", "start", "n_tokens", "ids"])


def op9(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """The contract's columns, from files written in the shared folder and read back."""
    folder = shared_scratch(spark, "tokens")
    write_tokens(docs, folder, path, end_id)
    return read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
