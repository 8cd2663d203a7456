"""op13: pages as WARC records in dictionary-compressed Zstandard archives.

Pages whose payload (the html as UTF-8) is equal to that of a page of lesser id become revisit
records: payloads are grouped by their SHA-256, partial aggregates first, and only the groups
with copies are joined back.  Each task then writes its records to one archive or more:

* a skippable frame (magic 0x184D2A5D) that holds the dictionary, trained on the archive's first
  ``SAMPLE_BYTES`` of records (which are in the order of their digests, so any page may be among
  them), or their plain bytes where they are too few to train on;
* a frame with the warcinfo record, and a frame with content size and checksum for every other
  record, so that any record can be read by itself.

Archives go through ``pyarrow.fs`` to the shared folder and get their final name in one move; an
index (Parquet: page id, archive, offset, length) says where each record is.  ``read_archive``
reads archives from front to back without the index, ``read_pages`` only the asked records; both
verify every length and payload digest.

Results in the odd cases: a null html is the empty payload, and empty payloads are equal.  Rows
that share the least page id of a payload are all responses; null ids come after all others and
refer to the least id where there is one.  A null url has no field and is read back as null;
control characters in a url are percent-encoded.  Payloads under ``min_bytes`` are never
revisits.  An empty table gives no archives.  Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import shared_scratch

# Fixed values of the two formats.
DICTIONARY_MAGIC = 0x184D2A5D
TRAINED_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
ARCHIVE_BYTES = 256 << 20  # an archive is closed once it holds so many
READ_BYTES = 64 << 10
BATCH_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"  # pages have no time of their own
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "page-records")

INDEX = "page_id string, archive string, offset long, length long"
PAGE = ("page_id string, url string, record_type string, refers_to string, payload string, "
        "payload_bytes long, payload_digest string")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{digest}:{page_id}')}>"


def _fields(pairs: Iterable[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in (*pairs, ("Content-Length", str(len(block))))
             if v is not None]
    return VERSION + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def information(date: str) -> bytes:
    return _fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, "info")),
                    ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                   b"format: WARC File Format 1.1\r\n")


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None,
           date: str) -> bytes:
    """One response record, or a revisit record of the page ``refers_to``."""
    digest = payload_digest(payload)
    revisit = refers_to is not None
    shown = None if url is None else re.sub(
        "[\x00-\x1f\x7f]", lambda m: urllib.parse.quote(m[0]), url)
    quoted = [None if x is None else urllib.parse.quote(x) for x in (page_id, refers_to)]
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    return _fields([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
        ("WARC-Target-URI", shown), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("Page-ID", quoted[0]), ("Refers-To-Page-ID", quoted[1]),
        ("Content-Type", "application/http; msgtype=response")],
        head if revisit else head + payload)


def parsed(raw: bytes) -> tuple | None:
    """The values of ``PAGE`` for one record; None for a warcinfo record."""
    cut = raw.index(b"\r\n\r\n")
    if not raw.startswith(VERSION):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in raw[len(VERSION):cut].decode().split("\r\n"))
    block = raw[cut + 4:-4]
    if len(block) != int(fields["Content-Length"]) or raw[-4:] != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    kind = fields["WARC-Type"]
    if kind == "warcinfo":
        return None
    cut = block.index(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", block[:cut])[1])
    digest, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
    if kind == "response":
        payload = block[cut + 4:]
        if len(payload) != size or payload_digest(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    ids = [None if x is None else urllib.parse.unquote(x)
           for x in (fields.get("Page-ID"), fields.get("Refers-To-Page-ID"))]
    return ids[0], fields.get("WARC-Target-URI"), kind, ids[1], payload, size, digest


class ArchiveWriter:
    """Writes one archive to an open binary stream; records wait until the dictionary is built."""

    def __init__(self, stream, date: str = DATE, level: int = 3):
        self.stream, self.date, self.level = stream, date, level
        self.waiting: list[tuple[str | None, bytes]] = []
        self.held, self.bytes, self.packer = 0, 0, None
        self.index: list[tuple[str | None, int, int]] = []

    def add(self, page_id: str | None, raw: bytes) -> None:
        if self.packer is not None:
            self._write(page_id, raw)
            return
        self.waiting.append((page_id, raw))
        self.held += len(raw)
        if self.held >= SAMPLE_BYTES:
            self._begin()

    def _put(self, data: bytes) -> int:
        self.stream.write(data)
        self.bytes += len(data)
        return len(data)

    def _write(self, page_id: str | None, raw: bytes) -> None:
        at = self.bytes
        self.index.append((page_id, at, self._put(self.packer.compress(raw))))

    def _begin(self) -> None:
        held = dictionary([raw for _, raw in self.waiting])
        data = held.as_bytes()
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=held,
                                               write_checksum=True)
        self._put(self.packer.compress(information(self.date)))
        for page_id, raw in self.waiting:
            self._write(page_id, raw)
        self.waiting = []

    def close(self) -> None:
        if self.packer is None:
            self._begin()
        self.stream.close()


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from the first ``SAMPLE_BYTES`` of ``records``."""
    samples, left = [], SAMPLE_BYTES
    for raw in records:
        samples.append(raw[:left])
        left -= len(samples[-1])
        if left <= 0:
            break
    size = max(1 << 10, min(DICTIONARY_BYTES, (SAMPLE_BYTES - left) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:  # too few of them, or too short
        data = b"".join(samples)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def unpacker(data: bytes) -> zstandard.ZstdDecompressor:
    """A decompressor for the records of an archive that begins with this dictionary."""
    kind = zstandard.DICT_TYPE_FULLDICT if data.startswith(TRAINED_MAGIC) else \
        zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))


def _dictionary_of(stream) -> bytes:
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no archive with a dictionary")
    return stream.read(size)


def records(stream) -> Iterator[bytes]:
    """Every record of an archive, from front to back."""
    unpack, rest = unpacker(_dictionary_of(stream)), b""
    while rest := rest or stream.read(READ_BYTES):
        frame, parts = unpack.decompressobj(), []
        while not frame.eof:
            rest = rest or stream.read(READ_BYTES)
            if not rest:
                raise ValueError("an archive ends inside a record")
            parts.append(frame.decompress(rest))
            rest = frame.unused_data
        yield b"".join(parts)


def write_archive(docs: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url",
                  html: str = "html", min_bytes: int = 0, date: str = DATE) -> None:
    """Write ``docs`` as archives in ``folder``, a URI or path that every executor sees, with the
    index in ``folder``/index."""
    pages = docs.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    pages = pages.withColumn("digest", F.unhex(F.sha2(F.encode("payload", "UTF-8"), 256)))
    shared = (pages.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    placed = pages.join(shared, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload",
        F.when(later, F.col("first")).cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        part, seq, out = TaskContext.get().partitionId(), 0, None

        def finish() -> pa.RecordBatch:
            out.close()
            store.move(draft, final)
            ids, offsets, lengths = zip(*out.index)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array([final.rsplit("/", 1)[1]] * len(ids)),
                 pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["page_id", "archive", "offset", "length"])

        for batch in batches:
            for page, link, payload, first in zip(*(batch.column(c) for c in (
                    "page_id", "url", "payload", "refers_to"))):
                if out is None:
                    final = f"{base}/part-{part:06d}-{seq:04d}.warc.zst"
                    draft = f"{final}.{uuid.uuid4().hex}"
                    out = ArchiveWriter(store.open_output_stream(draft, compression=None), date)
                out.add(page.as_py(), record(page.as_py(), link.as_py(),
                                             payload.as_buffer().to_pybytes(), first.as_py(), date))
                if out.bytes >= ARCHIVE_BYTES:
                    yield finish()
                    seq, out = seq + 1, None
        if out is not None:
            yield finish()

    placed.mapInArrow(run, INDEX).write.parquet(f"{folder.rstrip('/')}/index")


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in (
        x.split()[0] for x in PAGE.split(", "))])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[4] or b"")
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.binary()).cast(pa.string()) if f.name == "payload" else pa.array(c, f.type)
         for c, f in zip(zip(*rows), schema)], schema=schema)


def _index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder.rstrip('/')}/index")


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(``PAGE``) every record of every archive in ``folder``, an archive a task; ``payloads``
    says whether verified payloads are returned too (revisits have none)."""
    archives = _index(spark, folder).select("archive").distinct()

    def rows(name: str, store, top: str) -> Iterator[tuple]:
        with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
            for row in filter(None, map(parsed, records(stream))):
                yield row if payloads else (*row[:4], None, *row[5:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                yield from _batches(rows(name, store, top))

    return archives.repartition(max(1, archives.count())).mapInArrow(run, PAGE)


def read_pages(spark: SparkSession, folder: str, wanted: DataFrame,
               page_id: str = "page_id") -> DataFrame:
    """(``PAGE``) the records of the ids in ``wanted``, each read by itself through the index."""
    asked = wanted.select(F.col(page_id).cast("string").alias("page_id")).distinct()
    places = (_index(spark, folder).join(asked, "page_id", "left_semi")
              .repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)

        def rows() -> Iterator[tuple]:
            name, stream, unpack = None, None, None
            for batch in batches:
                for x in batch.to_pylist():
                    if x["archive"] != name:
                        if stream is not None:
                            stream.close()
                        name = x["archive"]
                        stream = store.open_input_file(f"{top}/{name}")
                        unpack = unpacker(_dictionary_of(stream))
                    stream.seek(x["offset"])
                    yield parsed(unpack.decompress(stream.read(x["length"])))
            if stream is not None:
                stream.close()

        yield from _batches(rows())

    return places.mapInArrow(run, PAGE)


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns, from archives written in the shared folder and read back."""
    folder = shared_scratch(spark, "warc")
    write_archive(docs, folder)
    kind = docs.schema["page_id"].dataType
    return read_archive(spark, folder, payloads=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
