"""op12: the prefix trie of conversations, screened by a count-min sketch.

Every turn is reduced to a digest at the scan; a conversation's turns stream through a task in
order, which chains the digests: a prefix is known by 128 bits of SHA-256.  A count-min sketch
of all prefixes (two rows of cells, of which only "two or more" has to be kept) then screens
them: an estimate of one proves that the prefix is of one conversation, and such nodes, the
conversations' tails, are final where they are.  Only prefixes that may be shared are shuffled
and grouped by their digests, which settles them whatever the sketch said.

Sums over subtrees need no walk: a node's own share is booked to its least member, and the nodes
of which a conversation is the least member are the lower end of its path.  So a subtree's sum is
that of all shares booked to its members, less what its least member holds above it: one grouped
sum and one running sum, at any depth.

The conversations of one family (those that may borrow turns of each other) pass one task as a
stream of digests, which keeps the turns that may be borrowed and no others.  SHA-256 of a node's
member ids takes them in order: they are joined to chunks in parallel, and the chunks of a node
pass one task as a stream.

Results in the odd cases: rows without a conv_id are left out (it must be an integer); a null
turn comes first; turns of equal number are ordered by their digests; a null role or text is
empty; repeated rows are turns of their own.  A conversation left without turns ends at the
root.  An empty table has no nodes.  Other columns do not matter.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import batches as B

DIGEST = 16  # bytes that are kept of a SHA-256
ROOT = hashlib.sha256(b"").digest()[:DIGEST]
NO_ENDS = hashlib.sha256(b"").hexdigest()
CELLS_EACH, LEAST_BITS, MOST_BITS = 4, 12, 27  # a sketch row has 2**bits cells
BLOCK = 16  # bits of a cell's place in its block
CHUNK = 1 << 20  # prefixes sketched at once in a task
OUT_ROWS = 1 << 13
ID_BITS = 12  # ids of a chunk are equal but for so many low bits

PATHS = ("conv_id long, depth int, digest binary, parent binary, size long, last boolean")


def paths(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text", family: Callable[[Column], Column] | None = None,
          borrowed: Callable[[int], int] | None = None, most_borrowed: int = 0) -> DataFrame:
    """(``PATHS``) a row per conversation and prefix, the empty one included.

    ``family(conv_id)`` is the conversation whose first ``borrowed(conv_id)`` turns (at most
    ``most_borrowed``) stand for as many of its own; nobody borrows where it is not given.
    """
    key = F.col(conv_id).cast("long")
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    message = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)
    turns = conversations.where(key.isNotNull()).select(
        (family(key) if family else key).alias("family"), key.alias("conv_id"),
        F.col(turn).alias("turn"), F.octet_length(said).cast("long").alias("size"),
        F.substring(F.unhex(F.sha2(F.encode(message, "UTF-8"), 256)), 1, DIGEST).alias("message"))
    ordered = turns.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id",
        F.col("turn").asc_nulls_first(), "message")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(6)]
        group, shared = None, []  # the family and what it lends
        conv, skip, seen = None, 0, 0  # the conversation, turns it does not take, turns read
        depth, digest = 0, ROOT

        def begin() -> None:
            nonlocal depth, digest
            depth, digest = 0, ROOT
            for column, value in zip(out, (conv, 0, ROOT, ROOT, 0, True)):
                column.append(value)

        def grow(message: bytes, size: int) -> None:
            nonlocal depth, digest
            out[5][-1] = False
            parent, depth = digest, depth + 1
            digest = hashlib.sha256(parent + message).digest()[:DIGEST]
            for column, value in zip(out, (conv, depth, digest, parent, size, True)):
                column.append(value)

        def emit(n: int) -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays(
                [pa.array(c[:n], t) for c, t in zip(out, (
                    pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()))],
                ["conv_id", "depth", "digest", "parent", "size", "last"])
            for column in out:
                del column[:n]
            return found

        for batch in batches:
            for fam, c, message, size in zip(*(batch.column(n).to_pylist() for n in (
                    "family", "conv_id", "message", "size"))):
                if fam != group:
                    group, shared = fam, []
                if c != conv:
                    conv, seen = c, 0
                    skip = borrowed(c) if borrowed and c != fam else 0
                    begin()
                    for lent in shared[:skip]:
                        grow(*lent)
                if c == fam and seen < most_borrowed:
                    shared.append((message, size))
                seen += 1
                if seen > skip:
                    grow(message, size)
                if len(out[0]) > OUT_ROWS:  # the newest row may still be followed by another
                    yield emit(OUT_ROWS)
        if out[0]:
            yield emit(len(out[0]))

    return ordered.mapInArrow(run, PATHS)


def _cells(digests: pa.Array, bits: int) -> np.ndarray:
    """Cells of the prefixes: one in each of the sketch's rows, numbered through."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 2)
    return (raw >> np.uint64(64 - bits)).astype(np.int64) + (np.arange(2) << bits)


def sketch(prefixes: DataFrame, bits: int) -> DataFrame:
    """(block, bits) of the count-min sketch of ``digest``: which cells hold two or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(held).ravel(), return_counts=True)
            blocks, firsts = np.unique(cells >> BLOCK, return_index=True)
            ends = [*firsts[1:], len(cells)]
            low = (cells & ((1 << BLOCK) - 1)).astype("<u2")
            parts = [(low[a:b][n[a:b] == 1].tobytes(), low[a:b][n[a:b] > 1].tobytes())
                     for a, b in zip(firsts, ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), *(pa.array(p, pa.binary()) for p in zip(*parts))],
                ["block", "once", "more"])

        for batch in batches:
            if batch.num_rows:
                held.append(_cells(batch.column("digest"), bits))
                size += batch.num_rows
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()),
                 pa.array([np.packbits(n > 1, bitorder="little").tobytes()], pa.binary())],
                ["block", "bits"])

        for batch in batches:
            for b, once, more in zip(*(batch.column(c).to_pylist() for c in (
                    "block", "once", "more"))):
                if b != block:
                    if block is not None and (n > 1).any():
                        yield done()
                    block, n = b, np.zeros(1 << BLOCK, np.uint8)
                at = np.frombuffer(once, "<u2")  # each cell once a row, so no sum is lost
                n[at] = np.minimum(n[at] + 1, 2)
                n[np.frombuffer(more, "<u2")] = 2
        if block is not None and (n > 1).any():
            yield done()

    counted = prefixes.select("digest").mapInArrow(count, "block long, once binary, more binary")
    return (counted.repartition("block").sortWithinPartitions("block")
            .mapInArrow(merge, "block long, bits binary"))


def screened(prefixes: DataFrame) -> DataFrame:
    """``prefixes`` with ``single`` and ``parent_single``: proven to be of one conversation."""
    n = max(1, prefixes.count())
    bits = int(np.clip(np.ceil(np.log2(CELLS_EACH * n)), LEAST_BITS, MOST_BITS))
    table = np.zeros(2 << max(0, bits - 3), np.uint8)  # 2**(MOST_BITS - 2) bytes at most
    for block, packed in sketch(prefixes.where("depth > 0"), bits).collect():
        at = block << (BLOCK - 3)
        part = np.frombuffer(packed, np.uint8)[:len(table) - at]
        table[at:at + len(part)] |= part
    sent = prefixes.sparkSession.sparkContext.broadcast(table)

    def proven(digests: pa.Array) -> np.ndarray:
        cells = _cells(digests, bits)
        return ~((sent.value[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).astype(bool) \
            .all(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                depth = batch.column("depth").to_numpy()
                above = proven(batch.column("parent")) & (depth > 1)
                alone = (proven(batch.column("digest")) & (depth > 0)) | above
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(alone), pa.array(above)],
                    [*batch.schema.names, "single", "parent_single"])

    return prefixes.mapInArrow(run, PATHS + ", single boolean, parent_single boolean")


def _ends(shared: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the nodes where conversations end."""
    chunks = (shared.where("last").groupBy("digest", F.shiftright("conv_id", ID_BITS)
                                           .alias("place"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))  # 2**ID_BITS at most
              .select("digest", "place", F.concat_ws(",", F.col("ids").cast("array<string>"))
                      .alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            found = []
            for digest, ids in zip(batch.column("digest").to_pylist(),
                                   batch.column("ids").to_pylist()):
                if digest != node:
                    if node is not None:
                        found.append((node, state.hexdigest()))
                    node, state = digest, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows(found)
        if node is not None:
            yield rows([(node, state.hexdigest())])

    def rows(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in found], pa.binary()),
             pa.array([s for _, s in found], pa.string())], ["digest", "ends_sha256"])

    return (chunks.repartition("digest").sortWithinPartitions("digest", "place")
            .mapInArrow(run, "digest binary, ends_sha256 string"))


def trie(prefixes: DataFrame) -> DataFrame:
    """The nodes of the trie of ``paths``: a row each, with its least member (``conv_id``) and
    depth, that of its parent, numbers of members, children and leaves below, the bytes that
    sharing saves below, and the digest of the ids that end in it."""
    marked = B.saved(screened(B.saved(prefixes, "trie-paths")), "trie-screened")
    shared = marked.where("NOT single")
    tails = marked.where("single")
    grouped = B.saved(shared.groupBy("digest").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.first("size").alias("size")), "trie-grouped")
    kids = (grouped.where("depth > 0").select("parent")
            .union(tails.where("NOT parent_single").select("parent"))
            .groupBy("parent").agg(F.count("*").alias("n_children")))
    nodes = B.saved(
        grouped.join(kids.withColumnRenamed("parent", "digest"), "digest", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("saves", (F.col("n_convs") - 1) * F.col("size"))
        .withColumn("leaf", (F.col("n_children") == 0).cast("long")), "trie-nodes")
    booked = (nodes.select("conv_id", "saves", "leaf")
              .union(tails.where("last").select("conv_id", F.lit(0).cast("long"),
                                                F.lit(1).cast("long")))
              .groupBy("conv_id").agg(F.sum("saves").alias("saves"), F.sum("leaf").alias("leaf")))
    below = (shared.select("conv_id", "digest").join(booked, "conv_id").groupBy("digest")
             .agg(F.sum("saves").alias("all_saves"), F.sum("leaf").alias("all_leaves")))
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, -1)
    summed = (nodes.withColumn("above_saves", F.coalesce(F.sum("saves").over(above), F.lit(0)))
              .withColumn("above_leaves", F.coalesce(F.sum("leaf").over(above), F.lit(0)))
              .join(below, "digest").join(_ends(shared), "digest", "left")
              .select("conv_id", "depth", "parent", "n_convs", "n_children",
                      (F.col("all_leaves") - F.col("above_leaves")).alias("n_leaves"),
                      (F.col("all_saves") - F.col("above_saves")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = tails.select(
        "conv_id", "depth", "parent", "parent_single", one.alias("n_convs"),
        F.when(F.col("last"), none).otherwise(one).alias("n_children"), one.alias("n_leaves"),
        none.alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.encode(F.col("conv_id").cast("string"), "UTF-8"), 256))
        .otherwise(F.lit(NO_ENDS)).alias("ends_sha256"))
    parents = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("of"))
    kept = [c for c in summed.columns if c != "parent"]
    own = alone.where("parent_single").select(*kept, F.col("conv_id").alias("parent_conv_id"))
    placed = (summed.where("depth > 0")
              .union(alone.where("NOT parent_single").select(*summed.columns))
              .join(parents, "parent", "left")  # without one the parent is a tail of its own
              .select(*kept, F.coalesce("of", "conv_id").alias("parent_conv_id")))
    top = summed.where("depth = 0").select(*kept, F.lit(None).cast("long").alias("parent_conv_id"))
    return own.union(placed).union(top).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def borrowed_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % 9


def op12(conversations: DataFrame) -> DataFrame:
    """The contract's columns: conversations lend their first turns to the four after them."""
    return trie(paths(conversations, family=lambda c: c - c % 5, borrowed=borrowed_turns,
                      most_borrowed=8))
