"""op8: byte-level BPE over padded numpy matrices.

A rank file gives every token's bytes and rank; a token's id is its rank.  A text is split by
a pattern and each distinct piece of a batch is encoded once: a piece that is a token is that
token; the others become rows of byte ids in matrices padded to the next power of two.  Each
round every row merges its leftmost pair of minimum rank (ranks come from a hash table of
pairs), the row is closed up, and finished rows leave the matrix.

Pieces longer than ``LONG_PIECE`` bytes are merged one at a time as a flat array, in which a
round takes all occurrences of the minimum pair at once.  That equals the leftmost-first
order unless a merge makes a pair of lower rank than its own; such a round takes one merge.

A null or empty text has no ids.  Ids are stored as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from quayside.llm import batches as B

LONG_PIECE = 256
MATRIX_CELLS = 1 << 18
TEXT_BYTES = 1 << 20
NONE = np.int32(np.iinfo(np.int32).max)

TOKENS = StructType([StructField("n_tokens", LongType()), StructField("ids", BinaryType()),
                     StructField("decoded", BinaryType())])


class Ranks:
    """A rank file's tokens and pair merges."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.size = max(self.ids.values()) + 1
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * self.size
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        keys, ranks = [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(rank)
        self.pairs = B.HashTable(2 * len(keys), int(NONE))
        self.pairs.insert(np.array(keys, np.int64), np.array(ranks, np.int32))
        self.piece_ids = B.PieceIds(self.encode_pieces)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << np.int64(32) | b.astype(np.int64)
        return self.pairs.find(keys.reshape(-1)).reshape(keys.shape)

    def merge_rows(self, rows: list[bytes], width: int) -> list[np.ndarray]:
        """Encode byte strings of at most ``width`` bytes, one merge a row and round."""
        n = len(rows)
        sizes = np.array([len(r) for r in rows])
        ids = np.full((n, width + 1), -1, np.int32)
        ids[np.repeat(np.arange(n), sizes), B.ragged(np.zeros(n, np.int64), sizes)] = \
            self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        columns = np.arange(width)
        pair = np.where(ids[:, 1:] >= 0, self.pair_ranks(ids[:, :-1], ids[:, 1:]), NONE)
        out: list[np.ndarray] = [ids[0, :0]] * n
        row = np.arange(n)
        while len(row):
            at = pair.argmin(axis=1)
            each = np.arange(len(row))
            rank = pair[each, at]
            done = rank == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[row[k]] = ids[k, :sizes[row[k]]].copy()
                go = ~done
                row, ids, pair, at, rank = row[go], ids[go], pair[go], at[go], rank[go]
                each = each[:len(row)]
                if not len(row):
                    break
            ids[each, at] = rank
            # Close up: what stands right of the merged pair moves one column left.
            later = columns + (columns > at[:, None])
            ids[:, :-1] = np.take_along_axis(ids, later, 1)
            ids[:, -1] = -1
            padded = np.concatenate([pair, np.full((len(row), 1), NONE, np.int32)], axis=1)
            pair = np.take_along_axis(padded, later, 1)
            sizes[row] -= 1
            for shift in (0, -1):  # the pairs that begin at the new token and end with it
                k = at + shift
                some = (k >= 0) & (k + 1 < sizes[row])
                pair[each[(k >= 0) & ~some], k[(k >= 0) & ~some]] = NONE
                e, k = each[some], k[some]
                pair[e, k] = self.pair_ranks(ids[e, k], ids[e, k + 1])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Encode one long byte string; a round takes the least pair wherever it stands."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        while len(ids) > 1:
            pair = self.pair_ranks(ids[:-1], ids[1:])
            rank = pair.min()
            if rank == NONE:
                break
            at = np.flatnonzero(pair == rank)
            # In a run of touching occurrences every other one counts, from its left end.
            run = np.concatenate([[True], np.diff(at) > 1])
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            left, right = ids[at[at > 0] - 1], ids[at[at + 2 < len(ids)] + 2]
            made = np.full(len(left) + len(right) + 1, rank, np.int32)
            if self.pair_ranks(np.concatenate([left, made[len(left):]]),
                               np.concatenate([made[:len(left)], right, made[:1]])).min() < rank:
                at = at[:1]
            ids[at] = rank
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
        return ids

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece: whole tokens, matrices by padded length, long pieces alone."""
        out: list[np.ndarray] = [self.byte_ids[:0]] * len(pieces)
        buckets: dict[int, list[tuple[int, bytes]]] = {}
        for k, raw in enumerate(p.encode() for p in pieces):
            rank = self.ids.get(raw)
            if rank is not None:
                out[k] = np.array([rank], np.int32)
            elif len(raw) > LONG_PIECE:
                out[k] = self.merge_long(raw)
            elif raw:
                width = max(4, 1 << (len(raw) - 1).bit_length())
                buckets.setdefault(width, []).append((k, raw))
        for width, bucket in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for at in range(0, len(bucket), step):
                part = bucket[at:at + step]
                for (k, _), ids in zip(part, self.merge_rows([r for _, r in part], width)):
                    out[k] = ids
        return out

    def encode(self, texts: list[str], split: regex.Pattern) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's number of ids."""
        return self.piece_ids([split.findall(t) for t in texts])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of consecutive id lists, and the bytes of each list."""
        lengths = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        borders = np.concatenate([[0], np.cumsum(counts)])
        return self.bytes[B.ragged(self.starts[ids], lengths)], np.diff(ends[borders])


_loaded: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The rank file at ``path``, read once per worker process."""
    if path not in _loaded:
        _loaded[path] = Ranks(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, pattern: str, *, text: str = "text",
           out: str = "tokens") -> DataFrame:
    """``docs`` with a struct ``out``: n_tokens, ids, and the bytes the ids decode to.

    An input column named like ``out`` is replaced; the others pass through.
    """
    def tokens(piece: pa.RecordBatch) -> pa.Array:
        table, split = ranks(path), regex.compile(pattern)
        texts = pc.fill_null(piece.column(text), "").to_pylist()
        ids, counts = table.encode(texts, split)
        data, sizes = table.decode(ids, counts)
        return pa.StructArray.from_arrays(
            [pa.array(counts), B.binary(ids.astype("<u4").view(np.uint8), 4 * counts),
             B.binary(data, sizes)], ["n_tokens", "ids", "decoded"])

    return B.annotate(docs, out, TOKENS, text, tokens, limit=TEXT_BYTES)


def decode(rows: DataFrame, path: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with a struct ``out`` holding the bytes of each row's ids (null: none)."""
    kind = StructType([StructField("bytes", BinaryType())])

    def restored(piece: pa.RecordBatch) -> pa.Array:
        column = pc.fill_null(piece.column(ids), b"")
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.frombuffer(b"".join(column.to_pylist()), "<u4").astype(np.int64)
        data, lengths = ranks(path).decode(flat, sizes // 4)
        return pa.StructArray.from_arrays([B.binary(data, lengths)], ["bytes"])

    return B.annotate(rows, out, kind, ids, restored, limit=4 * TEXT_BYTES)


def op8(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The contract's columns of ``encode`` over documents."""
    tokens = F.col("tokens")
    return encode(docs.select("doc_id", "text"), path, pattern).select(
        "doc_id", tokens.n_tokens.alias("n_tokens"),
        F.sha2(tokens.ids, 256).alias("ids_sha256"),
        F.sha2(tokens.decoded, 256).alias("decoded_sha256"))
