"""Arrow batches of text as flat numpy arrays, and the shared hashing of words and windows.

Every function here works on UTF-8 bytes: a column of texts is one byte array plus row
offsets, and words are (start, end) pairs into it.  Work is cut into pieces of a bounded
number of text bytes (one row at least), so a task's memory follows the longest text and
not the batch size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from quayside.session import shared_scratch

PIECE_BYTES = 1 << 20  # text bytes handled at once inside a task

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its row offsets into them; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else \
        np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, limit: int = PIECE_BYTES) \
        -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``text`` holds at most ``limit`` bytes (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first, base = 0, 0
    while first < len(ends):
        last = max(int(np.searchsorted(ends, base + limit, "right")), first + 1)
        yield batch.slice(first, last - first)
        first, base = last, int(ends[last - 1])


def byte_class(member: Callable[[int], bool]) -> np.ndarray:
    """A 256-entry membership table."""
    return np.array([member(b) for b in range(256)])

_SECOND_CODES = np.random.default_rng(20240301).integers(0, 1 << 64, 256, np.uint64)

# Words between ASCII blanks; and words of letters, digits and anything beyond ASCII.
NOT_BLANK = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALPHANUMERIC = byte_class(lambda b: chr(b).isalnum() if b < 0x80 else True)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def word_spans(raw: np.ndarray, offsets: np.ndarray, member: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per row its first word (one entry more)."""
    inside = member[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below ``n`` (kept up to a size that repeats)."""
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        table = np.cumprod(steps, dtype=np.uint64)
        if size <= 4 * PIECE_BYTES:
            _powers[int(base)] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: polynomial prefix sums, so cost follows the bytes."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[raw] * _power_table(_P, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power_table(_P_INVERSE, len(raw))[starts])


def window_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``k`` consecutive word hashes (row borders are the caller's)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] + np.uint64(seed)
    for j in range(1, k):
        total = total * _P + words[j:n + j]
    return mix(total)


def run_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of runs of word hashes, of any lengths."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power_table(_P, len(words)), out=sums[1:])
    found = (sums[ends] - sums[starts]) * _power_table(_P_INVERSE, len(words))[starts]
    return mix(found + (ends - starts).astype(np.uint64))


def lowered_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' alphanumeric words (A-Z folded), and per row its first word."""
    raw, offsets = utf8(column)
    raw = LOWER[raw]
    starts, ends, bounds = word_spans(raw, offsets, ALPHANUMERIC)
    return span_hashes(raw, starts, ends), bounds


def least_grams(grams: np.ndarray, n: int, w: int) -> np.ndarray:
    """For each of ``n`` windows of ``w`` consecutive grams the place of its least one, the
    last of equal ones."""
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, w):
        here = grams[j:n + j]
        better = here <= least
        np.copyto(least, here, where=better)
        at[better] = np.flatnonzero(better) + j
    return at


def row_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of each word, from the rows' first words."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``start .. start + length - 1``."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - firsts, lengths)


class HashTable:
    """64-bit keys to 32-bit values, open-addressed, with vectorised insert and find."""

    def __init__(self, capacity: int, missing: int):
        bits = max(4, int(2 * capacity).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.int64)
        self.values = np.full(1 << bits, missing, np.int32)
        self.used = np.zeros(1 << bits, bool)
        self.missing, self.probes, self.count = missing, 0, 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) >> self.shift).astype(np.int64)

    def insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys; at most the capacity in all."""
        left, slot, step = np.arange(len(keys)), self._slots(keys), 0
        while len(left):
            _, first = np.unique(slot, return_index=True)
            wins = np.zeros(len(left), bool)
            wins[first] = True
            wins &= ~self.used[slot]
            self.keys[slot[wins]] = keys[left[wins]]
            self.values[slot[wins]] = values[left[wins]]
            self.used[slot[wins]] = True
            left, slot, step = left[~wins], (slot[~wins] + 1) & self.mask, step + 1
        self.probes = max(self.probes, step)
        self.count += len(keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key (a flat array), ``missing`` where there is none."""
        found = np.full(len(keys), self.missing, np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        for _ in range(self.probes):
            hit = (self.keys[slot] == keys[left]) & self.used[slot]
            found[left[hit]] = self.values[slot[hit]]
            on = ~hit & self.used[slot]
            if not on.any():
                break
            left, slot = left[on], (slot[on] + 1) & self.mask
        return found


class WordIds:
    """Ids of the blank-separated words of texts; each distinct word is encoded once while
    the table holds it.

    ``encode`` turns a list of distinct words into their ids in a row and the words' sizes.
    Words are told apart by two 64-bit hashes; the table starts anew when it holds ``limit``
    words.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 1 << 21):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.table = HashTable(self.limit, -1)
        self.second = np.zeros(0, np.uint64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        raw, offsets = utf8(column)
        starts, ends, bounds = word_spans(raw, offsets, NOT_BLANK)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        import pandas as pd  # only here: it is a third of a worker's memory at rest
        codes, keys = pd.factorize(span_hashes(raw, starts, ends).view(np.int64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_SECOND_CODES[raw])])
        second = sums[ends] - sums[starts]
        if self.table.count + len(keys) > self.limit:
            self._clear()
        places = self.table.find(keys)
        new = np.flatnonzero(places < 0)
        if len(new):
            first = np.full(len(keys), len(codes))
            np.minimum.at(first, codes, np.arange(len(codes)))
            at = first[new]
            text = raw.tobytes()
            ids, sizes = self.encode(
                [text[a:b].decode() for a, b in zip(starts[at], ends[at])])
            places[new] = len(self.sizes) + np.arange(len(new))
            self.table.insert(keys[new], places[new])
            self.second = np.concatenate([self.second, second[at]])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, ids])
        word = places[codes]
        if (self.second[word] != second).any():
            raise ValueError("two words share a 64-bit hash")
        lengths = self.sizes[word]
        total = np.concatenate([[0], np.cumsum(lengths)])
        firsts = np.cumsum(self.sizes) - self.sizes
        return self.ids[ragged(firsts[word], lengths)], np.diff(total[bounds])


class PieceIds:
    """Ids of text pieces; each distinct piece is encoded once while the cache holds it.

    ``encode`` turns a list of distinct pieces into their id arrays.  The cache starts anew
    when it holds ``limit`` pieces, so it never grows with the data.
    """

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], limit: int = 1 << 17):
        self.encode, self.limit = encode, limit
        self.known: dict[str, np.ndarray] = {}

    def __call__(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text (a list of its pieces)."""
        flat = np.array([*chain.from_iterable(texts)], dtype=object)
        if not len(flat):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        import pandas as pd
        codes, distinct = pd.factorize(flat)
        if len(self.known) > self.limit:
            self.known = {}
        new = [p for p in distinct if p not in self.known]
        self.known.update(zip(new, self.encode(new)))
        ids = [self.known[p] for p in distinct]
        sizes = np.array([len(i) for i in ids], np.int64)
        lengths = sizes[codes]
        starts = (np.cumsum(sizes) - sizes)[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return np.concatenate(ids)[ragged(starts, lengths)], np.diff(ends[borders])


def binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive byte strings as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    wide = pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return wide.cast(pa.binary())


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: computed once, and later
    steps start from files that survive any executor."""
    folder = shared_scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def annotate(docs: DataFrame, out: str, kind: StructType, text: str,
             fn: Callable[[pa.RecordBatch], pa.Array], limit: int = PIECE_BYTES,
             drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a struct column ``out`` computed by ``fn`` from pieces of rows.

    All other columns pass through unchanged; an input column already named ``out`` is
    replaced and those in ``drop`` are given to ``fn`` only.
    """
    docs = docs.drop(out)
    keep = [f for f in docs.schema.fields if f.name not in drop]
    schema = StructType([*keep, StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text, limit):
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(f.name) for f in keep), fn(piece)],
                    [*(f.name for f in keep), out])

    return docs.mapInArrow(run, schema)
