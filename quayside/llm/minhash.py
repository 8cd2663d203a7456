"""op4: near-duplicate classes by consistent weighted sampling.

A text is a weighted set of shingles, five consecutive alphanumeric words each (a shorter text
is one shingle).  With ``idf="full"``, as the queries have it, a shingle weighs TF-IDF:
``1 + ln(times)`` by ``1 + ln((1 + texts) / (1 + df))``.  Its document frequency df is counted over
all texts: these are dealt at random into parts, a part's distinct shingles go by ranges of their
hashes to the tasks that add them up, and the sums come back to the part (``exact_signatures``).

With ``idf="damped"`` that factor spans the range 1 to ``1 + RARITY_SPAN`` only, and document
frequencies are known for the shingles of a ``1 / HEAVY`` share of all or more (``frequencies``):
for corpora whose large groups of near copies a full range would tear apart, as their shingles
are frequent just because of the group.

Improved consistent weighted sampling draws, for each of ``BANDS * ROWS`` hash functions, one
shingle with its quantised weight, such that two texts draw the same with the probability of
their weighted Jaccard similarity.  The random numbers come from a table over hashed shingles.
``ROWS`` draws make a band; texts that agree in a band meet in a bucket.

Texts with equal weighted sets are one node.  Buckets of up to ``SMALL`` nodes are compared in
full.  In a larger one each member is first compared with the bucket's ``LEADERS`` leaders,
those that meet most others, and with its ``BESIDE`` next in the order of the draws that follow
the band's own, which puts the most alike side by side.  What is then not one component is closed:
all pairs of unlike components of a bucket are compared, block by block, so that within a bucket
no pair is left out; pairs whose total weights alone rule a link out are skipped.  A pair whose
draws agree often enough is verified on the texts: a link is a weighted Jaccard similarity of
``SIMILARITY`` or more.  Classes are the connected components of the links; a class's id is its
least document id.

Results in the odd cases: texts without words (null and empty ones too) are duplicates of the
same bytes only; repeated rows and repeated ids are rows of their own; rows with a null id take
part as any others, but beside other ids a null one is never the class id (a class of null ids
only has a null class id); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, LongType, StructField,
                               StructType)

from quayside.llm import batches as B
from quayside.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
HASHES = BANDS * ROWS
HEAVY = 1 << 14  # shingles at most whose document frequency is known
COUNTED = 1 << 21  # shingles counted at once in a task
RARITY_SPAN = 0.2
PART_BYTES = 1 << 22  # text bytes of a part whose shingles are counted together
RANGE = 1 << 20  # shingles whose counts are added up in one group, about
CELLS = 1 << 12  # hashed shingles of the table of draws
LIKELY = 0.5  # share of agreeing draws from which a pair is verified
LEADERS = 4
SMALL = 9  # members of a bucket that is compared in full at once
BESIDE = 2  # next members in a larger bucket's order that each member is compared with
BLOCK = 128  # members a side of two blocks of a bucket that are compared in one task
SIGN_BYTES = 1 << 16


def shingle_sets(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct shingles (sorted hashes) and how often each occurs."""
    words, bounds = B.lowered_words(column)
    grams = B.window_hashes(words, SHINGLE, seed=SHINGLE)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        n = min(SHINGLE, int(b - a))
        found = grams[a:b - SHINGLE + 1] if n == SHINGLE else \
            B.window_hashes(words[a:b], n, seed=n) if n else words[:0]
        out.append(np.unique(found, return_counts=True))
    return out


@dataclass
class Rarity:
    """Rarity (0 for everywhere to 1) of the known shingles; all others have 1."""

    shingles: np.ndarray  # sorted
    values: np.ndarray
    span: float = RARITY_SPAN  # how far rarity raises a weight above 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.ones(len(hashes), np.float32)
        at = np.minimum(np.searchsorted(self.shingles, hashes), len(self.shingles) - 1)
        return np.where(self.shingles[at] == hashes, self.values[at], np.float32(1))


def frequencies(docs: DataFrame, text: str) -> Rarity:
    """Rarity of the shingles that make up ``1 / HEAVY`` or more of all (a text's distinct
    shingles count once).

    A task counts ``COUNTED`` shingles at once and sends those that it has met so often that
    the others of all tasks cannot add up to a sixteenth of that share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, texts, postings = [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(2, size // (16 * HEAVY))
            return rows(np.zeros(often.sum(), np.int32), found[often].view(np.int64), n[often])

        def rows(kind: np.ndarray, shingle: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(kind), pa.array(shingle), pa.array(n.astype(np.int64))],
                ["kind", "shingle", "n"])

        for batch in batches:
            for piece in B.pieces(batch, text):
                sets = shingle_sets(piece.column(text))
                held.append(np.concatenate([s for s, _ in sets]))
                texts, size = texts + len(sets), size + len(held[-1])
                if size >= COUNTED:
                    yield flush()
                    held, size, postings = [], 0, postings + size
        if size:
            yield flush()
        yield rows(np.array([1, 2], np.int32), np.zeros(2, np.int64),
                   np.array([texts, postings + size]))

    counted = (docs.select(text).mapInArrow(run, "kind int, shingle long, n long")
               .groupBy("kind", "shingle").agg(F.sum("n").alias("n")))
    # Shingles with that share of all are HEAVY at most; the two totals are above them.
    top = counted.orderBy(F.desc("n")).limit(HEAVY + 2).collect()
    texts, postings = (max([r["n"] for r in top if r["kind"] == k], default=0) for k in (1, 2))
    heavy = sorted((r["shingle"] % (1 << 64), r["n"]) for r in top
                   if r["kind"] == 0 and r["n"] * HEAVY >= postings)
    n = np.array([x for _, x in heavy], float)
    return Rarity(np.array([x for x, _ in heavy], np.uint64),
                  (np.log((1 + texts) / (1 + n)) / np.log(1 + texts)).astype(np.float32))


def weights(hashes: np.ndarray, times: np.ndarray, rarity: Rarity) -> np.ndarray:
    return (1 + np.log(times)) * (1 + rarity.span * rarity.of(hashes))


class Draws:
    """The random numbers of consistent weighted sampling per shingle cell and hash function."""

    def __init__(self, seed: int = 4):
        rng = np.random.default_rng(seed)
        r, c = rng.gamma(2, 1, (2, CELLS, HASHES))
        beta = rng.random((CELLS, HASHES))
        self.per, self.beta, self.step, self.base = (
            x.astype(np.float32) for x in (1 / r, beta, r, np.log(c) - r + r * beta))

    def sign(self, sets: list[tuple[np.ndarray, np.ndarray]], rarity: Rarity) \
            -> tuple[np.ndarray, np.ndarray]:
        """One draw a text and hash function (zeros without shingles), and total weights."""
        signs = np.full((len(sets), HASHES), np.uint64(np.iinfo(np.uint64).max))
        sizes = np.array([len(s) for s, _ in sets])
        some, totals = np.flatnonzero(sizes), np.zeros(len(sets))
        if len(some):
            hashes = np.concatenate([sets[k][0] for k in some])
            times = np.concatenate([sets[k][1] for k in some])
            heavy = weights(hashes, times, rarity)
            at = (hashes & np.uint64(CELLS - 1)).astype(np.int64)
            quantum = self.per[at]
            quantum *= np.log(heavy).astype(np.float32)[:, None]
            quantum += self.beta[at]
            np.floor(quantum, out=quantum)
            order = self.step[at]
            order *= quantum
            np.subtract(self.base[at], order, out=order)
            firsts = np.cumsum(sizes[some]) - sizes[some]
            totals[some] = np.add.reduceat(heavy, firsts)
            least = np.minimum.reduceat(order, firsts, axis=0)
            row = np.repeat(np.arange(len(some)), sizes[some])
            shingle, function = np.nonzero(order == least[row])
            drawn = B.mix(hashes[shingle] + quantum[shingle, function].astype(np.int64).view(np.uint64)
                          * np.uint64(0xD6E8FEB86659FD93))
            np.minimum.at(signs, (some[row[shingle]], function), drawn)
        signs[sizes == 0] = 0
        return signs, totals


def band_keys(signs: np.ndarray) -> np.ndarray:
    grouped = signs.reshape(len(signs), BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(signs), 1), np.uint64)
    for k in range(ROWS):
        keys = B.mix(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return keys


def node_ids(column: pa.Array, sets: list) -> np.ndarray:
    """Equal for equal weighted shingle sets; for texts without words, for equal bytes."""
    raw, offsets = B.utf8(column)
    out = np.zeros(len(sets), np.uint64)
    for k, (hashes, times) in enumerate(sets):
        if len(hashes):
            out[k] = B.mix(hashes + times.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)).sum()
        elif offsets[k + 1] > offsets[k]:
            out[k] = B.span_hashes(raw[offsets[k]:offsets[k + 1]], np.array([0]),
                                   np.array([offsets[k + 1] - offsets[k]]))[0]
    return B.mix(out + np.array([len(s) for s, _ in sets], np.uint64))


def signed_type(docs: DataFrame, keys: list[str]) -> StructType:
    return StructType([*(docs.schema[k] for k in keys), StructField("node", LongType()),
                       StructField("bands", ArrayType(LongType())),
                       StructField("draws", BinaryType()), StructField("total", DoubleType()),
                       StructField("weights", BinaryType())])


def signed(piece: pa.RecordBatch, keys: list[str], text: str, sets: list, draws: Draws,
           rarity: Rarity) -> pa.RecordBatch:
    """(keys, node, bands, draws, total, weights): a node id, the band keys, 16 bits of every
    draw, the total weight, and the weights of the shingles in their order (float32)."""
    signs, totals = draws.sign(sets, rarity)
    bands = band_keys(signs).view(np.int64)
    bare = np.array([not len(s) for s, _ in sets])
    offsets = np.concatenate([[0], np.cumsum(np.where(bare, 0, BANDS))])
    return pa.RecordBatch.from_arrays(
        [*(piece.column(k) for k in keys), pa.array(node_ids(piece.column(text), sets).view(np.int64)),
         pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                  pa.array(bands[~bare].reshape(-1))),
         pa.array([s.tobytes() for s in signs.astype(np.uint16)], pa.binary()), pa.array(totals),
         pa.array([weights(*s, rarity).astype(np.float32).tobytes() for s in sets], pa.binary())],
        [*keys, "node", "bands", "draws", "total", "weights"])


def signatures(docs: DataFrame, keys: list[str], text: str, rarity: Rarity) -> DataFrame:
    """``signed`` rows of all texts."""
    docs = docs.select(*keys, text)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)  # HEAVY entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = Draws()
        for batch in batches:
            for piece in B.pieces(batch, text, SIGN_BYTES):
                yield signed(piece, keys, text, shingle_sets(piece.column(text)), draws,
                             shared.value)

    return docs.mapInArrow(run, signed_type(docs, keys))


def planes(numbers: np.ndarray) -> bytes:
    """The numbers' bytes by significance: the high ones of sorted hashes and of small counts
    are alike, so the exchange's compression takes them away."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).reshape(-1)


def part_sets(table: pa.Table, text: str) \
        -> tuple[list[tuple[pa.RecordBatch, list]], np.ndarray, np.ndarray]:
    """Of a part's texts the pieces with their shingle sets, and the distinct shingles (sorted)
    with the number of texts that have them."""
    held = [(piece, shingle_sets(piece.column(text))) for batch in table.to_batches()
            if batch.num_rows for piece in B.pieces(batch, text, SIGN_BYTES)]
    found, n = np.unique(np.concatenate([s for _, sets in held for s, _ in sets]),
                         return_counts=True)
    return held, found, n


def exact_signatures(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``signed`` rows of all texts, weighted by the exact document frequency of every shingle.

    The texts are dealt into parts by chance, so that copies and equal ids don't meet in one.
    """
    size = docs.agg(F.count("*").alias("texts"), F.sum(F.octet_length(text)).alias("all")).first()
    texts, size = size["texts"], size["all"] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-size // PART_BYTES), min(2 * cores, -(-size // (PART_BYTES >> 3))), 1)
    # A shingle has some seven bytes of text, so a range of hashes has about RANGE of the parts'.
    bits = max(4, (size // (8 * RANGE)).bit_length())
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    span = float(np.log(1 + texts))
    dealt = docs.select(*keys, text, (F.rand(4) * parts).cast("int").alias("part"))
    kind = signed_type(docs, keys)

    def count(table: pa.Table) -> pa.Table:
        _, found, n = part_sets(table, text)
        cuts = np.concatenate([[0], np.searchsorted(found, edges), [len(found)]])
        some = np.flatnonzero(np.diff(cuts))
        blobs = [[planes(x[cuts[k]:cuts[k + 1]]) for k in some] for x in (found, n.astype(np.int64))]
        return pa.table([pa.array(np.full(len(some), table.column("part")[0].as_py(), np.int32)),
                         pa.array(some.astype(np.int32)), *(pa.array(x, pa.binary()) for x in blobs)],
                        ["part", "range", "shingles", "n"])

    def add_up(table: pa.Table) -> pa.Table:
        held = [from_planes(x.as_py(), np.uint64) for x in table.column("shingles")]
        n = np.concatenate([from_planes(x.as_py(), np.int64) for x in table.column("n")])
        place = np.unique(np.concatenate(held), return_inverse=True)[1]
        total = np.bincount(place, n).astype(np.int64)[place]
        ends = np.cumsum([len(x) for x in held])[:-1]
        return table.select(["part", "range"]).append_column(
            "n", pa.array([planes(x) for x in np.split(total, ends)], pa.binary()))

    def sign(table: pa.Table, sums: pa.Table) -> pa.Table:
        held, found, _ = part_sets(table, text)
        sums = sums.sort_by("range").column("n")
        n = np.concatenate([np.zeros(0, np.int64), *(from_planes(x.as_py(), np.int64) for x in sums)])
        if len(n) != len(found):
            raise ValueError("a part's texts differ from those that were counted")
        rarity = Rarity(found, (np.log((1 + texts) / (1 + n)) / span).astype(np.float32), span)
        draws = Draws()
        return pa.Table.from_batches([signed(piece, keys, text, sets, draws, rarity)
                                      for piece, sets in held])

    sums = (dealt.groupBy("part").applyInArrow(count, "part int, range int, shingles binary, n binary")
            .groupBy("range").applyInArrow(add_up, "part int, range int, n binary"))
    return dealt.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(sign, kind)


def agreeing(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, with draws a_draws, b_draws) that agree in enough draws."""
    own = [f for f in pairs.schema.fields if f.name not in ("a_draws", "b_draws")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16)
                        .reshape(-1, HASHES) for c in ("a_draws", "b_draws"))
                yield batch.select([f.name for f in own]).filter(
                    pa.array((a == b).mean(axis=1) >= LIKELY))

    return pairs.mapInArrow(run, StructType(own))


def verified(pairs: DataFrame) -> DataFrame:
    """(u, v, similarity) of the pairs (a, b, with texts and weights of both) that are links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in B.pieces(batch, "a_text", SIGN_BYTES):
                left, right = (shingle_sets(piece.column(c)) for c in ("a_text", "b_text"))
                alike = np.zeros(piece.num_rows)
                heavy = [[np.frombuffer(w.as_py(), np.float32).astype(float) for w in piece.column(c)]
                         for c in ("a_weights", "b_weights")]
                for k, ((x, _), (y, _), wx, wy) in enumerate(zip(left, right, *heavy)):
                    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                    both = np.minimum(wx[i], wy[j]).sum()
                    alike[k] = both / (wx.sum() + wy.sum() - both)
                links = alike >= SIMILARITY
                if links.any():
                    yield pa.RecordBatch.from_arrays(
                        [*(piece.column(c).filter(pa.array(links)) for c in ("a", "b")),
                         pa.array(alike[links])], ["u", "v", "similarity"])

    return pairs.mapInArrow(run, "u long, v long, similarity double")


def beside(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of members near each other in their buckets' orders.

    ``rows`` has band (key), turn (the band's number), node, draws and count (members of the
    bucket).  Buckets of up to ``SMALL`` members stay whole in a task and are compared in full.  The order of the larger ones is global, by band and then the draws from the band's own on, so
    that a bucket is spread over tasks; members on either side of a task's border are not compared
    in this order but, where they stay of unlike components, by ``closing``.
    """
    columns = ["band", "node", "turned"]
    kind = StructType([StructField("a", LongType()), StructField("b", LongType())])
    order = F.concat(F.substring("draws", F.col("turn") * 2 * ROWS + 1, F.lit(2 * HASHES)),
                     F.substring("draws", F.lit(1), F.col("turn") * 2 * ROWS))

    def run(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
        tail = None  # the last rows of the batch before
        for batch in batches:
            if tail is not None:
                batch = pa.concat_batches([tail, batch.select(columns)])
            tail = batch.select(columns).slice(max(0, batch.num_rows - reach))
            band, node = (batch.column(c).to_numpy() for c in columns[:2])
            draws = np.frombuffer(b"".join(batch.column("turned").to_pylist()),
                                  np.uint16).reshape(-1, HASHES)
            for k in range(1, reach + 1):
                near = np.flatnonzero(band[:-k] == band[k:])
                likely = (draws[near] == draws[near + k]).mean(axis=1) >= LIKELY
                near = near[likely]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(node[near], node[near + k])),
                     pa.array(np.maximum(node[near], node[near + k]))], ["a", "b"])

    turned = rows.select("band", "node", order.alias("turned"), "count")
    small = F.col("count") <= SMALL
    near = turned.where(small).repartition("band").sortWithinPartitions("band", "turned")
    far = (turned.where(~small).repartitionByRange("band", "turned")
           .sortWithinPartitions("band", "turned"))
    return (near.mapInArrow(lambda b: run(b, SMALL - 1), kind)
            .union(far.mapInArrow(lambda b: run(b, BESIDE), kind)))


def block_pairs(held: DataFrame) -> DataFrame:
    """``held`` (band, node, component) of the larger buckets that are not one component, dealt
    out as pairs of blocks (x, y).

    Members outside of a bucket's largest component make blocks x, its own members blocks y >= 0;
    y < 0 is the block ``-1 - y`` of the outside again.  Every two members of unlike components
    meet in just one pair of blocks: on unlike sides, or, of one outside block, where y is 0.
    """
    parts = held.groupBy("band", "component").count()
    dealt = (parts.groupBy("band").agg(F.max(F.struct("count", "component")).alias("most"),
                                       F.sum("count").alias("all"))
             .where((F.col("all") > SMALL) & (F.col("all") > F.col("most.count")))
             .select("band", F.col("most.component").alias("most"),
                     F.ceil(F.col("most.count") / BLOCK).cast("int").alias("inner"),
                     F.ceil((F.col("all") - F.col("most.count")) / BLOCK).cast("int").alias("outer")))
    inside = F.col("component") == F.col("most")
    block = F.pmod(F.xxhash64("node"), F.when(inside, F.col("inner")).otherwise(F.col("outer")))
    placed = held.join(dealt, "band").withColumn("block", block.cast("int"))
    at = F.when(inside, F.expr("""transform(sequence(0, `outer` - 1), i ->
                struct(i AS x, block AS y, 1 AS side))""")).otherwise(F.expr("""concat(
            transform(sequence(0, `inner` - 1), j -> struct(block AS x, j AS y, 0 AS side)),
            transform(filter(sequence(0, `outer` - 1), i -> i != block), i ->
                struct(least(block, i) AS x, -1 - greatest(block, i) AS y,
                       IF(block < i, 0, 1) AS side)))"""))
    return placed.select(*held.columns, F.explode(at).alias("at")).select(*held.columns, "at.*")


def closing(rows: DataFrame) -> DataFrame:
    """Links (u, v, similarity) that join the components of the rows of ``block_pairs``.

    ``rows`` also has turn, bands, draws, total, text and weights.  A pair is compared in the first band that
    its members share; links within what other links of the same two blocks have joined are left
    out.
    """
    shape = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("similarity", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        node, part, side, total = (table.column(c).to_numpy() for c in (
            "node", "component", "side", "total"))
        bands = np.array(table.column("bands").to_pylist(), np.int64).reshape(-1, BANDS)
        draws = np.frombuffer(b"".join(table.column("draws").to_pylist()),
                              np.uint16).reshape(-1, HASHES)
        likely = np.triu(part[:, None] != part)
        if table.column("y")[0].as_py():
            likely &= side[:, None] != side
        # No similarity is above the ratio of the total weights.
        likely &= np.minimum(total[:, None], total) >= (SIMILARITY - 1e-9) * np.maximum(
            total[:, None], total)
        for t in range(table.column("turn")[0].as_py()):
            likely &= bands[:, t, None] != bands[:, t]
        for i in np.flatnonzero(likely.any(axis=1)):
            likely[i] &= (draws == draws[i]).mean(axis=1) >= LIKELY
        # Only members of likely pairs are read.
        some = np.flatnonzero(likely.any(axis=0) | likely.any(axis=1))
        if not len(some):
            return shape.empty_table()
        sets = shingle_sets(table.column("text").combine_chunks().take(pa.array(some)))
        node, part, likely = node[some], part[some], likely[np.ix_(some, some)]
        sizes = np.array([len(s) for s, _ in sets])
        column_of = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True)[1]
        heavy = np.frombuffer(b"".join(table.column("weights").take(pa.array(some)).to_pylist()),
                              np.float32).astype(float)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        total = np.add.reduceat(heavy, bounds[:-1])
        dense = np.zeros(column_of.max() + 1)
        out = []
        for i in np.flatnonzero(likely.any(axis=1)):
            near = np.flatnonzero(likely[i] & (part != part[i]))
            if not len(near):
                continue
            mine = slice(bounds[i], bounds[i + 1])
            dense[column_of[mine]] = heavy[mine]
            theirs = B.ragged(bounds[near], sizes[near])
            starts = np.cumsum(sizes[near]) - sizes[near]
            both = np.add.reduceat(np.minimum(dense[column_of[theirs]], heavy[theirs]), starts)
            alike = both / (total[i] + total[near] - both)
            dense[column_of[mine]] = 0
            for k in np.flatnonzero(alike >= SIMILARITY):
                j = near[k]
                if part[i] != part[j]:
                    out.append((node[i], node[j], alike[k]))
                    part = np.where(part == part[j], part[i], part)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), shape)], schema=shape) \
            if out else shape.empty_table()

    return rows.groupBy("band", "x", "y").applyInArrow(run, "u long, v long, similarity double")


def links(docs: DataFrame, nodes: DataFrame, weighed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links between nodes, and the nodes' components (node, component).

    ``docs`` has text and text_hash, ``nodes`` a text_hash for each node, ``weighed`` the weights
    of each node's shingles, once or oftener.
    """
    rows = nodes.select(F.posexplode("bands").alias("turn", "band"), "node")
    met = B.saved(rows.join(rows.groupBy("band").count().where("count > 1"), "band"), "met")
    standing = met.groupBy("node").agg(F.sum("count").alias("standing"))
    brief = B.saved(standing.join(nodes, "node"), "standing")
    # Only nodes that met another are ever verified; a text of many copies is read once.
    texts = B.saved(docs.select("text_hash", F.coalesce("text", F.lit("")).alias("text"))
                    .join(brief.select("node", "text_hash").hint("merge"), "text_hash")
                    .groupBy("node").agg(F.first("text").alias("text"))
                    .join(weighed.groupBy("node").agg(F.first("weights").alias("weights"))
                          .hint("merge"), "node"), "met-texts")

    def side(pairs: DataFrame, table: DataFrame, name: str) -> DataFrame:
        """``pairs`` with the columns of ``table`` for the node in its column ``name``."""
        named = table.select(*[F.col(c).alias(name if c == "node" else f"{name}_{c}")
                               for c in table.columns])
        # Texts are dealt out at every size, so that a run on little data tells of one on much.
        return pairs.join(named.hint("merge") if "text" in table.columns else named, name)

    large = met.where(F.col("count") > SMALL)
    leaders = (large.join(brief.select("node", "standing"), "node")
               .groupBy("band", F.pmod("node", F.lit(LEADERS)).alias("part"))
               .agg(F.max(F.struct("standing", "node")).alias("leader"))
               .select("band", F.col("leader.node").alias("b")))
    led = large.join(leaders, "band").where("node != b").select(
        F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    drawn = brief.select("node", "draws")
    pairs = led.union(beside(met.join(drawn, "node"))).distinct()
    likely = agreeing(side(side(pairs, drawn, "a"), drawn, "b"))
    found = B.saved(verified(side(side(likely, texts, "a"), texts, "b")), "links")
    labels = components(found.select("u", "v"))
    held = large.join(labels, "node", "left").select(
        "band", "turn", "node", F.coalesce("component", "node").alias("component"))
    dealt = block_pairs(held).join(brief.select("node", "bands", "draws", "total"), "node")
    new = B.saved(closing(dealt.join(texts.hint("merge"), "node")), "closing")
    if new.isEmpty():
        return found, labels
    # What the closing joins are components: a graph of its own, mostly a small one.
    home = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of"))
    joined = new.join(home("u"), "u", "left").join(home("v"), "v", "left").select(
        F.coalesce("u_of", "u").alias("u"), F.coalesce("v_of", "v").alias("v"))
    merged = components(joined).select(F.col("node").alias("component"),
                                       F.col("component").alias("merged"))
    ends = new.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = labels.join(ends, "node", "full_outer").withColumn(
        "component", F.coalesce("component", "node"))
    return found.union(new), labels.join(merged, "component", "left").select(
        "node", F.coalesce("merged", "component").alias("component"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                    idf: str = "damped") -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, node, class_id, class_size, first) for every row, and the links.

    ``idf`` is "full" (TF-IDF over exact document frequencies) or "damped".

    ``first`` is true for the rows of least id and text hash in their class: one row, or some
    that are equal.  Links (u, v, similarity) are between nodes.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.xxhash64(F.col(text)).alias("text_hash"))
    if idf not in ("full", "damped"):
        raise ValueError(f"idf is full or damped, not {idf}")
    keys = ["doc_id", "text_hash"]
    weighed = exact_signatures(docs, keys, "text") if idf == "full" else \
        signatures(docs, keys, "text", frequencies(docs, "text"))
    rows = B.saved(weighed, "signatures")
    nodes = B.saved(rows.groupBy("node").agg(
        F.min("text_hash").alias("text_hash"), F.first("bands").alias("bands"),
        F.first("draws").alias("draws"), F.first("total").alias("total")), "nodes")
    found, labels = links(docs, nodes, rows.select("node", "weights"))
    placed = rows.select("doc_id", "text_hash", "node").join(
        labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = B.saved(placed.groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
        F.min(place).alias("least")), "classes")
    return placed.join(classes, "component").select(
        "doc_id", "text_hash", "node", "class_id", "class_size",
        place.eqNullSafe(F.col("least")).alias("first")), found


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                idf: str = "damped") -> DataFrame:
    """One row of ``docs`` for each class of near duplicates: that of its least id."""
    classes, _ = near_duplicates(docs, doc_id=doc_id, text=text, idf=idf)
    firsts = classes.where("first").select(F.col("doc_id").alias("_id"),
                                           F.col("text_hash").alias("_hash"))
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_hash"))
    kept = docs.join(firsts.distinct(), same, "left_semi")
    # Rows that are equal in id and text are one document.
    return (kept.withColumn("_hash", F.xxhash64(F.col(text)))
            .dropDuplicates([doc_id, "_hash"]).drop("_hash"))


def op4(docs: DataFrame, idf: str = "damped") -> DataFrame:
    """One row per document: its class and that class's size."""
    classes, _ = near_duplicates(docs, idf=idf)
    return classes.select("doc_id", "class_id", "class_size")
