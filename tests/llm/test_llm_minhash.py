"""op4 against brute force over all pairs, components, and odd cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import minhash
from quayside.llm.components import components

RARE = minhash.Rarity(np.zeros(0, np.uint64), np.zeros(0, np.float32))
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    """Shingle -> times, of the words of a text (of its bytes, if it has none)."""
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return {text or "": 1}
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def weighted(sets):
    """The weights by full counts: frequent shingles by their frequency, all others as rare."""
    seen = Counter(g for s in sets for g in s)
    share = sum(map(len, sets)) / minhash.HEAVY
    texts = len(sets)

    def weight(g, n):
        df = seen[g] if seen[g] >= share and seen[g] >= 2 else 0
        rarity = math.log((1 + texts) / (1 + df)) / math.log(1 + texts) if df else 1
        return (1 + math.log(n)) * (1 + minhash.RARITY_SPAN * rarity)

    return [{g: weight(g, n) for g, n in s.items()} for s in sets]


def similarity(x, y):
    both = sum(min(w, y[g]) for g, w in x.items() if g in y)
    return both / (sum(x.values()) + sum(y.values()) - both)


def near_classes(rows):
    """Classes linked by weighted similarity over all pairs, as the least position of each."""
    sets, home = weighted([shingles(t) for _, t in rows]), list(range(len(rows)))

    def top(k):
        while home[k] != k:
            k = home[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                home[max(top(i), top(j))] = min(top(i), top(j))
    return [top(k) for k in range(len(rows))]


def rows():
    rng = random.Random(23)
    say = lambda n: [f"v{rng.randint(0, 5000)}" for _ in range(n)]
    out, boiler = [], say(40)
    for _ in range(60):
        out.append(" ".join(say(rng.randint(20, 200))))
        out.append(" ".join(boiler + say(rng.randint(5, 60))))
    hub = say(300)
    for k in range(60):  # copies of one text, each with edits of its own: far from each other
        w = list(hub)
        for _ in range(6):
            w[rng.randrange(300)] = f"e{k}"
        out.append(" ".join(w))
    out += [" ".join(hub), " ".join(hub).upper() + "!", "one two", "ONE, two", "three", "", "", "??",
            "a a a a a a a a"]
    rng.shuffle(out)
    return [(k * 3, t) for k, t in enumerate(out)]


def test_classes_equal_brute_force(spark):
    data = rows()
    classes = {r.doc_id: r.class_id for r in minhash.op4(
        spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()}
    expected = near_classes(data)
    assert [classes[d] for d, _ in data] == [data[k][0] for k in expected]


def test_deduplicate_keeps_one_row_a_class_and_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(100))
    other = " ".join(f"n{k}" for k in range(100))
    data = [(1, long, "x"), (2, long, "y"), (2, long + " z", "y"), (None, long, "n"),
            (None, "alone here", "n"), (None, "alone here", "n"), (7, None, "c"), (8, "", "c"),
            (9, "other words entirely, six of them", None), (None, other, "n"),
            (None, other + " and more", "n"), (10, long * 4_000, "very long"),
            (11, long * 4_000 + " end", "very long")]
    docs = spark.createDataFrame(data, "doc_id long, text string, node string")
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted(map(repr, [(r.doc_id, r.text) for r in kept.collect()]))
    # Rows without an id are compared as all others are; one of their near copies stays.
    least = min([other, other + " and more"], key=lambda t: spark.range(1).select(
        F.xxhash64(F.lit(t))).first()[0])
    assert got == sorted(map(repr, [(1, long), (None, "alone here"), (7, None), (None, least),
                                    (9, "other words entirely, six of them"),
                                    (10, long * 4_000)]))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.op4(none).collect() == [] and minhash.deduplicate(none).collect() == []


def test_draws_agree_as_weighted_similarity():
    rng = np.random.default_rng(1)
    draws, rarity = minhash.Draws(), RARE
    x = np.sort(rng.integers(0, 1 << 64, 3000, np.uint64))
    y = np.sort(np.concatenate([x[:2600], rng.integers(0, 1 << 64, 300, np.uint64)]))
    ones = lambda s: (s, np.ones(len(s), np.int64))
    (a, b), totals = draws.sign([ones(x), ones(y)], rarity)
    assert np.allclose(totals, [3000 * 1.2, 2900 * 1.2])
    expected = 2600 / 3300
    assert abs((a == b).mean() - expected) < 0.15


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(100, 140)]
    star = [(500, k) for k in range(501, 560)]
    links = spark.createDataFrame(path + star + [(7, 7), (3, 2)], "u long, v long")
    got = {r.node: r.component for r in components(links).collect()}
    assert {got[k] for k in range(100, 141)} == {100} and {got[k] for k in range(500, 560)} == {500}
    assert got[3] == got[2] == 2
    assert components(links.where(F.lit(False))).collect() == []


def crowd():
    """Copies of one text below 0.8 to each other, and some pairs among them just above it."""
    rng = random.Random(5)
    hub, out = [f"h{k}" for k in range(200)], []
    for k in range(400):
        w = list(hub)
        for at in rng.sample(range(0, 200, 8), 4):
            w[at] = f"e{k}"
        out.append(" ".join(w))
        if k % 4 == 0:
            for at in rng.sample(range(4, 200, 8), 4):
                w[at] = f"f{k}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return list(enumerate(out))


def test_every_pair_of_a_large_bucket_is_compared(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LEADERS", 1)  # so that the cheap round leaves much over
    monkeypatch.setattr(minhash, "BESIDE", 1)
    monkeypatch.setattr(minhash, "BLOCK", 50)
    data = crowd()
    classes = {r.doc_id: r.class_id for r in minhash.op4(
        spark.createDataFrame(data, "doc_id long, text string").repartition(3)).collect()}
    assert [classes[d] for d, _ in data] == near_classes(data)


def test_block_pairs_bring_every_unlike_pair_together_once(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    held = [(1, k, 0 if k < 40 else k % 9 + 1) for k in range(90)] + [(2, k, k) for k in range(30)]
    rows = minhash.block_pairs(spark.createDataFrame(held, "band long, node long, component long"))
    groups = {}
    for r in rows.collect():
        groups.setdefault((r.band, r.x, r.y), []).append(r)
    met = [(band, *sorted((a.node, b.node))) for (band, _, y), g in groups.items()
           for i, a in enumerate(g) for b in g[:i]
           if a.component != b.component and (y == 0 or a.side != b.side)]
    expected = {(g, a, b) for g, a, c in held for h, b, d in held if g == h and a < b and c != d}
    assert len(met) == len(set(met)) and set(met) == expected


def test_small_buckets_are_compared_in_full_whatever_the_partitions(spark):
    draws = np.arange(minhash.HASHES - 1, dtype=np.uint16).tobytes()
    rows = [(band, 0, band * 9 + k, bytearray(draws + bytes([k, 0])), 9)
            for band in range(60) for k in range(9)]
    held = spark.createDataFrame(
        rows, "band long, turn int, node long, draws binary, count long")
    confs = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.enabled": "false"}
    before = {c: spark.conf.get(c) for c in confs}
    try:
        for c, v in confs.items():
            spark.conf.set(c, v)
        got = {tuple(r) for r in minhash.beside(held).collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert got == {(band * 9 + i, band * 9 + j) for band in range(60) for j in range(9)
                   for i in range(j)}


@pytest.mark.parametrize("n", [300, 1200])
def test_known_frequencies_are_those_of_all_frequent_shingles(spark, n, monkeypatch):
    monkeypatch.setattr(minhash, "HEAVY", 64)
    rng = random.Random(n)
    words = [f"w{k}" for k in range(40)]
    passages = [" ".join(rng.choices(words, k=9)) for _ in range(60)]
    texts = [" ".join([rng.choice(passages[:1 + rng.randrange(60)]) for _ in range(4)]
                      + [f"own{k}" for k in range(rng.randint(0, 30))]) for _ in range(n)]
    found = minhash.frequencies(spark.createDataFrame([(t,) for t in texts], "text string")
                                .repartition(5), "text")
    sets = [minhash.shingle_sets(pa.array([t]))[0][0].tolist() for t in texts]
    seen = Counter(g for s in sets for g in s)
    share = sum(map(len, sets)) / 64
    heavy = {g: c for g, c in seen.items() if c >= 1.1 * share}
    known = dict(zip(found.shingles.tolist(), found.values.tolist()))
    assert heavy and set(heavy) <= set(known) and len(known) <= 64
    truth = {g: math.log((1 + n) / (1 + c)) / math.log(1 + n) for g, c in seen.items()}
    assert all(abs(known[g] - truth[g]) < 0.05 for g in heavy)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_rarity_follows_the_truth_over_all_occurrences(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    found = minhash.frequencies(docs, "text")
    sets = [minhash.shingle_sets(pa.array([r.text]))[0][0] for r in docs.select("text").collect()]
    every, times = np.unique(np.concatenate(sets), return_counts=True)
    truth = np.log((1 + len(sets)) / (1 + times)) / np.log(1 + len(sets))
    mine = found.of(every)
    assert np.corrcoef(np.repeat(mine, times), np.repeat(truth, times))[0, 1] > 0.4


def test_links_of_the_supplied_documents_are_found(spark):
    """Of all pairs of weighted similarity 0.8 or more nine tenths are in one class."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    classes = {r.doc_id: r.class_id for r in minhash.op4(docs).collect()}
    rarity = minhash.frequencies(docs, "text")
    rows, seen = [], {}
    for r in docs.collect():
        hashes, times = minhash.shingle_sets(pa.array([r.text]))[0]
        held = dict(zip(hashes.tolist(), minhash.weights(hashes, times, rarity).tolist()))
        met = {k for g in held for k in seen.get(g, ())}
        for k in met:
            rows[k][2].append((r.doc_id, similarity(rows[k][1], held)))
        for g in held:
            seen.setdefault(g, []).append(len(rows))
        rows.append((r.doc_id, held, []))
    pairs = [(d, e) for d, _, near in rows for e, s in near if s >= 0.8]
    assert len(pairs) > 50
    assert sum(classes[d] == classes[e] for d, e in pairs) >= 0.9 * len(pairs)
