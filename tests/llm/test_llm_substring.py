"""op10 against a brute-force version on both paths, and the index itself."""

import hashlib
import random
import re

import numpy as np
import pytest

from quayside.llm import substring
from quayside.llm.fmindex import FMIndex, stream

WORD = re.compile(r"[^\x20\x09-\x0D]+")
T = substring.WINDOW
SCHEMA = "doc_id long, text string, doc string"


def brute(rows):
    first, docs = {}, []
    for d, text in rows:
        w = WORD.findall(text or "")
        docs.append((d, w))
        for k in range(len(w) - T + 1):
            key, at = tuple(w[k:k + T]), ((d is not None, d or 0), k)
            first[key] = min(first.get(key, at), at)
    out = []
    for d, w in docs:
        gone = set()
        for k in range(len(w) - T + 1):
            if first[tuple(w[k:k + T])] < ((d is not None, d or 0), k):
                gone.update(range(k, k + T))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def rows():
    rng = random.Random(17)
    say = lambda n, v=400: [f"w{rng.randint(0, v)}é" for _ in range(n)]
    passages = [say(n) for n in (19, 20, 21, 45, 120)]
    out = []
    for k in range(70):
        w = say(rng.randint(0, 60))
        for _ in range(rng.randint(0, 4)):
            p = list(rng.choice(passages))
            if rng.random() < 0.4 and p:
                p[rng.randrange(len(p))] = "edit"
            w += p + say(rng.randint(0, 10), 3)
        out.append((rng.randint(-10_000, 10_000) * 100 + k, "\n\t".join(w) + " "))
    base = say(200)
    for k in range(30):  # near copies
        w = list(base)
        for _ in range(3):
            w[rng.randrange(200)] = f"x{k}"
        out.append((2_000_000 + k, " ".join(w)))
    out += [(3_000_000, "for " * 100), (3_000_001, "a b " * 60), (3_000_002, None),
            (3_000_003, ""), (None, " ".join(base)), (3_000_004, " ".join(say(9_000, 40)))]
    return out


@pytest.mark.parametrize("options", [{}, {"shared_segments": 2}, {"shard_words": 300}])
def test_matches_brute_force(spark, options):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows()], SCHEMA)
    found = substring.remove_repeats(docs.repartition(4), **options)
    got = [(r.doc_id, r.repeats.n_words, r.repeats.n_removed,
            hashlib.sha256(r.repeats.kept.encode()).hexdigest()) for r in found.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute(rows())))


def test_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, repeats int")
    assert substring.remove_repeats(none).collect() == []
    same = [(1, " ".join(map(str, range(30))))] * 2
    got = substring.op10(spark.createDataFrame(same, "doc_id long, text string")).collect()
    assert [r.n_removed for r in got] == [0, 0]  # versions of one document


def test_rows_without_an_id_do_not_share_their_marks(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(25))
    data = [(None, passage + " " + " ".join(f"n{rng.randint(0, 9**6)}" for _ in range(30)), "d")
            for _ in range(300)]
    found = substring.remove_repeats(spark.createDataFrame(data, SCHEMA).repartition(3))
    gone = sorted(r.repeats.n_removed for r in found.collect())
    assert gone == [0] * 300  # one document by the order of ids: equal places, so versions
    later = [(None, "one more " + t, "d") for _, t, _ in data[:9]]
    found = substring.remove_repeats(spark.createDataFrame(data + later, SCHEMA))
    assert sorted({(r.text[:3], r.repeats.n_removed > 24) for r in found.collect()}) \
        == [("one", True), ("p0 ", False)]


def test_index_counts_matches():
    rng = np.random.default_rng(3)
    runs = [rng.integers(1, 4, n) for n in (30, 8, 50, 6, 5, 40)]
    text = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int64)
    sizes = np.array([len(r) for r in runs])
    starts = np.cumsum(sizes + 1) - sizes - 1
    depth = 5
    index = FMIndex(text, 4, depth)
    places = {}
    for k in range(len(text) - depth + 1):
        places.setdefault(tuple(text[k:k + depth]), set()).add(k)
    seen = 0
    for run, place, low in stream(index, text, starts, sizes, depth):
        for p, lo in zip(place, low):
            a, b = index.shorten(np.array([lo]))
            assert set(index.suffixes[a[0]:b[0]]) == places[tuple(text[p:p + depth])]
            seen += 1
    assert seen == (sizes - depth + 1).sum()
