"""op12 against brute force over all prefixes, with and without a sketch that tells anything."""

import hashlib
import random
import zlib

import pytest

from quayside.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, digest string, family int"


def frame(spark, data):
    return spark.createDataFrame([(*r, "d", 1) for r in data], SCHEMA).repartition(4)


def rebuilt(data):
    own = {}
    for c, turn, role, text in data:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(rows, key=lambda t: t[:2])] for c, rows in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), kids[p], leaves[p],
         saved[p], hashlib.sha256(",".join(
             str(c) for c in sorted(ids) if len(convs[c]) == len(p)).encode()).hexdigest())
        for p, ids in members.items())


def conversations():
    rng = random.Random(12)
    texts = ["a", "b", "é", "", "long " * 50]
    data = []
    for c in rng.sample(range(400), 260):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            data.append((c, t, rng.choice(["user", "bot"]), rng.choice(texts)))
    for c in range(1_000, 1_060):  # one conversation over and over
        data += [(c, 1, "user", "hello"), (c, 2, "bot", None), (c, 3, None, "bye")]
    data += [(2_000, t, "user", f"turn {t}") for t in range(300)]  # a very long one, and its copy
    data += [(2_005, t, "user", f"turn {t}") for t in range(300)]
    data += [(3_001, None, "user", "first"), (3_001, -5, "bot", "second"), (None, 1, "user", "x"),
             (3_006, 4, "user", "u: x"), (3_007, 4, "user: x", "u"), (3_002, 0, "", "1:a")]
    rng.shuffle(data)
    return data


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (*r[:2],))


def test_equals_brute_force(spark):
    data = conversations()
    assert collected(prefix_trie.op12(frame(spark, data))) == brute(rebuilt(data))


@pytest.mark.parametrize("bits, chunk", [(4, 7), (12, 50)])
def test_any_sketch_gives_the_same_nodes(spark, monkeypatch, bits, chunk):
    monkeypatch.setattr(prefix_trie, "LEAST_BITS", bits)
    monkeypatch.setattr(prefix_trie, "MOST_BITS", bits)
    data = conversations()[:700]
    assert collected(prefix_trie.op12(frame(spark, data))) == brute(rebuilt(data))


def test_an_estimate_of_one_is_proof_and_most_tails_have_it(spark):
    data = conversations()
    prefixes = prefix_trie.paths(frame(spark, data))
    rows = prefix_trie.screened(prefixes).collect()
    times = {}
    for r in rows:
        times[bytes(r.digest)] = times.get(bytes(r.digest), 0) + 1
    assert all(times[bytes(r.digest)] == 1 for r in rows if r.single)
    assert all(times[bytes(r.parent)] == 1 for r in rows if r.parent_single)
    alone = [r for r in rows if times[bytes(r.digest)] == 1]
    assert sum(r.single for r in alone) > 0.8 * len(alone)


def test_without_families_and_over_many_ends_of_a_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BITS", 3)
    monkeypatch.setattr(prefix_trie, "OUT_ROWS", 16)
    data = [r for r in conversations() if r[0] is not None]
    own = {}
    for c, turn, role, text in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    got = collected(prefix_trie.trie(prefix_trie.paths(frame(spark, data))))
    assert got == brute(own)


def test_odd_tables(spark):
    assert prefix_trie.op12(frame(spark, [])).collect() == []
    assert prefix_trie.op12(frame(spark, [(None, 1, "user", "x")])).collect() == []
    one = [(3, 0, "user", "x"), (3, 0, "user", "x"), (3, 0, "user", "x")]
    assert collected(prefix_trie.op12(frame(spark, one))) == brute(rebuilt(one))
    big = [(2**62 + k * 7, t, "user", "x") for k in range(40) for t in range(k % 3 + 1)]
    assert collected(prefix_trie.op12(frame(spark, big))) == brute(rebuilt(big))
    below = [(-7, t, "user", str(t)) for t in range(4)]  # of the family of -5, as SQL's % has it
    assert {r.conv_id for r in prefix_trie.trie(prefix_trie.paths(frame(spark, below))).collect()} \
        == {-7}
