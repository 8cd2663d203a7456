"""op4 by full TF-IDF: exact document frequencies of every shingle, and classes by brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from quayside.llm import catalog, minhash

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return {text or "": 1}
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def near_classes(texts):
    """The least position of each text's class, by TF-IDF weighted similarity of all pairs."""
    sets = [shingles(t) for t in texts]
    df = Counter(g for s in sets for g in s)
    sets = [{g: (1 + math.log(n)) * (1 + math.log((1 + len(texts)) / (1 + df[g])))
             for g, n in s.items()} for s in sets]
    home = list(range(len(sets)))

    def top(k):
        while home[k] != k:
            k = home[k]
        return k

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = sum(min(w, y[g]) for g, w in x.items() if g in y)
            if both >= 0.8 * (sum(x.values()) + sum(y.values()) - both):
                home[max(top(i), top(j))] = min(top(i), top(j))
    return [top(k) for k in range(len(sets))]


def texts():
    """A group of copies with edits of their own, far apart only by full TF-IDF; and pairs."""
    rng = random.Random(31)
    say = lambda n: [f"v{rng.randint(0, 4000)}" for _ in range(n)]
    hub, out = say(300), []
    for k in range(50):
        w = list(hub)
        for _ in range(4):
            w[rng.randrange(300)] = f"e{k}"
        out.append(" ".join(w))
    for k in range(40):
        w = say(120)
        out += [" ".join(w), " ".join([*w[:-k % 13], "end"]) + " again" * (k % 3)]
    out += [" ".join(hub), " ".join(hub).upper(), "one two", "One, two", "", "??"]
    rng.shuffle(out)
    return out


def test_classes_equal_brute_force_by_full_tf_idf(spark):
    data = texts()
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in minhash.op4(docs, idf="full").collect()}
    assert [got[k] for k in range(len(data))] == near_classes(data)


@pytest.mark.parametrize("part, size", [(1 << 23, 1 << 20), (1 << 12, 1 << 6)])
def test_every_shingle_weighs_by_its_exact_document_frequency(spark, monkeypatch, part, size):
    monkeypatch.setattr(minhash, "PART_BYTES", part)
    monkeypatch.setattr(minhash, "RANGE", size)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(8)]
    data = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(200)]
    data += [data[7]] * 30 + [None, "", "own words that no other text has", "own words that no other"]
    ids = [None if k % 3 == 0 else k % 50 for k in range(len(data))]
    docs = spark.createDataFrame([*zip(ids, range(len(data)), data)],
                                 "doc_id long, place int, text string").repartition(4)
    rows = minhash.exact_signatures(docs, ["doc_id", "place"], "text").collect()
    assert sorted((r.place, repr(r.doc_id)) for r in rows) == [*enumerate(map(repr, ids))]
    sets = [minhash.shingle_sets(pa.array([t], pa.string()))[0] for t in data]
    df = Counter(g for s, _ in sets for g in s.tolist())
    assert min(df.values()) == 1 and max(df.values()) > 30
    for r in rows:
        found, times = sets[r.place]
        expected = [(1 + math.log(n)) * (1 + math.log((1 + len(data)) / (1 + df[g])))
                    for g, n in zip(found.tolist(), times.tolist())]
        assert np.allclose(np.frombuffer(r.weights, np.float32), expected)
        assert math.isclose(r.total, sum(expected), rel_tol=1e-5, abs_tol=1e-9)


def test_query_and_pipeline_stage_weigh_by_full_tf_idf(spark, tmp_path):
    data = texts()
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(data)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = near_classes(data)
    got = catalog.QUERIES["op4_near_duplicates"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(expected))
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected))


def test_unknown_idf_is_refused(spark):
    with pytest.raises(ValueError):
        minhash.op4(spark.createDataFrame([(1, "a")], "doc_id long, text string"), idf="none")
