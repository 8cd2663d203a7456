"""op1 against a brute-force version, and its odd cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quayside.llm import winnow

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n_words string"
ITEMS = "item_id long, text string"


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    doc, hit, named = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        size = min(13, len(w))
        if not size or item_id is None:
            continue
        spans = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
        for k in range(len(doc) - size + 1):
            if tuple(doc[k:k + size]) in spans:
                hit.update(range(k, k + size))
                named.add(str(item_id))
    ids = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(doc), len(hit), len(named), ids, bool(hit) and 20 * len(hit) >= len(doc)


def tables():
    rng = random.Random(7)
    say = lambda n: " ".join(rng.choice(["a", "b", "Cé", "d1", "漢"]) for _ in range(n))
    items = [(k, say(n)) for k, n in enumerate((40, 13, 14, 5, 1, 0, 7, 30, 12))]
    items += [(None, "x y z"), (3, "other words here"), (20, items[0][1]), (21, None)]
    docs = []
    for k in range(60):
        parts = [say(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 5))
            parts += [", ".join(w[a:a + rng.randint(5, 25)]).upper(), say(rng.randint(0, 9))]
        docs.append((k, "\n".join(parts), "clash"))
    docs += [(None, items[0][1], "x"), (None, "clean unrelated", "x"), (5, docs[5][1], "x"),
             (70, None, None), (71, "", ""), (72, "!! ..", ""), (73, items[7][1] + " w" * 40_000, "")]
    return docs, items


def test_matches_brute_force_with_and_without_broadcast(spark):
    docs, items = tables()
    expected = sorted(repr((d, *brute(t, items))) for d, t, _ in docs)
    d, i = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    assert sorted(repr(tuple(r)) for r in winnow.op1(d, i).collect()) == expected
    shuffled = winnow.decontaminate(d, i, broadcast_rows=0)
    assert shuffled.columns == ["doc_id", "text", "n_words", "contamination"]
    got = sorted(repr((r.doc_id, r.contamination.n_words, r.contamination.n_hit,
                       r.contamination.n_items)) for r in shuffled.collect())
    assert got == sorted(repr((d, *brute(t, items)[:3])) for d, t, _ in docs)
    assert d.agg(F.count("*")).first()[0] == len(got)


def test_empty_tables(spark):
    docs, items = tables()
    none_d, none_i = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert winnow.op1(none_d, spark.createDataFrame(items, ITEMS)).collect() == []
    clean = winnow.op1(spark.createDataFrame(docs, SCHEMA), none_i).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_hit for r in clean)
