"""op2 and op5: held-out accuracy on the labelled tables, and odd cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import batches as B
from quayside.llm import classifier, toxicity

SF = "/root/testdata/sf0.1"  # 825 and 1,344 held-out labelled rows


def auc(scores, labels):
    order = scores.rank().to_numpy()
    hit = labels.to_numpy() == 1
    return (order[hit].sum() - hit.sum() * (hit.sum() + 1) / 2) / (hit.sum() * (~hit).sum())


@pytest.mark.parametrize("op, label, least", [(toxicity.op2, "toxic", 0.95),
                                              (classifier.op5, "quality", 0.99)])
def test_held_out_rows(spark, op, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = op(spark, docs, labels)
    assert scored.count() == docs.count()
    seen = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert auc(seen["score"], seen[label]) >= least
    assert (seen["predicted"] == (seen["score"] >= 0.5)).all()


@pytest.mark.parametrize("op, label", [(toxicity.op2, "toxic"), (classifier.op5, "quality")])
def test_odd_tables(spark, op, label):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x" * 100_000), (2, "twice")],
                                 "doc_id long, text string")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    got = op(spark, docs, none).collect()
    assert len(got) == 4 and all(r.score == 0.5 for r in got)
    one_kind = spark.createDataFrame([(1, 1), (2, None), (None, 1)], f"doc_id long, {label} int")
    assert all(0 <= r.score <= 1 for r in op(spark, docs, one_kind).collect())
    assert op(spark, docs.where(F.lit(False)), none).collect() == []


def test_folding_meets_disguised_terms():
    plain = toxicity.fold("idiot clown loser")
    assert toxicity.fold("1D10T cl0wn L0$ER") == plain
    assert toxicity.fold("іdiоt СLОWN ｌｏｓｅｒ") == plain
    assert toxicity.fold("ídïo​t c1own |oser") == plain
    assert toxicity.fold("wow!! 2024 #1") .split() == ["wow", "#"]


def test_whole_words_and_exception_phrases():
    lexicon = toxicity.Lexicon({toxicity.fold("clown"): 3.0}, [toxicity.fold("clown fish")])
    found = lexicon.automaton()
    count = lambda t: len(toxicity.hits(found, toxicity.fold(t)))
    assert [count(t) for t in ("a clown!", "clowns", "clown fish", "clown fish clown", "")] == [
        1, 0, 0, 1, 0]


def test_score_depends_on_the_text_alone(spark):
    table = np.random.default_rng(0).normal(size=classifier.BUCKETS).astype(np.float32)
    text = "some words that again some words that again"
    docs = spark.createDataFrame([(1, text, 5), (2, "é", 5), (3, text, 5)],
                                 "doc_id long, text string, quality_score int")
    got = {r.doc_id: r.quality_score.score for r in classifier.score(docs, (table, 0.0)).collect()}
    assert got[1] == got[3] != got[2]


TEXTS = ["", "a", "héllo wörld", "漢字 🙂 ab", "again and again and again and again", "🙂🙂🙂🙂🙂🙂",
         "\u0800\uffff\U0010ffff\x7f\x80 x\ty", "one two three four"]


def test_tokens_against_a_scan_of_characters():
    """Words, character runs of each size and repeated windows, counted text by text."""
    got = classifier.bags(pa.array(TEXTS))
    column = pa.array(TEXTS)
    raw, offsets = B.utf8(column)
    code, row = classifier.characters(raw, np.repeat(np.arange(len(TEXTS)), np.diff(offsets)))
    assert code.tolist() == [ord(c) for t in TEXTS for c in t]
    assert row.tolist() == [k for k, t in enumerate(TEXTS) for _ in t]
    for text, (buckets, share) in zip(TEXTS, got):
        words = re.findall("[^ \t-\r]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        sizes = [len(words), sum(n - 1 for n in windows.values())]
        sizes += [max(len(text) - n + 1, 0) for n in classifier.GRAMS]
        expected = Counter()
        for n in classifier.GRAMS:
            for k in range(len(text) - n + 1):
                value = 0
                for c in text[k:k + n]:
                    value = (value * int(classifier.MIX) + ord(c)) % 2 ** 64
                value = (value * int(classifier.MIX) + n) % 2 ** 64
                expected[(value * 0x9E3779B97F4A7C15) % 2 ** 64 >> 64 - classifier.BITS] += 1
        counts = dict(zip(buckets.tolist(), (share * sum(sizes)).round().astype(int).tolist()))
        assert sum(counts.values()) == sum(sizes)
        assert all(counts.get(k, 0) >= n for k, n in expected.items())


def test_descent_against_loops(monkeypatch):
    """Training by plain loops over numbers, and scores by the softmax of averaged vectors."""
    monkeypatch.setattr(classifier, "BUCKETS", 50)
    monkeypatch.setattr(classifier, "DIMENSIONS", 3)
    rng = random.Random(3)
    examples, labels = [], np.array([0, 1, 0, 1, 1, 0, 0, 0])
    for _ in labels:
        ids = sorted(rng.sample(range(50), 6))
        share = np.array([rng.random() for _ in ids])
        examples.append((np.array(ids, np.int32), (share / share.sum()).astype(np.float32)))
    table, bias = classifier.descend(examples, labels)

    draw = np.random.default_rng(5)
    vectors = draw.uniform(-1 / 3, 1 / 3, (50, 3)).tolist()
    layer = draw.uniform(-1, 1, (3, 2)).tolist()
    offset, step, steps = [0.0, 0.0], 0, classifier.EPOCHS * len(labels)
    weight = [len(labels) / (2 * int((labels == c).sum())) for c in (0, 1)]

    def outputs(ids, share):
        mean = [sum(s * vectors[i][d] for i, s in zip(ids, share)) for d in range(3)]
        return mean, [sum(m * layer[d][c] for d, m in enumerate(mean)) + offset[c]
                      for c in (0, 1)]

    for _ in range(classifier.EPOCHS):
        for k in draw.permutation(len(labels)):
            ids, share = examples[k]
            rate = classifier.RATE * (1 - step / steps) * min(weight[labels[k]], 4)
            step += 1
            mean, out = outputs(ids, share)
            total = sum(np.exp(o) for o in out)
            error = [np.exp(out[c]) / total - (c == labels[k]) for c in (0, 1)]
            back = [sum(layer[d][c] * error[c] for c in (0, 1)) for d in range(3)]
            for d in range(3):
                for c in (0, 1):
                    layer[d][c] -= rate * mean[d] * error[c]
            for c in (0, 1):
                offset[c] -= 0.1 * rate * error[c]
            for i, s in zip(ids, share):
                for d in range(3):
                    vectors[i][d] = (vectors[i][d] * (1 - classifier.DECAY)
                                     - rate * min(classifier.TOKEN_STEP * s, 1) * back[d])
    for ids, share in examples:
        _, out = outputs(ids, share)
        whole = np.exp(out[1]) / (np.exp(out[0]) + np.exp(out[1]))
        folded = 1 / (1 + np.exp(-(share @ table[ids] + bias)))
        assert abs(whole - folded) < 1e-3 and np.isfinite(table).all()


def test_hits_against_a_scan_of_places():
    rng = random.Random(6)
    words = ["clown", "fish", "clownfish", "a", "idiot", "é", "x1"]
    lexicon = toxicity.Lexicon({toxicity.fold(w): float(k + 1) for k, w in enumerate(words[:5])},
                               [toxicity.fold("clown fish"), toxicity.fold("a clown")])
    found = lexicon.automaton()
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice(["", " ", ", ", "-"]) for _ in range(12))
        folded = toxicity.fold(text)

        def places(term):
            for k in range(len(folded) - len(term) + 1):
                before, after = folded[k - 1:k] if k else "", folded[k + len(term):][:1]
                if (folded[k:k + len(term)] == term and not before.isalnum()
                        and not after.isalnum()):
                    yield k, k + len(term)

        excused = [p for phrase in lexicon.phrases for p in places(phrase)]
        expected = [(term, weight) for term, weight in lexicon.terms.items()
                    for a, b in places(term) if not any(c <= a and b <= d for c, d in excused)]
        assert sorted(toxicity.hits(found, folded)) == sorted(expected)


def test_repeated_texts_with_both_labels_train_the_same(spark):
    """One text counts once, with label 1 if any row says so, in whatever order rows come."""
    rows = [(f"good words {k} here", 1) for k in range(30)] + [
        (f"bad spam {k} spam", 0) for k in range(30)] + [("bad spam 3 spam", 1)] * 2
    tables = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "text string, label int").repartition(3)
        table, bias = classifier.train(spark, docs)
        tables.append((table.tobytes(), bias))
    assert tables[0] == tables[1]
