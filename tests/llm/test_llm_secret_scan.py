"""op6 against Python's regular expressions, its index, masking and odd cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from quayside.llm import secret_scan as S


def brute(text, rules=S.RULES):
    found = []
    for rank, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return sorted(found)


def texts():
    rng = random.Random(11)
    parts = ["password = hunter22", "PASSWD:'x1'", "Api_Key=\"AbC/123+=\"", "apikey : short",
             "secret=token: abcdefgh", "token==abcde", "AKIA" + "B2" * 9, "AKIAAKIA" + "C" * 12,
             "AKIA12", "0123456789abcdef" * 2, "deadbeef" * 2, "ghp_" + "a1B2" * 10,
             "xoxb-123456789012-abcdef", "-----BEGIN RSA PRIVATE KEY-----", "🙂é漢", "words here",
             "eyJab-.eyJcd_.sig", "\n", "token", "passwordtoken=abcdef1"]
    out = [None, "", "token", *parts]
    out += [rng.choice([" ", "", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
            for _ in range(80)]
    return [*out, "é " * 30_000 + "password=" + "z" * 50 + " a" * 30_000]


def test_matches_python(spark):
    rows = list(enumerate(texts())) + [(None, "token=abcdef"), (None, "nothing"), (3, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.op6(docs).collect()
    expected = []
    for d, t in rows:
        spans = brute(t)
        text = [f"{k}:{a}:{b}" for a, r, b, k in spans]
        base = ",".join(x for x, s in zip(text, spans) if s[1] < 3)
        expected.append((d, *(sum(s[1] == k for s in spans) for k in range(3)),
                         hashlib.sha256(base.encode()).hexdigest(), ",".join(text)))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got)


def test_every_match_passes_its_trigram_query():
    for rule in S.RULES:
        for text in filter(None, texts()):
            low = text.lower()
            held = {low[k:k + 3] for k in range(len(low) - 2)}
            if re.search(rule.pattern, text):
                assert all(any(s <= held for s in c) for c in S.trigram_query(rule.pattern))
    assert S.trigram_query("[0-9a-f]+") == []
    assert S.trigram_query("abc?d") == [] or S.trigram_query("abcd") == [[frozenset(["abc", "bcd"])]]


def test_masks_spans(spark):
    rows = [(1, "a token=abcdef b " + "0a" * 12 + "."), (2, "plain"), (3, None),
            (4, "password=" + "0a" * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.redact(S.scan(docs)).collect()}
    assert got == {1: "a [secret] b [secret].", 2: "plain", 3: None, 4: "[secret]"}


def test_odd_tables_and_plan(spark):
    none = spark.createDataFrame([], "doc_id long, text string, secrets int")
    assert S.scan(none).columns == ["doc_id", "text", "secrets"]
    assert S.scan(none).collect() == []
    plan = S.op6(none)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
    only = S.scan(spark.createDataFrame([(1, "0a" * 12)], "doc_id long, text string"),
                  rules=(S.BASE[2],))
    assert only.select(F.size("secrets")).first()[0] == 1
