"""op3 against a brute-force version, and its odd cases."""

import random
import re
from collections import Counter

from quayside.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def texts():
    rng = random.Random(3)
    say = lambda n, v: " ".join(rng.choice(v) for _ in range(n))
    out = [None, "", " \t\n", "one", "a a", "a a a", "a a a a", "x\ny\nx\n \nx", "\x1c \x85 é🙂 漢",
           "the " * 3000, "a b c " * 40]
    out += [say(rng.randint(1, 200), "the of a b cc dd# é 🙂x $5 &".split()) for _ in range(60)]
    out += [say(120, [f"the w{k}" for k in range(500)]) for _ in range(5)]
    out += ["\n".join(say(4, ["the", "on", "as"]) for _ in range(60))]
    out.append(say(60_000, [f"w{k}" for k in range(30)]))
    return out


def test_matches_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(texts())] + [(None, "the text"), (None, "the text")]
    got = rules.op3(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr(tuple(r)[:-1]) for r in got) == sorted(repr((d, *brute(t))) for d, t in rows)
    assert all(not (r.kept and r.base_failed) for r in got)


def test_filter_on_the_verdict_and_clashing_names(spark):
    good = " ".join(f"the w{k} of the x{k}" for k in range(30))
    rows = [(1, good, 9, "q"), (2, "junk " * 100, 9, "q"), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, quality string")
    judged = rules.judge(docs)
    assert judged.columns == ["doc_id", "text", "n_words", "quality"]
    kept = judged.where("quality.kept").select("doc_id", "n_words", "quality.n_words").collect()
    assert [tuple(r) for r in kept] == [(1, 9, 150)]


def test_empty_table_and_plan_without_python(spark):
    none = rules.op3(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == []
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
