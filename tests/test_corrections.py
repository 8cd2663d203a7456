import datetime as dt

from pyspark.sql import functions as F

from quayside.operators import corrections as C
from quayside.operators.joins import outer_merge

from conftest import rows


def _cells(spark):
    return spark.createDataFrame([("a", 5), ("b", None), ("c", None)], "k string, v int")


def _fixes(spark):
    return spark.createDataFrame([("a", 9), ("b", 9), ("z", 1)], "k string, v int")


def test_soft_and_hard_fixes(spark):
    soft, unused = C.apply_fixes(_cells(spark), _fixes(spark), ["k"], ["v"], "soft")
    hard, _ = C.apply_fixes(_cells(spark), _fixes(spark), ["k"], ["v"], "hard")
    assert rows(soft) == [("a", 5), ("b", 9), ("c", None)]
    assert rows(hard) == [("a", 9), ("b", 9), ("c", None)]
    assert rows(unused) == [("z", 1)]
    assert soft.count() == 3 and hard.count() == 3


def test_null_fix_value_means_no_fix(spark):
    fixes = spark.createDataFrame([("a", None)], "k string, v int")
    hard, _ = C.apply_fixes(_cells(spark), fixes, ["k"], ["v"], "hard")
    assert rows(hard) == [("a", 5), ("b", None), ("c", None)]


def test_exclusions_and_offsets(spark):
    df = spark.createDataFrame([("a", dt.datetime(2023, 5, 1, 8)), ("b", dt.datetime(2023, 5, 1, 9))],
                               "k string, t timestamp_ntz")
    excl = spark.createDataFrame([("a",)], "k string")
    assert rows(C.exclude_keys(df, excl, ["k"]), "k") == [("b",)]
    off = spark.createDataFrame([("b", 1)], "k string, days int")
    assert rows(C.add_days(df, off, ["k"], ["t"])) == [("a", dt.datetime(2023, 5, 1, 8)),
                                                      ("b", dt.datetime(2023, 5, 2, 9))]


def test_override_when_present(spark):
    df = spark.createDataFrame([("08:00", "09:00"), ("08:00", ""), ("08:00", None), (None, "09:00")],
                               "x string, y string")
    out = [r[0] for r in df.select(C.override_when_present("x", "y")).collect()]
    assert out == ["09:00", "08:00", "08:00", "09:00"]


def test_updates_apply_in_order(spark):
    df = spark.createDataFrame([("Anna", 1), ("Berta", 2)], "boat string, passengers int")
    out = C.apply_updates(df, [("passengers", 50, F.col("boat") == "Anna"),
                               ("passengers", 60, F.col("boat") == "Berta"),
                               ("passengers", 7, F.col("passengers") == 50)])
    assert rows(out) == [("Anna", 7), ("Berta", 60)]


def test_several_fixes_of_a_key_are_one(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1, None)], "k string, v int, w int")
    fixes = spark.createDataFrame([("a", 5, None), ("a", None, 6), ("b", 9, 2), ("b", 8, 2)],
                                  "k string, v int, w int")
    soft, unused = C.apply_fixes(df, fixes, ["k"], ["v", "w"], "soft")
    assert rows(soft) == [("a", 5, 6), ("b", 1, 2)] and unused.count() == 0
    assert rows(C.fix_conflicts(fixes, ["k"], ["v", "w"])) == [("b",)]
    offsets = spark.createDataFrame([("a", 1), ("a", 2)], "k string, days int")
    dates = spark.createDataFrame([("a", dt.datetime(2023, 5, 1))], "k string, t timestamp_ntz")
    assert rows(C.add_days(dates, offsets, ["k"], ["t"])) == [("a", dt.datetime(2023, 5, 4))]


def test_recode_table(spark):
    df = spark.createDataFrame([("Aidaluna",), ("Other",), (None,)], "boat string")
    t = spark.createDataFrame([("Aidaluna", "AIDAluna")], "from_value string, to_value string")
    assert set(rows(C.recode_by_table(df, "boat", t))) == {("AIDAluna",), ("Other",), (None,)}


def test_outer_merge_suffixes_and_keys(spark):
    a = spark.createDataFrame([("d1", "A", "08:00"), ("d1", "B", "09:00")], "date string, boat string, ETA string")
    b = spark.createDataFrame([("d1", "A", "10:00", "x"), ("d2", "C", "11:00", "y")],
                              "date string, boat string, ETA string, time string")
    m = outer_merge(a, b, ["date", "boat"])
    assert set(m.columns) == {"date", "boat", "ETA_x", "ETA_y", "time"}
    assert rows(m, "date", "boat", "ETA_x", "ETA_y") == [
        ("d1", "A", "08:00", "10:00"), ("d1", "B", "09:00", None), ("d2", "C", None, "11:00")]


def test_keyword_exclusion_list_and_table(spark):
    from quayside.operators.filters import exclude_keywords
    lines = ["Kaisa 8-16", "ShipA,0800", "a.b(c) \\\\E x", "ok", "", "é🙂 z"]
    df = spark.createDataFrame([(x,) for x in [*lines, None, "ok"]], "line string")
    for words in (["Kaisa", "Toni"], ["a.b(c) \\\\E", "zz"], ["k", "🙂"], ["Kaisa 8-16 "], [],
                  [f"zz{k}" for k in range(2000)] + ["Ship"]):
        left = sorted(x for x in [*lines, "ok"] if not any(w in x for w in words))
        kw = spark.createDataFrame([(w,) for w in [*words, "", None]], "keyword string")
        for keywords in (words, kw):
            got = [r[0] for r in exclude_keywords(df, "line", keywords).collect()]
            assert sorted(x for x in got if x is not None) == left and got.count(None) == 1


def test_keywords_of_all_sizes_against_a_scan(spark):
    import random

    from quayside.operators.filters import keyword_hits
    rng = random.Random(4)

    def some(least, most, n):
        return ["".join(rng.choice("abé\n") for _ in range(rng.randint(least, most)))
                for _ in range(n)]

    lines = some(0, 30, 300) + ["ab" * 5_000]
    texts = spark.createDataFrame([(x,) for x in [*lines, *lines[:50], None]], "line string")
    for words in (some(2, 2, 1) + some(3, 9, 20), some(6, 12, 30),
                  some(3, 5, 2) + ["\n"], ["é"], []):
        kw = spark.createDataFrame([(w,) for w in words], "keyword string")
        for index_bytes in (1 << 20, 0):  # broadcast, shuffled
            got = [r.line for r in keyword_hits(texts, "line", kw,
                                                index_bytes=index_bytes).collect()]
            assert len(got) == len(set(got))
            assert set(got) == {x for x in lines if any(w in x for w in words)}
    none = spark.createDataFrame([], "line string")
    assert keyword_hits(none, "line", texts, "line").count() == 0


def _exchanged(plan):
    """Rows written by the shuffles of an executed plan."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _exchanged(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _exchanged(plan.plan())
    own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    children = plan.children()
    return own + sum(_exchanged(children.apply(k)) for k in range(children.size()))


def test_beside_a_large_index_only_grams_it_may_have_are_shuffled(spark, monkeypatch):
    import random

    from quayside.operators import filters
    rng = random.Random(7)
    lines = ["".join(rng.choice("abcdefgh 0#@") for _ in range(200)) for _ in range(200)]
    lines += [lines[0]] * 20 + ["xCustomer#000000007@y", "by kite", "a lantern", "Customer#00000",
                                "Customer#000000300@", "é🙂Customer#000000299@"]
    words = [f"Customer#{k:09d}@" for k in range(300)] + ["kite", "lantern"]
    written, parts = filters._written, []

    def keep(df, name):
        parts.append((name, df))
        return written(df, name)

    monkeypatch.setattr(filters, "_written", keep)
    hits = filters.keyword_hits(spark.createDataFrame([(x,) for x in lines], "line string"), "line",
                                spark.createDataFrame([(w,) for w in words], "keyword string"),
                                index_bytes=1000)
    assert sorted(r.line for r in hits.collect()) == sorted(
        x for x in set(lines) if any(w in x for w in words))
    moved = 0
    for df in [hits, *(df for name, df in parts if name != "keyword-index")]:
        df.collect()
        moved += _exchanged(df._jdf.queryExecution().executedPlan())
    assert 0 < moved < 2_000, moved  # the texts have over 40,000 grams of each size


def test_a_large_index_in_parts_against_a_scan(spark):
    import random

    from quayside.operators.filters import keyword_hits
    rng = random.Random(9)

    def some(least, most, n):
        return ["".join(rng.choice("abé🙂") for _ in range(rng.randint(least, most)))
                for _ in range(n)]

    lines = some(0, 40, 300) + ["ab" * 3_000]
    words = (some(2, 2, 1) + some(4, 5, 5) + some(7, 11, 40) + some(12, 20, 200)
             + [x[3:20] for x in lines[:40]] + [x[5:17] for x in lines[100:120]])
    texts = spark.createDataFrame([(x,) for x in [*lines, *lines[:50], None]], "line string")
    for letter in ([], ["🙂"]):
        kw = spark.createDataFrame([(w,) for w in [*words, *letter, "", None]], "keyword string")
        for index_bytes in (60, 500, 4_000):  # grams of 2, 3 and 6 characters are broadcast
            got = [r.line for r in keyword_hits(texts, "line", kw,
                                                index_bytes=index_bytes).collect()]
            assert len(got) == len(set(got))
            assert set(got) == {x for x in lines if any(w and w in x for w in [*words, *letter])}


def test_the_filter_of_hashes_holds_them_all_and_few_others(spark):
    from quayside.operators.filters import may_hold
    hashes = spark.range(5_000).select(F.xxhash64("id").alias("h")).union(
        spark.createDataFrame([(0,), (-1,), (2**63 - 1,), (-2**63,)], "h long"))
    others = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("k"))
    for n, most in ((5_004, 1_000), (0, 20_000)):  # too small a filter is less sharp, not wrong
        assert hashes.select(F.col("h").alias("k")).where(may_hold(hashes, n, "k")).count() == 5_004
        assert others.where(may_hold(hashes, n, "k")).count() < most
    assert others.where(may_hold(hashes.limit(0), 0, "k")).count() == 0


def test_outer_merge_with_a_key_that_holds_most_rows(spark):
    """Equal to a full outer join, null and repeated keys too, and without one in its plan."""
    a = spark.createDataFrame([(1, k, "x") for k in range(400)] + [(2, 0, "y"), (None, 1, "z"),
                                                                   (3, 7, "w"), (3, 8, "w")],
                              "k long, a long, t string")
    b = spark.createDataFrame([(1, "p"), (1, "q"), (3, "r"), (4, "s"), (None, "u")],
                              "k long, t string")
    got = outer_merge(a, b, ["k"])
    named = b.withColumnsRenamed({"k": "k2", "t": "t_y"})
    full = a.withColumnRenamed("t", "t_x").join(named, F.col("k") == F.col("k2"), "full_outer")
    expected = full.select(F.coalesce("k", "k2").alias("k"), "a", "t_x", "t_y")
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "Inner" in plan and plan.count("LeftAnti") == 2


def test_the_exploded_grams_of_a_keyword_table_are_never_broadcast(spark):
    from quayside.operators.filters import rarest_grams
    words = spark.range(50).select(F.format_string("Customer#%09d@", "id").alias("keyword"))
    found = rarest_grams(words, "keyword")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.keyword: r.gram for r in found.collect()}
    assert len(got) == 50 and all(g in w and len(g) == 6 for w, g in got.items())


def test_rare_grams_are_found_without_moving_all_grams(spark):
    from collections import Counter

    from quayside.operators.filters import rarest_grams
    words = [f"Customer#{k:09d}@" for k in range(3_000)] + ["éCustomer#", "short", "aaaaaaa"]
    kw = spark.createDataFrame([(w,) for w in [*words, *words[:9], None]], "keyword string")
    found = rarest_grams(kw, "keyword")
    got = {r.keyword: r.gram for r in found.collect()}
    assert set(got) == {w for w in words if len(w) >= 6}
    held = Counter(g for w in words for g in {w[k:k + 6] for k in range(len(w) - 5)})
    assert all(g in w for w, g in got.items()) and got["aaaaaaa"] == "aaaaaa"
    assert max(held[g] for g in got.values()) <= 20  # the first eight are in over 3,000
    assert _exchanged(found._jdf.queryExecution().executedPlan()) < 10_000  # of 42,000 grams


def test_large_merges_and_unused_fixes_are_dealt_by_the_files_sizes(spark, tmp_dir, monkeypatch):
    """As many tasks as the files ask for, whatever AQE makes of the shuffled bytes; same rows."""
    from quayside.operators import joins as J
    a = [(k % 50 if k % 7 else None, k, "x") for k in range(400)] + [(3, 0, "x")] * 30
    b = [(k, f"f{k}") for k in range(40, 90)] + [(None, "n"), (45, "again")]
    spark.createDataFrame(a, "k long, a long, v string").write.parquet(f"{tmp_dir}/a")
    spark.createDataFrame(b, "k long, v string").write.parquet(f"{tmp_dir}/b")
    df, fixes = (spark.read.parquet(f"{tmp_dir}/{t}") for t in "ab")

    def both():
        return (C.apply_fixes(df, fixes, ["k"], ["v"])[1], outer_merge(df, fixes, ["k"]))

    plans = lambda: [d._jdf.queryExecution().executedPlan().toString() for d in both()]
    expected = [rows(d) for d in both()]
    assert J.task_count(df, fixes) == 0 and not any("REPARTITION_BY_NUM" in p for p in plans())
    monkeypatch.setattr(J, "PLANNED_BYTES", 0)
    monkeypatch.setattr(J, "DEALT_BYTES", 500)
    n = J.task_count(df, fixes)
    assert n > 4 and J.task_count(spark.createDataFrame(b, "k long, v string")) == 0
    for p in plans():
        assert p.count(f", {n}), REPARTITION_BY_NUM") >= 2, p
    assert [rows(d) for d in both()] == expected
