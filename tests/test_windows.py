import datetime as dt
import random

import pandas as pd

from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.windows import (_PART, change_point_intervals, lag_by_range, ordered_lag,
                                        position_bucket, range_partitioned, running_sum,
                                        running_sums, running_sums_by_range)

from conftest import rows

T = dt.datetime


def test_interval_fixture(spark):
    data = [(T(2023, 5, 1, 8), 5), (T(2023, 5, 1, 9), 5), (T(2023, 5, 1, 11), 5),
            (T(2023, 5, 1, 12), 7), (T(2023, 5, 1, 13), 5)]
    df = spark.createDataFrame(data, "t timestamp_ntz, v long")
    got = rows(change_point_intervals(df, "t", "v"))
    assert got == sorted([(T(2023, 5, 1, 12), T(2023, 5, 1, 12), 7),
                          (T(2023, 5, 1, 8), T(2023, 5, 1, 11), 5),
                          (T(2023, 5, 1, 13), T(2023, 5, 1, 13), 5)])


def _series(n, seed, nulls=True):
    rnd = random.Random(seed)
    start = T(2023, 1, 1)
    times = sorted(rnd.sample(range(0, 24 * 400), n))
    vals = [rnd.choice([1, 1, 2, 3, None] if nulls else [1, 1, 2, 3]) for _ in times]
    return [(start + dt.timedelta(hours=h), v) for h, v in zip(times, vals)]


def _brute_intervals(data):
    pdf = pd.DataFrame(data, columns=["t", "v"]).sort_values("t")
    prev = pdf["v"].shift(1)
    flag = [0 if (a is not None and b is not None and not pd.isna(a) and not pd.isna(b) and a == b)
            else 1 for a, b in zip(pdf["v"], prev)]
    pdf["g"] = pd.Series(flag, index=pdf.index).cumsum()
    out = []
    for g, grp in pdf.groupby("g"):
        v = grp["v"].iloc[0]
        out.append((grp["t"].min().to_pydatetime(), grp["t"].max().to_pydatetime(),
                    None if pd.isna(v) else int(v)))
    return sorted(out, key=lambda r: (r[0], r[1]))


def test_intervals_match_brute_force_across_buckets(spark):
    for seed in range(3):
        data = _series(300, seed)
        df = spark.createDataFrame(data, "t timestamp_ntz, v long")
        got = sorted(change_point_intervals(df, "t", "v", width_days=3).collect(),
                     key=lambda r: (r[0], r[1]))
        assert [tuple(r) for r in got] == _brute_intervals(data)


def test_lag_and_running_sum_match_brute_force(spark):
    data = _series(200, 7, nulls=False)
    df = spark.createDataFrame(data, "t timestamp_ntz, v long")
    lag = dict((r.t, r.p) for r in ordered_lag(df, "t", "v", "p", width_days=5).collect())
    run = dict((r.t, r.s) for r in running_sum(df, "t", "v", "s", width_days=5).collect())
    prev, total = None, 0
    for t, v in data:
        assert lag[t] == prev
        total += v
        assert run[t] == total
        prev = v


def test_partitioned_running_counts_by_position(spark):
    data = [(f, p, 1 if p % 5 == 0 else 0) for f in ("a", "b") for p in range(50)]
    df = spark.createDataFrame(data, "f string, pos long, h int")
    out = running_sums(df, "pos", {"blk": "h"}, partition_cols=("f",),
                       bucket=position_bucket("pos", 7))
    got = {(r.f, r.pos): r.blk for r in out.collect()}
    for f in ("a", "b"):
        acc = 0
        for p in range(50):
            acc += 1 if p % 5 == 0 else 0
            assert got[(f, p)] == acc


def _events(n=6_000):
    """Rows of which half are of one time, crowded into a month, with nulls."""
    rnd = random.Random(31)
    start = T(2024, 2, 1)
    out = []
    for k in range(n):
        t = start if k % 2 else start + dt.timedelta(minutes=rnd.randint(0, 40_000))
        out.append((k, None if k % 97 == 0 else t, None if k % 13 == 0 else rnd.randint(-5, 9)))
    return out


def test_range_scans_equal_whole_table_windows(spark):
    df = spark.createDataFrame(_events(), "id long, t timestamp_ntz, v long").repartition(6)
    whole = Window.orderBy("t")
    expected = df.withColumn("run", F.sum("v").over(whole))
    assert rows(running_sums_by_range(df, ["t"], {"run": "v"})) == rows(expected)
    expected = df.withColumn("prev", F.lag("v").over(Window.orderBy("t", "id")))
    assert rows(lag_by_range(df, ["t", "id"], "v", "prev")) == rows(expected)


def test_range_scans_of_odd_tables(spark):
    none = spark.createDataFrame([], "t long, v long")
    assert running_sums_by_range(none, ["t"], {"run": "v"}).collect() == []
    assert lag_by_range(none, ["t"], "v", "prev").collect() == []
    nulls = spark.createDataFrame([(None, 1), (1, None), (None, 2)], "t long, v long")
    assert rows(running_sums_by_range(nulls, ["t"], {"run": "v"})) == [
        (None, 1, 3), (None, 2, 3), (1, None, 3)]


def test_ranges_hold_about_as_many_rows_each(spark):
    df = spark.createDataFrame(_events(20_000), "id long, t timestamp_ntz, v long")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in range_partitioned(df, ["t", "id"]).groupBy(_PART).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
