"""Properties from the test plan on the supplied sf0.001 tables."""

import random
import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quayside.operators.corrections import apply_fixes
from quayside.operators.reshape import expand_hours
from quayside.plans import analogue as A
from quayside.plans import catalog
from quayside.plans.analytics import harbour
from quayside.plans.occupancy import presence_share

SF = "/root/testdata/sf0.001"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(0, 5_000)), min_size=1, max_size=30))
def test_hours_count_is_floor_plus_one(spark, spans):
    base = dt.datetime(2023, 1, 1)
    data = [(i, base + dt.timedelta(minutes=a), base + dt.timedelta(minutes=a + d))
            for i, (a, d) in enumerate(spans)]
    df = spark.createDataFrame(data, "k int, a timestamp_ntz, d timestamp_ntz")
    got = {r.k: r.n for r in expand_hours(df, "a", "d", "h").groupBy("k")
           .agg(F.count("*").alias("n")).collect()}
    for i, (_, d) in enumerate(spans):
        assert got[i] == d // 60 + 1


def test_shares_sum_to_hundred_per_hour(spark):
    h = harbour(spark, SF)
    everyone = h.select("boat").distinct().withColumn("nationality", F.lit("any"))
    shares = presence_share(h, everyone)
    sums = shares.groupBy("DateTime").agg(F.sum("passengers_percentage").alias("s"),
                                          F.count("*").alias("n")).collect()
    for r in sums:
        assert abs(float(r.s) - 100) <= 0.05 * r.n + 1e-9


def test_soft_fix_keeps_non_null_cells_and_row_count(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderpriority"))
        .alias("prio"))
    fixes = o.select("o_orderkey", F.lit("FIX").alias("prio"))
    fixed, unused = apply_fixes(o, fixes, ["o_orderkey"], ["prio"], "soft")
    joined = o.alias("a").join(fixed.alias("b"), "o_orderkey")
    assert fixed.count() == o.count() and unused.count() == 0
    assert joined.where(F.col("a.prio").isNotNull() & (F.col("a.prio") != F.col("b.prio"))).count() == 0
    assert joined.where(F.col("a.prio").isNull() & (F.col("b.prio") != "FIX")).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_partition_only_over_bucket_summaries(spark):
    for name in ("occupancy_by_time", "presence_share", "replicated_product_share",
                 "apportioned_product_share", "hourly_presence"):
        assert "SinglePartition" not in _plan(catalog.QUERIES[name](spark, SF)), name
    df = catalog.QUERIES["occupancy_intervals"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            below = "\n".join(lines[i:i + 6])
            assert "__bucket" in below, below


def test_intervals_partition_the_hours(spark):
    from quayside.plans.analytics import hourly_harbour
    from quayside.plans.occupancy import occupancy_intervals, passengers_by_time
    h = hourly_harbour(spark, SF)
    hours = sorted((r.DateTime, r.passengers_sum) for r in passengers_by_time(h).collect())
    ivs = sorted((r.interval_start, r.interval_end, r.passengers_sum)
                 for r in occupancy_intervals(h, width_days=2).collect())
    # consecutive, non-overlapping, each interval's hours all carry its total
    assert ivs[0][0] == hours[0][0] and ivs[-1][1] == hours[-1][0]
    for (s1, e1, _), (s2, _, _) in zip(ivs, ivs[1:]):
        assert e1 < s2
    pos = {t: i for i, (t, _) in enumerate(hours)}
    covered = 0
    for s, e, v in ivs:
        block = hours[pos[s]:pos[e] + 1]
        assert all(x == v for _, x in block)
        covered += len(block)
    assert covered == len(hours)
