"""Registered checks of single file forms and of result order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.functions.time import strict_timestamp
from quayside.plans import analogue as A
from quayside.plans.analytics import (_HARBOUR_SQL, _HOURLY_SQL, _INTERVALS_SQL, _TOTALS_SQL,
                                      harbour, hourly_harbour)
from quayside.plans.occupancy import occupancy_by_time, occupancy_intervals
from quayside.plans.registry import register
from quayside.session import shared_scratch
from quayside.sources import files as SF
from quayside.sources.tables import read_table


@register("headless_csv", """
    SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment
    FROM customer""")
def q_headless_csv(spark, sf_dir):
    """K2 + S2 + P3: a CSV without header and index, read with names given by position."""
    base = shared_scratch(spark, "headless")
    c = read_table(spark, sf_dir, "customer")
    SF.write_csv(c.select("c_custkey", "c_name", "c_mktsegment"), base, header=False)
    return SF.read_csv(spark, base, ["c0", "c1", "c2"], header=False).toDF(
        "key", "name", "segment")


@register("row_ids", """
    SELECT c_custkey, c_name, 1::BIGINT AS rows_of_id FROM customer""")
def q_row_ids(spark, sf_dir):
    """K3: a table written with an id column first; ids are distinct and the rows whole."""
    base = shared_scratch(spark, "ids")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    SF.write_csv(SF.with_row_id(c, key=["c_custkey", "c_name"]), base)
    back = SF.read_csv(spark, base, ["ID", "c_custkey", "c_name"])
    return back.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        F.count("*").over(Window.partitionBy("ID")).alias("rows_of_id"))


@register("text_lines", "SELECT p_name || ' / ' || p_type AS line FROM part")
def q_text_lines(spark, sf_dir):
    """K4: one line of text a row, written and read back."""
    base = shared_scratch(spark, "lines")
    part = read_table(spark, sf_dir, "part").select(
        F.concat_ws(" / ", "p_name", "p_type").alias("line"))
    SF.write_lines(part, "line", base)
    return spark.read.text(base).withColumnRenamed("value", "line")


@register("strict_times", "SELECT event_id, ts FROM events")
def q_strict_times(spark, sf_dir):
    """Clean time texts by the strict parser, which fails on any other."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return ev.select("event_id", strict_timestamp(text).alias("ts"))


def _numbered(df, spark, *columns):
    """A sorted result with its row numbers, each partition numbered from the rows before it."""
    base = shared_scratch(spark, "ordered")
    df.withColumn("__id", F.monotonically_increasing_id()).write.parquet(base)
    back = spark.read.parquet(base).withColumn("__part", F.shiftright("__id", 33))
    sizes = back.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__id") - F.shiftleft("__part", 33) + 1
    return back.join(sizes, "__part").select(number.alias("row"), *columns)


@register("ordered_occupancy", A.with_views("""
    SELECT row_number() OVER (ORDER BY passengers_sum) AS row, passengers_sum FROM totals""",
                                            "presence", ctes={**_HARBOUR_SQL, **_TOTALS_SQL}))
def q_ordered_occupancy(spark, sf_dir):
    """O1: the totals in ascending order."""
    return _numbered(occupancy_by_time(harbour(spark, sf_dir)), spark, "passengers_sum")


@register("ordered_intervals", A.with_views(f"""
    SELECT row_number() OVER (ORDER BY passengers_sum DESC) AS row, passengers_sum
    FROM ({_INTERVALS_SQL})""", "stays", ctes={**_HOURLY_SQL, **_TOTALS_SQL}))
def q_ordered_intervals(spark, sf_dir):
    """O2: the intervals in descending order of their totals."""
    return _numbered(occupancy_intervals(hourly_harbour(spark, sf_dir)), spark, "passengers_sum")


@register("ordered_sales_mix", """
    SELECT row_number() OVER (ORDER BY l_returnflag, pieces DESC) AS row, l_returnflag, pieces
    FROM (SELECT l_returnflag, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS pieces
          FROM lineitem GROUP BY ALL)""")
def q_ordered_sales_mix(spark, sf_dir):
    """O3: two sort keys, the second descending."""
    li = read_table(spark, sf_dir, "lineitem")
    mix = li.groupBy("l_returnflag", "l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("pieces"))
    return _numbered(mix.orderBy("l_returnflag", F.desc("pieces")), spark, "l_returnflag", "pieces")
