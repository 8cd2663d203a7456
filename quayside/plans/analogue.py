"""Analogue tables built from the supplied Parquet tables.

The analytics run on four tables: ``harbour`` (who is present when, with how many
people), ``sales``, ``nationalities`` (visitor group -> nationality) and ``dictionary``
(product -> English product group).  The supplied TPC-H-style tables have the same join
shape, so the queries run on them unchanged:

============  ===========================================================================
presence      orders JOIN customer, one row per (order date, customer nation):
              dt, boat = nation key, passengers = orders that day, agent = nation name
sales         lineitem: dt = ship date, product = part key, units, total_price
groups        nation JOIN region: boat = nation key, nationality = region name
dictionary    part: product = part key, EN = part type
stays         events per (user, day): arrival / departure = first / last event time
              (to the minute), passengers = events in the stay
============  ===========================================================================

Every builder reads only the columns it needs; the scans prune the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.time import truncate_to_minute
from quayside.operators.joins import lookup_join
from quayside.sources.tables import read_table


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harbour analogue: (dt, boat, passengers, agent)."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("boat"), F.col("n_name").alias("agent"))
    counts = (lookup_join(orders, customer, orders.o_custkey == customer.c_custkey)
              .groupBy(F.col("o_orderdate").alias("dt"), F.col("c_nationkey").alias("boat"))
              .agg(F.count(F.lit(1)).cast("int").alias("passengers")))
    # nation has a fixed 25 rows; the join is on the aggregated rows.
    return lookup_join(counts, nation, "boat", "left").select("dt", "boat", "passengers", "agent")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales analogue: (dt, product, units, total_price decimal(18,2))."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_shipdate").alias("dt"),
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_price"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nationalities analogue: (boat, nationality)."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (lookup_join(nation, region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("boat"), F.col("r_name").alias("nationality")))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dictionary analogue: (product, EN)."""
    part = read_table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("product"), F.col("p_type").alias("EN"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits before hourly expansion: (boat, d, arrival, departure, passengers)."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts")
    return (ev.groupBy(F.col("user_id").alias("boat"), F.to_date("ts").alias("d"))
            .agg(truncate_to_minute(F.min("ts")).alias("arrival"),
                 truncate_to_minute(F.max("ts")).alias("departure"),
                 F.count(F.lit(1)).cast("int").alias("passengers")))


# DuckDB definitions of the same tables, used by the oracle SQL.
SQL_VIEWS = {
    "presence": """
        SELECT c.dt, c.boat, c.passengers, n.n_name AS agent
        FROM (SELECT o.o_orderdate AS dt, cu.c_nationkey AS boat,
                     CAST(COUNT(*) AS INTEGER) AS passengers
              FROM orders o JOIN customer cu ON o.o_custkey = cu.c_custkey
              GROUP BY o.o_orderdate, cu.c_nationkey) c
        LEFT JOIN nation n ON c.boat = n.n_nationkey""",
    "sales": """
        SELECT l_shipdate AS dt, l_partkey AS product, CAST(l_quantity AS BIGINT) AS units,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS total_price
        FROM lineitem""",
    "groups": """
        SELECT n.n_nationkey AS boat, r.r_name AS nationality
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dictionary": "SELECT p_partkey AS product, p_type AS EN FROM part",
    "stays": """
        SELECT user_id AS boat, CAST(ts AS DATE) AS d,
               date_trunc('minute', MIN(ts)) AS arrival,
               date_trunc('minute', MAX(ts)) AS departure,
               CAST(COUNT(*) AS INTEGER) AS passengers
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
}


def with_views(sql: str, *names: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with ``WITH`` clauses: the named analogue views, then ``ctes``."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names]
    parts += [f"{n} AS ({body})" for n, body in (ctes or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + sql
