"""What each nationality buys (Q1, Q2, Q6, Q7).

Inputs: ``harbour`` (DateTime, boat, passengers), ``sales`` (dt, product, units,
total_price decimal), ``nationalities`` (boat, nationality), ``dictionary`` (product, EN).
A sale meets every visitor group present at its time (``sales.dt = harbour.DateTime``).

Two ways of counting:

* **replicated** (Q1, Q2): every sale counts in full for every group present;
* **apportioned** (Q6, Q7): a sale is split by each group's share of the people present;
  the share is rounded to one decimal first, every split row to a whole number, then
  summed - the order of rounding is part of the result.

Plan shape, chosen for large sales tables:

* the harbour side is collapsed before the join - to (time, nationality, groups) for
  replicated counting, to (time, nationality, share, groups) for apportioned counting -
  so the sale x group fan-out is at most one row per nationality present, and the fan-out
  rows are summed by a partial aggregate in the same task that produced them;
* the sales side is aggregated below the join too: replicated counting is linear, so sales are
  summed per (time, EN) first; apportioned counting rounds every split sale, so equal sales of a
  time are counted instead.  An hour with half of all sales sends one row per product group (or
  per distinct sale) to the join.  Where totals per product are wanted too, the aggregate is written
  and serves both: the sales are read and shuffled once;
* joins are left to the planner, which splits skewed hours at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.aggregates import percent_of
from quayside.operators.joins import keyed_join, lookup_join, with_group_total
from quayside.session import shared_scratch

_MONEY = "decimal(22,2)"


def _priced(sales: DataFrame, dictionary: DataFrame, collation: str | None = None) -> DataFrame:
    """Sales of known products: (dt, EN, units, cents), the price in whole cents."""
    priced = sales.select("dt", "product", "units", (
        F.col("total_price").cast("decimal(18,2)") * F.lit(100)).cast("bigint").alias("cents"))
    return keyed_join(priced, dictionary.select("product", "EN"), "product",
                      collation=collation).select("dt", "EN", "units", "cents")


def _sum(value: Column) -> Column:
    """A sum that no number of rows overflows."""
    return F.sum(value.cast("decimal(20,0)"))


def sums_by_time(sales: DataFrame, dictionary: DataFrame,
                 collation: str | None = None) -> DataFrame:
    """(dt, EN, units, cents): the sales of a product group at a time, summed."""
    return _priced(sales, dictionary, collation).groupBy("dt", "EN").agg(
        _sum(F.col("units")).alias("units"), _sum(F.col("cents")).alias("cents"))


def equal_sales(sales: DataFrame, dictionary: DataFrame,
                collation: str | None = None) -> DataFrame:
    """(dt, EN, units, cents, n): equal sales of a product group at a time, counted."""
    return _priced(sales, dictionary, collation).groupBy("dt", "EN", "units", "cents").agg(
        F.count(F.lit(1)).alias("n"))


def _money(cents_sum) -> Column:
    """Summed cents back to currency as an exact decimal."""
    return F.col(cents_sum).cast("decimal(38,0)") / F.lit(100)


def round_div(numerator: str, denominator: int) -> Column:
    """``ROUND(numerator / denominator, 0)`` half away from zero, in exact integer math.

    ``numerator`` names a bigint column and ``denominator`` is a positive constant; the
    result is bigint.  Integer overflow fails the query (ANSI) rather than wrapping.
    """
    d = int(denominator)
    n = f"`{numerator}`"
    return F.expr(f"CASE WHEN {n} >= 0 THEN ({n} * 2 + {d}) div {2 * d} "
                  f"ELSE -((-{n} * 2 + {d}) div {2 * d}) END")


def _written(sold: DataFrame) -> DataFrame:
    """``sold`` as a table in the shared folder.  Its two uses filter the sales in their own ways
    (a join drops null times, totals don't), so the planner would read them twice."""
    spark = sold.sparkSession
    folder = shared_scratch(spark, "sold")
    sold.write.parquet(folder)
    return spark.read.schema(sold.schema).parquet(folder)


def product_totals(sold: DataFrame) -> DataFrame:
    """``EN, total_revenue_product, total_units_product`` of :func:`sums_by_time` or
    :func:`equal_sales`."""
    times = F.col("n").cast("decimal(18,0)") if "n" in sold.columns else F.lit(1)
    cents, units = (F.sum(F.col(c).cast("decimal(20,0)") * times) if "n" in sold.columns
                    else F.sum(c) for c in ("cents", "units"))
    sums = sold.groupBy("EN").agg(cents.alias("cents"), units.alias("units"))
    return sums.select("EN", _money("cents").alias("total_revenue_product"),
                       F.col("units").alias("total_units_product"))


def groups_present(harbour: DataFrame, nationalities: DataFrame,
                   time_col: str = "DateTime", collation: str | None = None) -> DataFrame:
    """(time, nationality, groups): visitor-group rows of each nationality present."""
    return (lookup_join(harbour.select(time_col, "boat"), nationalities, "boat",
                        collation=collation)
            .groupBy(time_col, "nationality").agg(F.count(F.lit(1)).alias("groups")))


def shares_present(harbour: DataFrame, nationalities: DataFrame,
                   time_col: str = "DateTime", collation: str | None = None) -> DataFrame:
    """(time, nationality, share10, groups): rounded passenger shares of each group.

    The share is ``ROUND(passengers * 100 / passengers_sum, 1)`` (exact decimal) where the
    total covers all groups present, also those without a nationality; ``share10`` is it
    in tenths of a percent.  Groups with equal share and nationality at the same time are
    counted together.
    """
    with_total = with_group_total(harbour.select(time_col, "boat", "passengers"),
                                  time_col, "passengers", "passengers_sum")
    share = percent_of("passengers", "passengers_sum", 1)
    shares = with_total.select(time_col, "boat", (share * 10).cast("bigint").alias("share10"))
    return (lookup_join(shares, nationalities, "boat", collation=collation)
            .groupBy(time_col, "nationality", "share10")
            .agg(F.count(F.lit(1)).alias("groups")))


def _meet(sales: DataFrame, present: DataFrame, time_col: str) -> DataFrame:
    """Each sale next to the harbour rows of its time."""
    return sales.join(present, sales["dt"] == present[time_col], "inner")


def _as_sums(df: DataFrame) -> DataFrame:
    return df.select("EN", "nationality", _money("cents").alias("revenue"), "units")


def replicated_sums(harbour, sold, nationalities, time_col="DateTime", collation=None):
    """(EN, nationality, revenue, units) with every sale counted once per group present;
    ``sold`` is of :func:`sums_by_time`."""
    met = _meet(sold, groups_present(harbour, nationalities, time_col, collation), time_col)
    return _as_sums(met.groupBy("EN", "nationality").agg(
        F.sum(F.col("cents") * F.col("groups")).alias("cents"),
        F.sum(F.col("units") * F.col("groups")).alias("units")))


def apportioned_sums(harbour, sold, nationalities, time_col="DateTime", collation=None):
    """(EN, nationality, revenue, units) with every sale split by passenger share; ``sold`` is of
    :func:`equal_sales`.

    Per fan-out row: ``ROUND(units / 100.0 * share, 0)`` and
    ``ROUND(total_price / 100.0 * share, 0)``, computed exactly on integers
    (units x tenths / 1000, cents x tenths / 100000) so the hot loop stays on longs.
    """
    met = _meet(sold, shares_present(harbour, nationalities, time_col, collation), time_col)
    met = met.withColumns({"__units_x": F.col("units") * F.col("share10"),
                           "__cents_x": F.col("cents") * F.col("share10")})
    units_adj = round_div("__units_x", 1000)
    price_adj = round_div("__cents_x", 100000)
    times = F.col("n").cast("decimal(18,0)")
    return _as_sums(met.groupBy("EN", "nationality").agg(
        F.sum((price_adj * F.col("groups") * 100).cast("decimal(20,0)") * times).alias("cents"),
        F.sum((units_adj * F.col("groups")).cast("decimal(20,0)") * times).alias("units")))


def _product_share(sums: DataFrame, totals: DataFrame) -> DataFrame:
    joined = sums.join(totals, "EN")
    rev, units = F.col("revenue").cast(_MONEY), F.col("units").cast("decimal(22,0)")
    return joined.select(
        "EN", "nationality",
        F.round(F.col("revenue"), 0).cast("double").alias("total_revenue"),
        F.col("units").cast("bigint").alias("total_units_sold"),
        percent_of(rev, F.col("total_revenue_product").cast(_MONEY), 1)
        .cast("double").alias("revenue_percentage"),
        percent_of(units, F.col("total_units_product").cast("decimal(22,0)"), 1)
        .cast("double").alias("units_percentage"),
    ).orderBy("EN", "nationality")


def _basket_mix(sums: DataFrame) -> DataFrame:
    # Totals per nationality are the sums of its (nationality, EN) rows: one aggregate
    # pass over the already-aggregated rows instead of a second pass over the sales.
    per_nat = Window.partitionBy("nationality")
    rows = sums.select("nationality", "EN",
                       F.col("revenue").cast(_MONEY).alias("product_revenue"),
                       F.col("units").cast("decimal(22,0)").alias("product_units"),
                       F.sum("revenue").over(per_nat).cast(_MONEY).alias("total_revenue"),
                       F.sum("units").over(per_nat).cast("decimal(22,0)").alias("total_units"))
    return rows.select(
        "nationality", "EN",
        F.round("product_revenue", 0).cast("double").alias("product_revenue"),
        F.round("total_revenue", 0).cast("double").alias("total_revenue"),
        percent_of("product_revenue", "total_revenue", 2).cast("double")
        .alias("percentage_of_total_revenue"),
        F.col("product_units").cast("bigint").alias("product_units"),
        F.col("total_units").cast("bigint").alias("total_units"),
        percent_of("product_units", "total_units", 2).cast("double")
        .alias("percentage_of_total_units"),
    ).orderBy("nationality", F.desc("percentage_of_total_revenue"))


def replicated_product_share(harbour, sales, nationalities, dictionary, time_col="DateTime",
                             collation=None):
    """Q1: share of each product group bought per nationality, sales replicated.

    ``collation`` (e.g. ``"UTF8_LCASE_RTRIM"``) sets how ship names and product keys are
    matched; the default compares them exactly.
    """
    sold = _written(sums_by_time(sales, dictionary, collation))
    return _product_share(replicated_sums(harbour, sold, nationalities, time_col, collation),
                          product_totals(sold))


def replicated_basket_mix(harbour, sales, nationalities, dictionary, time_col="DateTime",
                          collation=None):
    """Q2: basket mix per nationality, sales replicated."""
    sold = sums_by_time(sales, dictionary, collation)
    return _basket_mix(replicated_sums(harbour, sold, nationalities, time_col, collation))


def apportioned_product_share(harbour, sales, nationalities, dictionary, time_col="DateTime",
                              collation=None):
    """Q6: Q1 with every sale split by passenger share."""
    sold = _written(equal_sales(sales, dictionary, collation))
    return _product_share(apportioned_sums(harbour, sold, nationalities, time_col, collation),
                          product_totals(sold))


def apportioned_basket_mix(harbour, sales, nationalities, dictionary, time_col="DateTime",
                           collation=None):
    """Q7: Q2 with every sale split by passenger share."""
    sold = equal_sales(sales, dictionary, collation)
    return _basket_mix(apportioned_sums(harbour, sold, nationalities, time_col, collation))
