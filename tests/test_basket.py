import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quayside.plans import basket
from quayside.plans.occupancy import presence_share

from conftest import rows

H = dt.datetime(2023, 5, 1, 10)


def _inputs(spark, nat_rows):
    harbour = spark.createDataFrame([(H, "A", 100, "ag1"), (H, "B", 200, "ag2")],
                                    "DateTime timestamp_ntz, boat string, passengers int, agent string")
    sales = spark.createDataFrame([(H, 1, 10, Decimal("99.00"))],
                                  "dt timestamp_ntz, product int, units bigint, total_price decimal(18,2)")
    nat = spark.createDataFrame(nat_rows, "boat string, nationality string")
    dic = spark.createDataFrame([(1, "Souvenir")], "product int, EN string")
    return harbour, sales, nat, dic


def test_apportioned_fixture(spark):
    out = basket.apportioned_product_share(*_inputs(spark, [("A", "X"), ("B", "Y")])).collect()
    got = {r.nationality: (r.total_revenue, r.total_units_sold, r.revenue_percentage,
                           r.units_percentage) for r in out}
    assert got == {"X": (33.0, 3, 33.3, 30.0), "Y": (66.0, 7, 66.7, 70.0)}


def test_apportioned_missing_nationality_keeps_denominators(spark):
    out = basket.apportioned_product_share(*_inputs(spark, [("A", "X")])).collect()
    assert [(r.nationality, r.revenue_percentage, r.units_percentage) for r in out] == [
        ("X", 33.3, 30.0)]


def test_replicated_fixture(spark):
    out = basket.replicated_product_share(*_inputs(spark, [("A", "X"), ("B", "Y")])).collect()
    got = {r.nationality: (r.total_revenue, r.total_units_sold, r.revenue_percentage,
                           r.units_percentage) for r in out}
    assert got == {"X": (99.0, 10, 100.0, 100.0), "Y": (99.0, 10, 100.0, 100.0)}


def test_basket_mix_fixture(spark):
    out = basket.apportioned_basket_mix(*_inputs(spark, [("A", "X"), ("B", "Y")])).collect()
    got = {r.nationality: (r.product_revenue, r.total_revenue, r.percentage_of_total_revenue,
                           r.product_units, r.total_units) for r in out}
    assert got == {"X": (33.0, 33.0, 100.0, 3, 3), "Y": (66.0, 66.0, 100.0, 7, 7)}


def test_presence_share_fixture(spark):
    h, _, nat, _ = _inputs(spark, [("A", "X"), ("B", "Y")])
    got = {r.boat: (r.passengers_sum, float(r.passengers_percentage))
           for r in presence_share(h, nat).collect()}
    assert got == {"A": (300, 33.3), "B": (300, 66.7)}


def test_round_div_is_half_away_from_zero(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1500,), (1499,), (-1500,), (-1499,), (2500,)], "n bigint")
    assert [r[0] for r in df.select(basket.round_div("n", 1000)).collect()] == [2, 1, -2, -1, 3]


def test_collation_matches_names_like_the_server(spark):
    harbour = spark.createDataFrame([(H, "AIDAmar ", 100, "a"), (H, "Gann", 200, "b")],
                                    "DateTime timestamp_ntz, boat string, passengers int, agent string")
    sales = spark.createDataFrame([(H, "Kaffe", 10, Decimal("99.00"))],
                                  "dt timestamp_ntz, product string, units bigint, total_price decimal(18,2)")
    nat = spark.createDataFrame([("aidamar", "X"), ("GANN", "Y")], "boat string, nationality string")
    dic = spark.createDataFrame([("kaffe", "Coffee")], "product string, EN string")
    exact = basket.apportioned_product_share(harbour, sales, nat, dic).collect()
    assert exact == []
    loose = basket.apportioned_product_share(harbour, sales, nat, dic,
                                             collation="UTF8_LCASE_RTRIM").collect()
    assert {r.nationality: r.total_units_sold for r in loose} == {"X": 3, "Y": 7}
    shares = presence_share(harbour, nat, collation="UTF8_LCASE_RTRIM").collect()
    assert sorted(r.nationality for r in shares) == ["X", "Y"]


def test_sales_of_a_hot_hour_are_summed_before_they_meet_the_groups(spark):
    """Half of all sales are of one hour with many groups: the join gets a row a product group
    (or distinct sale), the sales are read once, and the results are those of a plain join."""
    hot, cold = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9)
    data = [(hot if k % 2 else cold, k % 7, k % 3, f"{k % 5}.25") for k in range(4_000)]
    sales = spark.createDataFrame(data, "dt timestamp_ntz, product long, units long, p string") \
        .select("dt", "product", "units", F.col("p").cast("decimal(18,2)").alias("total_price"))
    dictionary = spark.createDataFrame([(k, f"EN{k % 2}") for k in range(6)],
                                       "product long, EN string")
    harbour = spark.createDataFrame([(hot, k, k + 1) for k in range(30)] + [(cold, 3, 9)],
                                    "DateTime timestamp_ntz, boat long, passengers long")
    nations = spark.createDataFrame([(k, f"N{k % 4}") for k in range(30)],
                                    "boat long, nationality string")
    sold = basket.sums_by_time(sales, dictionary)
    assert sold.count() == 4 and basket.equal_sales(sales, dictionary).count() <= 4 * 15
    plain = (sales.join(dictionary, "product").join(harbour, F.col("dt") == F.col("DateTime"))
             .join(nations, "boat").groupBy("EN", "nationality")
             .agg(F.sum("total_price").cast("double").alias("r"), F.sum("units").alias("u")))
    got = basket.replicated_sums(harbour, sold, nations).select(
        "EN", "nationality", F.col("revenue").cast("double"), F.col("units").cast("long"))
    assert rows(got) == rows(plain.select("EN", "nationality", "r", F.col("u").cast("long")))
    for share in (basket.replicated_product_share, basket.apportioned_product_share):
        result = share(harbour, sales, nations, dictionary)
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "total_price" not in plan and plan.count("FileScan parquet") == 2, plan
