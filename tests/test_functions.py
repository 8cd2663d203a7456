import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quayside.functions import text as T
from quayside.functions import time as TM
from quayside.operators.corrections import recode

# Two entries of the ship-name recode, as in the FIXTURES.md example.
NAMES = {"Sverdrup": "Otto Sverdrup", "Mein Schiff": "Mein Schiff 4"}


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([("5",), ("12",), ("123",), (None,)], "v string")
    out = [r[0] for r in df.select(T.zero_pad("v")).collect()]
    assert out == ["05", "12", "123", None]


def test_strip_then_recode_is_one_pass(spark):
    df = spark.createDataFrame([("Sverdrup ?",), ("Mein Schiff",), ("Mein Schiff 4",)], "v string")
    out = [r[0] for r in df.select(recode(T.strip_chars("v", " ?"), NAMES)).collect()]
    assert out == ["Otto Sverdrup", "Mein Schiff 4", "Mein Schiff 4"]


def test_strip_whitespace_handles_tabs_and_newlines(spark):
    df = spark.createDataFrame([(" \t a b \n",)], "v string")
    assert df.select(T.strip_whitespace("v")).first()[0] == "a b"


def _parse(spark, raw):
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    eta, etd = TM.split_time_range("raw")
    df = df.select("raw", TM.clean_clock_text(eta).alias("eta"), TM.clean_clock_text(etd).alias("etd"))
    df = df.withColumn("etd", recode("etd", {"2400": "2359"}))
    return {r.raw: (r.eta_c, r.etd_c) for r in df.select(
        "raw", TM.compact_time("eta").alias("eta_c"), TM.compact_time("etd").alias("etd_c")).collect()}


def test_time_range_fixtures(spark):
    got = _parse(spark, ["0800 - 1700", "1300-2400", "0700 - ?", ": 0900 -1500", "0800",
                         "08:00 - 17:00"])
    assert got["0800 - 1700"] == ("08:00", "17:00")
    assert got["1300-2400"] == ("13:00", "23:59")
    assert got["0700 - ?"] == ("07:00", "")
    assert got[": 0900 -1500"] == (" 0:900", "15:00")
    assert got["0800"] == ("08:00", None)
    assert got["08:00 - 17:00"] == ("08::00", "17::00")


def test_lenient_timestamp_rejects_malformed(spark):
    df = spark.createDataFrame([("2023-05-01 08:00:00",), ("2023-05-01  0:900:00",),
                                ("2023-05-01 08::00:00",), ("2023-05-01 :00",)], "v string")
    out = [r[0] for r in df.select(TM.lenient_timestamp("v")).collect()]
    assert out == [dt.datetime(2023, 5, 1, 8, 0), None, None, None]


def test_zero_minutes_keeps_seconds(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 5, 1, 10, 35, 7, 500000),)], "t timestamp_ntz")
    assert df.select(TM.zero_minutes("t")).first()[0] == dt.datetime(2023, 5, 1, 10, 0, 7, 500000)


def test_reorder_dates(spark):
    df = spark.createDataFrame([("5/1/2023", "05.06.2023")], "mdy string, dmy string")
    r = df.select(TM.reorder_date_text("mdy", "/", (2, 0, 1), pad=True),
                  TM.reorder_date_text("dmy", ".", (2, 1, 0))).first()
    assert tuple(r) == ("2023-05-01", "2023-06-05")


def test_iso_hour_assembly(spark):
    df = spark.createDataFrame([(2023, 1, 1, 4), (2023, 12, 31, 24)], "y int, m int, d int, h int")
    out = [r[0] for r in df.select(TM.lenient_timestamp(TM.iso_hour_text("y", "m", "d", "h"))).collect()]
    assert out == [dt.datetime(2023, 1, 1, 4, 0), None]


def test_roll_overnight(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 5, 1, 20), dt.datetime(2023, 5, 1, 2)),
                                (dt.datetime(2023, 5, 1, 9), dt.datetime(2023, 5, 1, 9))],
                               "a timestamp_ntz, d timestamp_ntz")
    out = [r[0] for r in df.select(TM.roll_overnight("a", "d")).collect()]
    assert out == [dt.datetime(2023, 5, 2, 2), dt.datetime(2023, 5, 1, 9)]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("2.675"), Decimal("0.5"), Decimal("-2.5"))],
                               "a decimal(5,3), b decimal(3,1), c decimal(3,1)")
    r = df.select(F.round("a", 2), F.round("b", 0), F.round("c", 0)).first()
    assert tuple(r) == (Decimal("2.68"), Decimal("1"), Decimal("-3"))


def test_strict_timestamp_fails_on_bad_text(spark):
    import pytest
    df = spark.createDataFrame([("2023-05-01 08::00:00",)], "v string")
    with pytest.raises(Exception):
        df.select(TM.strict_timestamp("v")).collect()
    ok = spark.createDataFrame([("2023-05-01 08:00:00",)], "v string")
    assert ok.select(TM.strict_timestamp("v")).first()[0] == dt.datetime(2023, 5, 1, 8)
