"""Small public helpers: A1-A2, C8, F10, number texts."""

from quayside.functions.text import (empty_to_null, number_text, replace_value, unparsed,
                                     whole_number)
from quayside.operators.aggregates import sum_by

from conftest import rows


def test_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, x int")
    assert rows(sum_by(df, "k", "x", "sx")) == [("a", 3), ("b", 3)]


def test_empty_markers(spark):
    df = spark.createDataFrame([(":",), ("",), (None,), ("08:00",)], "v string")
    out = df.select(replace_value("v", ":", "").alias("a"), empty_to_null("v").alias("b"))
    assert [tuple(r) for r in out.collect()] == [("", ":"), ("", None), (None, None),
                                                 ("08:00", "08:00")]


def test_number_texts(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("1 200",), ("1\u00a0200,0",), ("12,5",),
                                ("x",), ("",), (None,)], "v string")
    out = df.select(whole_number("v").alias("n"), number_text("v").try_cast("double").alias("d"),
                    unparsed("v", whole_number("v")).alias("bad"))
    assert [tuple(r) for r in out.collect()] == [
        (12, 12.0, False), (12, 12.0, False), (1200, 1200.0, False), (1200, 1200.0, False),
        (None, 12.5, True), (None, None, True), (None, None, False), (None, None, False)]
