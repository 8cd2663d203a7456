"""Typed inputs of the analytics from tables of texts, with what could not be typed.

Harbour and sales come as the cleaning writes them or as somebody's own export.  A row whose time
or number is given but is none goes to the rejects with its texts as they are, so nothing is
summed up without it unseen; values that are not given stay null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import number_text, unparsed, whole_number
from quayside.operators import corrections as C

# Column names of the cleaning outputs by the names the analytics use.
HARBOUR_NAMES = {"hourly_timestamp": "DateTime"}
SALES_NAMES = {"Datetime": "DateTime", "Product group": "product", "Units sold": "units",
               "Amount with VAT": "total_price"}


def _split(df: DataFrame, types: dict[str, Column], names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``df`` with the columns of ``types`` typed (and named by ``names``), and the rows that have
    a text there which is no such value."""
    bad = reduce(lambda a, b: a | b, [unparsed(c, parsed) for c, parsed in types.items()])
    typed = df.where(~bad).select(*[
        (types[c] if c in types else F.col(c)).alias(names.get(c, c)) for c in df.columns])
    return typed, df.where(bad)


def _time(c: str) -> Column:
    return F.col(c).try_cast("timestamp_ntz")


def typed_harbour(raw: DataFrame, passenger_fixes: DataFrame | None = None) \
        -> tuple[DataFrame, DataFrame]:
    """(DateTime, boat, passengers, agent) and the rejects.

    ``passenger_fixes`` (boat, passengers) overwrite counts before they are read, so they also put
    right what would be rejected.
    """
    df = raw.withColumnsRenamed(HARBOUR_NAMES).select(
        *[F.col(c).cast("string").alias(c) for c in ("DateTime", "boat", "passengers", "agent")])
    if passenger_fixes is not None:
        fixes = passenger_fixes.withColumn("passengers", F.col("passengers").cast("string"))
        df, _ = C.apply_fixes(df, fixes, ["boat"], ["passengers"], "hard")
    return _split(df, {"DateTime": _time("DateTime"), "passengers": whole_number("passengers")}, {})


def typed_sales(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dt, product, units, total_price decimal(18,2)) and the rejects."""
    df = raw.withColumnsRenamed(SALES_NAMES).select(
        *[F.col(c).cast("string").alias(c) for c in ("DateTime", "product", "units", "total_price")])
    return _split(df, {"DateTime": _time("DateTime"), "units": whole_number("units"),
                       "total_price": number_text("total_price").try_cast("decimal(18,2)")},
                  {"DateTime": "dt"})
