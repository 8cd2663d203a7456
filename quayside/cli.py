"""Command line: run the cleaning pipelines and the analytics on files.

    python -m quayside presence-build --calls calls.csv --roster roster/ --out harbour/ \\
        [--call-fixes f.csv] [--call-exclusions e.csv] [--roster-exclusions r.csv] \\
        [--roster-fixes h.csv] [--stay-offsets o.csv] [--boat-names n.csv] [--time-texts t.csv]
    python -m quayside clean-sales --raw sales.csv --year 2023 --out sales/
    python -m quayside clean-weather --raw weather.csv --out weather/
    python -m quayside clean-dictionary --raw product.csv --out dictionary/
    python -m quayside clean-calls --raw calls.csv --out calls/ [fix/exclusion/name options]
    python -m quayside analytics --harbour h --sales s --nationalities n --dictionary d \\
        --out results/ [--format csv|parquet] [--passenger-fixes p.csv] \\
        [--nationality-names m.csv]

Correction files are CSV with a header: fixes have the key columns (``date``, ``boat``)
and one column per fixed field; exclusions only the keys; offsets ``date, boat, days``;
name and time maps ``from_value, to_value``; passenger fixes ``boat, passengers``.  Outputs
are CSV directories with a header, one for the result and one for each report.  ``analytics``
takes the outputs of ``presence-build`` (hourly) and ``clean-sales`` (sales) as they are, or
tables with the columns ``DateTime, boat, passengers, agent`` and ``DateTime, product, units,
total_price``; rows whose times or numbers are none come out as ``harbour_rejects`` and
``sales_rejects``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import corrections as C
from quayside.plans import basket, cleaning, inputs, occupancy, roster
from quayside.session import build_session
from quayside.sources import files as SF


def _csv(spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path:
        return None
    return spark.read.option("header", True).csv(path)


def _corrections(spark: SparkSession, a) -> cleaning.Corrections:
    offsets = _csv(spark, a.stay_offsets)
    if offsets is not None:
        offsets = offsets.withColumn("days", F.col("days").cast("int"))
    return cleaning.Corrections(
        call_fixes=_csv(spark, a.call_fixes), call_exclusions=_csv(spark, a.call_exclusions),
        roster_exclusions=_csv(spark, a.roster_exclusions),
        roster_fixes=_csv(spark, a.roster_fixes), stay_offsets=offsets,
        boat_names=_csv(spark, a.boat_names), time_texts=_csv(spark, a.time_texts))


def _read_table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def _analytics_inputs(spark, a):
    """The four tables with the analytics' names and types, corrections applied, and the rows of
    harbour and sales that have no such values."""
    h, bad_harbour = inputs.typed_harbour(_read_table(spark, a.harbour, a.format),
                                          _csv(spark, a.passenger_fixes))
    s, bad_sales = inputs.typed_sales(_read_table(spark, a.sales, a.format))
    n = C.recode_column(_read_table(spark, a.nationalities, a.format), "nationality",
                        _csv(spark, a.nationality_names))
    rejects = {"harbour_rejects": bad_harbour, "sales_rejects": bad_sales}
    return (occupancy.zero_harbour_minutes(h), s, n, _read_table(spark, a.dictionary, a.format),
            rejects)


def _write(out: str, results: dict[str, DataFrame]) -> None:
    for name, df in results.items():
        SF.write_csv(df, f"{out}/{name}")


def _add_fix_options(p: argparse.ArgumentParser) -> None:
    for opt in ("call-fixes", "call-exclusions", "roster-exclusions", "roster-fixes",
                "stay-offsets", "boat-names", "time-texts"):
        p.add_argument(f"--{opt}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="quayside")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("presence-build")
    p.add_argument("--calls", required=True)
    p.add_argument("--roster", required=True)
    p.add_argument("--roster-encoding", default="UTF-8")
    p.add_argument("--staff-names", default="")
    p.add_argument("--out", required=True)
    _add_fix_options(p)
    p = sub.add_parser("clean-sales")
    p.add_argument("--raw", required=True)
    p.add_argument("--year", type=int, default=2023)
    p.add_argument("--out", required=True)
    p = sub.add_parser("clean-weather")
    p.add_argument("--raw", required=True)
    p.add_argument("--encoding", default="windows-1252")
    p.add_argument("--out", required=True)
    p = sub.add_parser("clean-dictionary")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("clean-calls")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    _add_fix_options(p)
    p = sub.add_parser("analytics")
    for t in ("harbour", "sales", "nationalities", "dictionary"):
        p.add_argument(f"--{t}", required=True)
    p.add_argument("--passenger-fixes")
    p.add_argument("--nationality-names")
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--collation", default=None,
                   help="match ship names and products under a collation, e.g. UTF8_LCASE_RTRIM")
    p.add_argument("--out", required=True)
    a = ap.parse_args(argv)

    spark = build_session(app_name=f"quayside-{a.cmd}")
    if a.cmd == "presence-build":
        raw = SF.read_csv(spark, a.calls, cleaning.CALL_COLUMNS)
        staff = [n for n in a.staff_names.split(",") if n]
        calls, left_over = roster.read_roster(spark, a.roster, a.roster_encoding,
                                              staff_names=staff or None)
        hourly, reports = cleaning.presence_build(raw, calls, _corrections(spark, a))
        left_over = left_over.withColumn("cells", F.array_join("cells", ","))
        _write(a.out, {"hourly": hourly, **reports, "roster_rejects": left_over})
    elif a.cmd == "clean-sales":
        raw = SF.read_csv(spark, a.raw, list(cleaning.SALES_RENAMES))
        sales, rejects = cleaning.clean_sales(raw, a.year)
        _write(a.out, {"sales": sales, "rejects": rejects})
    elif a.cmd == "clean-weather":
        recs = SF.read_records(spark, a.raw, a.encoding)
        SF.write_csv(cleaning.clean_weather(recs, cleaning.weather_columns(recs)), a.out)
    elif a.cmd == "clean-dictionary":
        SF.write_csv(cleaning.clean_dictionary(SF.read_csv(spark, a.raw, position="ID")), a.out)
    elif a.cmd == "clean-calls":
        raw = SF.read_csv(spark, a.raw, cleaning.CALL_COLUMNS, position="ID")
        calls, reports = cleaning.clean_cruise_calls(raw, _corrections(spark, a))
        _write(a.out, {"calls": calls, **reports})
    elif a.cmd == "analytics":
        h, s, n, d, rejects = _analytics_inputs(spark, a)
        c = a.collation
        results = {
            "passengers_by_hour": occupancy.occupancy_by_time(h),
            "occupancy_intervals": occupancy.occupancy_intervals(h),
            "presence_share": occupancy.presence_share(h, n, collation=c),
            "replicated_product_share": basket.replicated_product_share(h, s, n, d, collation=c),
            "replicated_basket_mix": basket.replicated_basket_mix(h, s, n, d, collation=c),
            "apportioned_product_share": basket.apportioned_product_share(h, s, n, d, collation=c),
            "apportioned_basket_mix": basket.apportioned_basket_mix(h, s, n, d, collation=c),
        }
        _write(a.out, {**results, **rejects})
    spark.stop()


if __name__ == "__main__":
    main()
