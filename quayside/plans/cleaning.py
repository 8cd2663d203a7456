"""Cleaning of raw exports into typed tables (Q8-Q12).

Every step is a DataFrame transformation; corrections come in as small keyed tables
(see :mod:`quayside.operators.corrections`) instead of row positions, so the jobs run
unchanged on any export and on any number of files.

Raw inputs are all-string DataFrames with the export's own column names:

* cruise calls: ``Dato`` (``dd.mm.yyyy``), ``ETA``, ``ETD`` (``HH:mm``), ``Navn``,
  ``Passasjerer``, ``Agent``, ``Kai``, ``Tonn``, ``Lengde``
* roster: ordered records (see :mod:`quayside.plans.roster`)
* sales: ``Måned``, ``Dag``, ``Time``, ``Varegruppe``, ``Antall``, ``Belåp m/mva``
* weather: records ending in ``",\\n"``, three preamble records, a header, then data
* product dictionary: any columns; rows with a gap are dropped
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import (number_text, strip_chars, strip_whitespace, unparsed,
                                     whole_number)
from quayside.functions.time import (clean_clock_text, compact_time, iso_hour_text,
                                     join_date_time, lenient_timestamp, one_day,
                                     reorder_date_text, split_time_range)
from quayside.operators import corrections as C
from quayside.operators import filters as FL
from quayside.operators.joins import anti_join, outer_merge
from quayside.operators.reshape import expand_hours, hours_rejects
from quayside.sources.files import skip_leading, with_row_id

# Column names of the raw exports and their clean names.
CALL_COLUMNS = ["Dato", "ETA", "ETD", "Navn", "Passasjerer", "Agent", "Kai", "Tonn", "Lengde"]
CALL_RENAMES = {"Dato": "date", "Navn": "boat", "Passasjerer": "passengers", "Kai": "quay",
                "Tonn": "weight", "Lengde": "lenght", "Agent": "agent"}
SALES_RENAMES = {"Måned": "Month", "Dag": "Day", "Time": "Hours", "Varegruppe": "Product group",
                 "Antall": "Units sold", "Belåp m/mva": "Amount with VAT"}
# Fixed value: the end-of-day spelling in rosters.
END_OF_DAY = {"2400": "2359"}


@dataclass
class Corrections:
    """Keyed correction tables for the presence build; any of them may be None.

    * ``call_fixes``: (date, boat) + nullable ETA, ETD, passengers - soft (fill gaps)
    * ``call_exclusions``: (date, boat) of calls that never happened
    * ``roster_exclusions``: (Date, Boat) roster entries to drop (duplicates)
    * ``roster_fixes``: (date, boat) + nullable ETA, ETD - hard (overwrite)
    * ``stay_offsets``: (date, boat, days) extra days on the departure
    * ``boat_names``: raw name -> clean name, applied to calls and roster
    * ``time_texts``: raw roster time -> clean roster time

    The last two are dicts or tables (from_value, to_value).
    """
    call_fixes: DataFrame | None = None
    call_exclusions: DataFrame | None = None
    roster_exclusions: DataFrame | None = None
    roster_fixes: DataFrame | None = None
    stay_offsets: DataFrame | None = None
    boat_names: dict | DataFrame | None = None
    time_texts: dict | DataFrame | None = None


# --------------------------------------------------------------------------- Q8 pieces

def clean_roster(calls: DataFrame, fixes: Corrections) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Roster (Date, Boat, Time) -> (boat, time, date, ETA, ETD) compact times, and reports.

    Strip ``" ?"`` from names, recode names and time texts, ``m/d/yyyy`` -> ``yyyy-mm-dd``,
    split the time range, strip white space / ``:`` / ``?``, 2400 -> 2359.  The keyed hard fixes
    are written when the roster meets the calls (:func:`merge_calls_roster`).
    """
    df, reports = calls, {}
    if fixes.roster_exclusions is not None:
        df = C.exclude_keys(df, fixes.roster_exclusions, ["Date", "Boat"])
    df = df.withColumn("Boat", strip_chars("Boat", " ?"))
    df = C.recode_column(df, "Boat", fixes.boat_names)
    df = C.recode_column(df, "Time", fixes.time_texts)
    df = df.withColumn("date", reorder_date_text("Date", "/", (2, 0, 1), pad=True))
    df = df.withColumn("Time", strip_whitespace("Time"))
    eta, etd = split_time_range("Time")
    df = df.withColumns({"ETA": clean_clock_text(eta), "ETD": clean_clock_text(etd)})
    df = df.withColumn("ETD", C.recode("ETD", END_OF_DAY))
    df = df.select(F.col("Boat").alias("boat"), F.col("Time").alias("time"), "date", "ETA", "ETD")
    if fixes.roster_fixes is not None:
        reports["unused_roster_fixes"] = anti_join(
            fixes.roster_fixes, df, ["date", "boat"])
        reports["conflicting_roster_fixes"] = C.fix_conflicts(
            fixes.roster_fixes, ["date", "boat"], ["ETA", "ETD"])
    return df, reports


def typed_calls(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls with passengers as bigint, weight and length as double, and those whose text
    isn't such a number (as read)."""
    types = {"passengers": whole_number, "weight": lambda c: number_text(c).try_cast("double"),
             "lenght": lambda c: number_text(c).try_cast("double")}
    bad = F.lit(False)
    for name, parse in types.items():
        bad = bad | unparsed(name, parse(name))
    return (calls.where(~bad).withColumns({n: parse(n) for n, parse in types.items()}),
            calls.where(bad))


def clean_calls(raw: DataFrame, fixes: Corrections) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Cruise calls -> (calls, reports).

    Calls get soft fixes keyed by (date, boat), exclusions, the boat-name recode, typed
    numbers and the ``dd.mm.yyyy`` -> ``yyyy-mm-dd`` date.  Reports: ``incomplete`` (calls
    still missing a name, passenger count, date or time after the fixes, F4), ``unparsed``
    (calls with a number that isn't one), ``unused_call_fixes``, ``conflicting_call_fixes``.
    """
    kept = ["ID"] if "ID" in raw.columns else []  # the row's number in the export
    df, reports = raw.select(*kept, *CALL_COLUMNS).withColumnsRenamed(CALL_RENAMES), {}
    fields = ["ETA", "ETD", "passengers"]
    if fixes.call_fixes is not None:
        reports["unused_call_fixes"] = anti_join(fixes.call_fixes, df, ["date", "boat"])
        reports["conflicting_call_fixes"] = C.fix_conflicts(
            fixes.call_fixes, ["date", "boat"], fields)
    df = C.apply_corrections(df, C.merge_corrections(
        ["date", "boat"], fields, soft=fixes.call_fixes, exclusions=fixes.call_exclusions),
        ["date", "boat"], fields).drop("__days")
    reports["incomplete"] = FL.incomplete_rows(df, ["boat", "passengers", "date", "ETA", "ETD"]) \
        .drop("__excluded")
    df = df.where("NOT __excluded").drop("__excluded")
    df = C.recode_column(df, "boat", fixes.boat_names)
    df, reports["unparsed"] = typed_calls(df)
    day = reorder_date_text("date", ".", (2, 1, 0))
    df = df.withColumns({"Date of arrival": day, "Date of departure": day})
    return df.withColumn("date", F.col("Date of arrival")), reports


def merge_calls_roster(calls: DataFrame, roster: DataFrame,
                       fixes: Corrections | None = None) -> DataFrame:
    """J1 + C9: outer merge on (date, boat); roster times win when present and non-empty.

    What corrects a (date, boat), the roster's hard fixes and the day offsets, comes in one join
    here: fixes go to rows that the roster has, ``"0800"`` becomes ``"08:00"``, and ``__days`` is
    for :func:`call_times`.
    """
    fixes = fixes or Corrections()
    merged = outer_merge(calls, roster.withColumn("__listed", F.lit(True)), ["date", "boat"])
    wide = C.merge_corrections(["date", "boat"], ["ETA_y", "ETD_y"], offsets=fixes.stay_offsets,
                               hard=None if fixes.roster_fixes is None else
                               fixes.roster_fixes.withColumnsRenamed({"ETA": "ETA_y", "ETD": "ETD_y"}))
    fixed = C.apply_corrections(merged, wide, ["date", "boat"], ["ETA_y", "ETD_y"])
    listed = {c: F.when(F.col("__listed"), compact_time(c)) for c in ("ETA_y", "ETD_y")}
    return fixed.withColumns(listed).withColumns({
        "ETA_x": C.override_when_present("ETA_x", "ETA_y"),
        "ETD_x": C.override_when_present("ETD_x", "ETD_y")}) \
        .drop("time", "ETA_y", "ETD_y", "__listed", "__excluded")


def call_times(merged: DataFrame) -> DataFrame:
    """Arrival and departure timestamps with the overnight rule and the keyed day offsets."""
    df = merged.withColumns({
        "ETA date": lenient_timestamp(join_date_time("Date of arrival", "ETA_x")),
        "ETD date": lenient_timestamp(join_date_time("Date of arrival", "ETD_x")),
        "Date of arrival": lenient_timestamp("Date of arrival"),
        "Date of departure": lenient_timestamp("Date of departure")})
    overnight = F.col("ETD date") < F.col("ETA date")
    shift = F.make_dt_interval(F.col("__days"))
    return df.withColumns({
        "Date of departure": F.when(overnight, F.col("Date of departure") + one_day())
        .otherwise(F.col("Date of departure")) + shift,
        "ETD date": F.when(overnight, F.col("ETD date") + one_day()).otherwise(F.col("ETD date"))
        + shift}).drop("__days")


HOURLY_COLUMNS = ["hourly_timestamp", "boat", "passengers", "quay", "agent", "weight", "lenght"]


def presence_build(raw_calls: DataFrame, roster_calls: DataFrame,
                   fixes: Corrections | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Q8: cruise calls + roster -> hourly presence.

    Returns ``(hourly, reports)``: one row per call and hour present (``HOURLY_COLUMNS``), and
    by name what did not go in or needs a look: ``rejects`` (calls whose times are missing or
    reversed) and the reports of :func:`clean_calls` and :func:`clean_roster`.
    """
    fixes = fixes or Corrections()
    calls, reports = clean_calls(raw_calls, fixes)
    roster, roster_reports = clean_roster(roster_calls, fixes)
    timed = call_times(merge_calls_roster(calls, roster, fixes))
    hourly = expand_hours(timed, "ETA date", "ETD date", "hourly_timestamp")
    rejects = hours_rejects(timed, "ETA date", "ETD date")
    return hourly.select(*HOURLY_COLUMNS), {**reports, **roster_reports, "rejects": rejects}


# --------------------------------------------------------------------------- Q9-Q12

def clean_sales(raw: DataFrame, year=2023) -> tuple[DataFrame, DataFrame]:
    """Q9: rename, drop subtotal rows (any gap), add the year, pad, assemble the hour.

    ``year`` is a constant or a Column (e.g. a partition column of the export).  Returns
    ``(sales, rejects)``: rejects are the rows whose units or amount are not numbers, as read.
    """
    df = raw.withColumnsRenamed(SALES_RENAMES)
    df = FL.drop_nulls(df, list(SALES_RENAMES.values()))
    y = year if isinstance(year, Column) else F.lit(year)
    df = df.withColumn("Year", y.cast("string"))
    units = whole_number("Units sold")
    amount = number_text("Amount with VAT").try_cast("decimal(18,2)")
    bad = units.isNull() | amount.isNull()
    time = lenient_timestamp(iso_hour_text("Year", "Month", "Day", "Hours"))
    sales = df.where(~bad).select(time.alias("Datetime"), "Product group",
                                  units.alias("Units sold"), amount.alias("Amount with VAT"))
    return sales, df.where(bad).select(time.alias("Datetime"), "Product group", "Units sold",
                                       "Amount with VAT")


def clean_weather(records: DataFrame, names: list[str], time_col: str = "time",
                  preamble: int = 3) -> DataFrame:
    """Q10: ordered weather records -> rows with a typed time.

    ``records`` are ``(file, pos, record)`` from
    :func:`quayside.sources.files.read_records`.  The first ``preamble`` records
    and the header after them are skipped by position (S5); every later record is parsed
    as CSV into ``names`` and ``time`` becomes ``timestamp_ntz`` (null when unparsable,
    the row is kept).
    """
    data = skip_leading(records, preamble + 1)
    schema = ", ".join(f"`{n}` STRING" for n in names)
    parsed = data.select(F.from_csv("record", schema).alias("r")).select("r.*")
    return parsed.withColumn(time_col, lenient_timestamp(time_col))


def weather_columns(records: DataFrame, preamble: int = 3) -> list[str]:
    """The column names in the header record of the export's first file."""
    head = records.where(F.col("pos") == preamble).orderBy("file").select("record").first()
    if head is None:
        raise ValueError("the export has no header record")
    return [c.strip() for c in head[0].split(",")]


def clean_dictionary(raw: DataFrame, id_key: list[str] | None = None) -> DataFrame:
    """Q11: complete rows only, with an ``ID`` column first: the one that ``raw`` has (the row's
    number in the export, see ``position`` of :func:`quayside.sources.files.read_csv`; dropped
    rows leave gaps), else a new one."""
    whole = FL.drop_nulls(raw)
    return whole if "ID" in raw.columns else with_row_id(whole, "ID", id_key)


def clean_cruise_calls(raw: DataFrame, fixes: Corrections | None = None
                       ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Q12: stand-alone cruise-call cleaning.

    Returns ``(calls, reports)``: calls with ``Date of arrival``, ``Date of departure``
    (plus one day when the stay passes midnight), ``ETA``, ``ETD`` and the other export
    columns under their own names (``Navn``, ``Passasjerer``, ``Kai``, ``Agent``, ``Tonn``,
    ``Lengde``); the reports are those of :func:`clean_calls`.  Fix and exclusion keys use the
    names ``date`` and ``boat`` as in the presence build.
    """
    kept = ["ID"] if "ID" in raw.columns else []
    calls, reports = clean_calls(raw, fixes or Corrections())
    eta = lenient_timestamp(join_date_time("Date of arrival", "ETA"))
    etd = lenient_timestamp(join_date_time("Date of arrival", "ETD"))
    arrival = lenient_timestamp("Date of arrival")
    departure = F.when(etd < eta, arrival + one_day()).otherwise(arrival)
    back = {v: k for k, v in CALL_RENAMES.items() if k != "Dato"}
    out = calls.select(*kept, arrival.alias("Date of arrival"), departure.alias("Date of departure"),
                       "ETA", "ETD", *[F.col(c).alias(back[c]) for c in
                                       ("boat", "passengers", "quay", "agent", "weight", "lenght")])
    return out, reports
