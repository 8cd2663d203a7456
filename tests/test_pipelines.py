import datetime as dt
import os

from pyspark.sql import functions as F

from quayside.plans import cleaning
from quayside.plans import roster as R
from quayside.sources import files as SF

from conftest import rows

CALLS = """Dato,ETA,ETD,Navn,Passasjerer,Agent,Kai,Tonn,Lengde
01.05.2023,08:00,17:00,Aidaluna,2000,AgentX,Q1,1000,200
01.05.2023,,,Bolette,,AgentY,Q2,900,190
02.05.2023,20:00,02:00,Jewel of the Seas,3000,AgentZ,Q3,1100,300
03.05.2023,09:00,12:00,Queen Victoria,1500,A,Q,1,1
"""

ROSTER = """Roster,,,,,,,
week,5/1/2023,5/2/2023,5/3/2023,,,,
,Aidaluna ?,,,,,,
,1000 - 1800,,,,,,
,Bolette,,,,,,
,0900 - 1600,,,,,,
Staff,8-16,8-16,8-16,,,,
,,,,,,,
"""

NAMES = {"Aidaluna": "AIDAluna"}


def _write(path, text, name):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as fh:
        fh.write(text)


def test_presence_build_fixture(spark, tmp_dir):
    _write(f"{tmp_dir}/calls", CALLS, "calls.csv")
    _write(f"{tmp_dir}/roster", "".join(l + ",\n" for l in ROSTER.strip("\n").split("\n")), "r.csv")
    raw = SF.read_csv(spark, f"{tmp_dir}/calls", cleaning.CALL_COLUMNS)
    roster, _ = R.read_roster(spark, f"{tmp_dir}/roster")
    fixes = cleaning.Corrections(
        call_fixes=spark.createDataFrame([("01.05.2023", "Bolette", None, None, "1 444.0")],
                                         "date string, boat string, ETA string, ETD string, "
                                         "passengers string"),
        call_exclusions=spark.createDataFrame([("03.05.2023", "Queen Victoria")],
                                              "date string, boat string"),
        boat_names=NAMES)
    hourly, reports = cleaning.presence_build(raw, roster, fixes)
    rejects, incomplete = reports["rejects"], reports["incomplete"]
    got = rows(hourly, "boat", "hourly_timestamp", "passengers")
    by_boat = {}
    for b, t, p in got:
        by_boat.setdefault(b, []).append((t, p))
    assert set(by_boat) == {"AIDAluna", "Bolette", "Jewel of the Seas"}
    a = [t for t, _ in by_boat["AIDAluna"]]
    assert a[0] == dt.datetime(2023, 5, 1, 10) and a[-1] == dt.datetime(2023, 5, 1, 18) and len(a) == 9
    b = by_boat["Bolette"]
    assert len(b) == 8 and {p for _, p in b} == {1444}
    j = [t for t, _ in by_boat["Jewel of the Seas"]]
    assert j[0] == dt.datetime(2023, 5, 2, 20) and j[-1] == dt.datetime(2023, 5, 3, 2) and len(j) == 7
    assert rejects.count() == 0
    # the completeness report is on the calls: Bolette still lacks its call times
    assert rows(incomplete, "boat") == [("Bolette",)]


def test_presence_build_with_offsets(spark, tmp_dir):
    _write(f"{tmp_dir}/calls", CALLS, "calls.csv")
    _write(f"{tmp_dir}/roster", "".join(l + ",\n" for l in ROSTER.strip("\n").split("\n")), "r.csv")
    raw = SF.read_csv(spark, f"{tmp_dir}/calls", cleaning.CALL_COLUMNS)
    roster, _ = R.read_roster(spark, f"{tmp_dir}/roster")
    offsets = spark.createDataFrame([("2023-05-02", "Jewel of the Seas", 1)],
                                    "date string, boat string, days int")
    fixes = cleaning.Corrections(stay_offsets=offsets, boat_names=NAMES)
    hourly, reports = cleaning.presence_build(raw, roster, fixes)
    rejects, incomplete = reports["rejects"], reports["incomplete"]
    j = hourly.where(F.col("boat") == "Jewel of the Seas").count()
    assert j == 7 + 24
    # Bolette has no call times and no fix: still timed from the roster
    assert hourly.where(F.col("boat") == "Bolette").count() == 8
    assert incomplete.count() == 1


def test_sales_cleaning_fixture(spark, tmp_dir):
    text = ("Måned,Dag,Time,Varegruppe,Antall,Belåp m/mva\n"
            "1,1,4,Souvenir,2.0,\"99,50\"\n12,31,23,Food,1,1 234.50\n1,,,Sum,3,109.50\n"
            "1,2,3,Toy,1.5,9\n1,2,3,Toy,1,free\n")
    _write(f"{tmp_dir}/s", text, "s.csv")
    raw = SF.read_csv(spark, f"{tmp_dir}/s", list(cleaning.SALES_RENAMES))
    sales, rejects = cleaning.clean_sales(raw)
    assert rows(rejects, "Units sold", "Amount with VAT") == [("1", "free"), ("1.5", "9")]
    out = rows(sales)
    assert [float(r[3]) for r in out] == [99.5, 1234.5]
    assert [r[0] for r in out] == [dt.datetime(2023, 1, 1, 4), dt.datetime(2023, 12, 31, 23)]
    assert [r[1:3] for r in out] == [("Souvenir", 2), ("Food", 1)]


def test_dictionary_cleaning(spark):
    raw = spark.createDataFrame([("Kaffe", "Coffee"), ("Te", None)], "product string, EN string")
    out = cleaning.clean_dictionary(raw)
    assert out.columns == ["ID", "product", "EN"] and out.count() == 1


def test_cruise_calls_cleaning(spark, tmp_dir):
    _write(f"{tmp_dir}/calls", CALLS, "calls.csv")
    raw = SF.read_csv(spark, f"{tmp_dir}/calls", cleaning.CALL_COLUMNS)
    calls, reports = cleaning.clean_cruise_calls(raw, cleaning.Corrections(boat_names=NAMES))
    incomplete = reports["incomplete"]
    assert dict(calls.dtypes)["Passasjerer"] == "bigint" and dict(calls.dtypes)["Tonn"] == "double"
    assert calls.columns[4:] == ["Navn", "Passasjerer", "Kai", "Agent", "Tonn", "Lengde"]
    got = {r.Navn: (r["Date of arrival"], r["Date of departure"]) for r in calls.collect()}
    assert got["Jewel of the Seas"] == (dt.datetime(2023, 5, 2), dt.datetime(2023, 5, 3))
    assert got["AIDAluna"] == (dt.datetime(2023, 5, 1), dt.datetime(2023, 5, 1))
    assert rows(incomplete, "boat") == [("Bolette",)]
