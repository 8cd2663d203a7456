import datetime as dt
import os
import random
import re

from pyspark.sql import functions as F

from quayside.operators import filters as FL
from quayside.operators.reshape import (expand_hours, hours_rejects, mark_headers, regrid_blocks,
                                        unpivot_pairs)
from quayside.operators.filters import drop_nulls
from quayside.plans.occupancy import hourly_presence
from quayside.plans import roster as R
from quayside.sources import files as SF

from conftest import rows

T = dt.datetime


def _stays(spark, data):
    return spark.createDataFrame(data, "boat string, arrival timestamp_ntz, departure timestamp_ntz")


def test_expand_hours_fixtures(spark):
    d = T(2023, 5, 1)
    data = [("a", d.replace(hour=8, minute=30), d.replace(hour=10, minute=10)),
            ("b", d.replace(hour=8), d.replace(hour=10)),
            ("c", d.replace(hour=9), d.replace(hour=9)),
            ("d", d.replace(hour=10), d.replace(hour=9)),
            ("e", None, d.replace(hour=9))]
    s = _stays(spark, data)
    got = rows(expand_hours(s, "arrival", "departure", "h"), "boat", "h")
    assert [r for r in got if r[0] == "a"] == [("a", d.replace(hour=8, minute=30)),
                                               ("a", d.replace(hour=9, minute=30))]
    assert len([r for r in got if r[0] == "b"]) == 3
    assert len([r for r in got if r[0] == "c"]) == 1
    assert not [r for r in got if r[0] in ("d", "e")]
    assert rows(hours_rejects(s, "arrival", "departure"), "boat") == [("d",), ("e",)]


def test_hours_then_zero_minutes(spark):
    d = T(2023, 5, 1)
    s = _stays(spark, [("a", d.replace(hour=8, minute=30), d.replace(hour=10, minute=10))]) \
        .selectExpr("boat", "arrival", "departure", "1 AS passengers")
    got = rows(hourly_presence(s), "DateTime")
    assert got == [(d.replace(hour=8),), (d.replace(hour=9),)]


def test_overnight_stay_gives_seven_hours(spark):
    s = _stays(spark, [("a", T(2023, 5, 1, 20), T(2023, 5, 2, 2))])
    assert expand_hours(s, "arrival", "departure", "h").count() == 7


def test_unpivot_pairs_keeps_pairs(spark):
    df = spark.createDataFrame([("d1", "A", "1", "B", None), ("d2", None, None, "C", "3")],
                               "Date string, Boat1 string, Time1 string, Boat2 string, Time2 string")
    out = drop_nulls(unpivot_pairs(df, ["Date"], [("Boat1", "Time1"), ("Boat2", "Time2")],
                                   ("Boat", "Time")), ["Boat", "Time"])
    assert rows(out) == [("d1", "A", "1"), ("d2", "C", "3")]


ROSTER = """Name,,,,,,,
week,5/1/2023,5/2/2023,,,,,
,ShipA,ShipB,,,,,
,0800 - 1700,0900 - 1800,,,,,
Staff,8-16,8-16,,,,,
,,,,,,,
week,5/8/2023,5/9/2023,,,,,
,ShipC,,,,,,
,1000 - 2000,,,,,,
,ShipD,,,,,,
"""


def _write_roster(tmp_dir, text):
    path = f"{tmp_dir}/roster"
    import os
    os.makedirs(path)
    with open(f"{path}/r.csv", "w", encoding="utf-8") as fh:
        fh.write("".join(line + ",\n" for line in text.strip("\n").split("\n")))
    return path


def test_regrid_fixture(spark, tmp_dir):
    from quayside.sources.files import read_records
    grid, rejects = R.roster_grid(read_records(spark, _write_roster(tmp_dir, ROSTER)))
    got = {r.Date: (r.Boat1, r.Time1, r.Boat2) for r in grid.collect() if r.Date not in ("*", "")}
    # the first block has no third record: its slot is missing (null), not ""
    assert got["5/1/2023"] == ("ShipA", "0800 - 1700", None)
    assert got["5/2/2023"] == ("ShipB", "0900 - 1800", None)
    assert got["5/8/2023"] == ("ShipC", "1000 - 2000", "ShipD")
    assert got["5/9/2023"] == (None, None, None)
    assert rejects.count() == 0
    calls = R.roster_calls(grid)
    assert rows(calls) == [("5/1/2023", "ShipA", "0800 - 1700"), ("5/2/2023", "ShipB", "0900 - 1800"),
                           ("5/8/2023", "ShipC", "1000 - 2000")]


def test_regrid_many_blocks_spans_buckets(spark, tmp_dir):
    """Blocks across many position buckets (width 4) regrid the same as one bucket."""
    from quayside.sources.files import read_records
    from quayside.operators.reshape import regrid_blocks, mark_headers
    from quayside.sources.files import split_cells
    from pyspark.sql import functions as F
    lines = ["Title,,,,,,,"]
    expect = []
    for w in range(12):
        day = w + 1
        lines.append(f"week,5/{day}/2023,,,,,,")
        lines.append(f",S{w},,,,,,")
        lines.append(f",{w:02d}00 - 1700,,,,,,")
        expect.append((f"5/{day}/2023", f"S{w}", f"{w:02d}00 - 1700"))
    path = _write_roster(tmp_dir, "\n".join(lines))
    recs = read_records(spark, path).where(F.col("pos") > 0)
    recs = recs.withColumn("cells", split_cells("record")) \
        .withColumn("is_header", mark_headers("cells", 1, R.DATE_PATTERN))
    grid, _ = regrid_blocks(recs, "file", "pos", "cells", "is_header", R.SLOT_NAMES, width=4)
    got = rows(grid.where(F.col("cell") == 1), "Date", "Boat1", "Time1")
    assert got == sorted(expect)


def test_staff_rows_dropped_by_name(spark, tmp_dir):
    text = ROSTER.replace("Staff,8-16,8-16", ",Kari 8-16,Ola 8-16")
    calls, _ = R.read_roster(spark, _write_roster(tmp_dir, text), staff_names=["Kari", "Ola"])
    assert rows(calls) == [("5/1/2023", "ShipA", "0800 - 1700"), ("5/2/2023", "ShipB", "0900 - 1800"),
                           ("5/8/2023", "ShipC", "1000 - 2000")]


def test_records_before_a_block_and_beyond_the_slots_are_rejects(spark, tmp_dir):
    extra = "\n".join(f",extra{k},,,,,," for k in range(4))
    text = "Title,,,,,,,\n,lost,,,,,,\nweek,5/1/2023,,,,,,\n" + "\n".join(
        f",v{k},,,,,," for k in range(6)) + "\n" + extra
    _, rejects = R.read_roster(spark, _write_roster(tmp_dir, text))
    assert sorted((r.reason, r.cells[1]) for r in rejects.collect()) == [
        ("no block", "lost"), *(("no slot", f"extra{k}") for k in range(4))]


def test_one_file_spans_tasks_and_keeps_its_order(spark, tmp_dir):
    from quayside.sources.files import read_records, skip_leading
    lines = [f"r{k},x" for k in range(20_000)]
    path = _write_roster(tmp_dir, "\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        recs = read_records(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        found = recs.orderBy("pos").collect()
        assert [r.record for r in found] == lines
        assert [r.pos for r in found] == list(range(len(lines)))  # without holes
        assert skip_leading(recs, 15_000).count() == 5_000  # more than the first splits hold
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def _brute_grid(lines, slots):
    """Blocks, slots and rejects of roster records by walking them one by one."""
    kept = [x for x in lines if x != R.BLANK_RECORD][1:]
    grid, rejects, block, slot = {}, [], 0, 0
    for line in kept:
        cells = line.split(",")
        header = len(cells) > 1 and bool(re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", cells[1]))
        if not header and cells[0] != "":
            continue
        block, slot = (block + 1, 0) if header else (block, slot + 1)
        if not block:
            rejects.append(("no block", cells[1]))
        elif slot >= len(slots):
            rejects.append(("no slot", cells[1]))
        else:
            for k, c in enumerate(["*", *cells[1:]] if header else cells):
                if c:
                    grid.setdefault((block, k), {})[slots[slot]] = c
    return sorted((b, k, *(m.get(n) for n in slots)) for (b, k), m in grid.items()), sorted(rejects)


def test_regrid_equals_a_walk_over_the_records(spark, tmp_dir):
    rng = random.Random(9)
    for trial, title in enumerate(["Title,,,,,,,", "week,4/30/2023,,,,,,", ",first,,,,,,"]):
        lines = [R.BLANK_RECORD] * 3 + [title, ",lost,,,,,,"]
        for _ in range(60):
            lines.append(rng.choice([
                R.BLANK_RECORD, "Staff,8-16,,,,,,", "Staff,8-16,,,,,,"] + [
                f"week,{rng.randint(1, 12)}/{rng.randint(1, 28)}/2023,5/2/2023,,,,,"] + [
                f",s{rng.randint(0, 99)},,t{rng.randint(0, 9)},,,,"] * 6))
        folder = f"{tmp_dir}/{trial}"
        os.makedirs(folder)
        recs = SF.read_records(spark, _write_roster(folder, "\n".join(lines)))
        recs = FL.drop_blank_records(recs, "record", R.BLANK_RECORD) \
            .withColumn("cells", SF.split_cells("record"))
        recs = recs.withColumn("header", F.coalesce(mark_headers("cells", 1, R.DATE_PATTERN),
                                                    F.lit(False)))
        recs = recs.withColumn("listed", F.col("header") | (F.get("cells", F.lit(0)) == ""))
        grid, rejects = regrid_blocks(recs, "file", "pos", "cells", "header", R.SLOT_NAMES, width=4,
                                      drop_empty=True, keep_col="listed", title=True)
        expected = _brute_grid(lines, R.SLOT_NAMES)
        assert sorted(rows(grid.drop("file")), key=lambda r: r[:2]) == expected[0]
        assert sorted((r.reason, r.cells[1]) for r in rejects.collect()) == expected[1]
