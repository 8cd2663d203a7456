import os

import pytest
from pyspark.sql import functions as F

from quayside.plans.cleaning import clean_weather, weather_columns
from quayside.sources import files as SF

from conftest import rows


def test_csv_with_and_without_header(spark, tmp_dir):
    p = f"{tmp_dir}/a.csv"
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("x,y\n1,å\n2,b\n")
    assert rows(SF.read_csv(spark, p, ["x", "y"])) == [("1", "å"), ("2", "b")]
    assert rows(SF.read_csv(spark, p, ["c0", "c1"], header=False)) == [("1", "å"), ("2", "b"),
                                                                      ("x", "y")]


def test_cp1252_records_with_preamble(spark, tmp_dir):
    p = f"{tmp_dir}/w"
    os.makedirs(p)
    text = ("latitude,longitude,\n69.6,18.9,\n,\ntime,temperature (°C),\n"
            "2023-01-01T00:00,-3.5,\n2023-01-01T01:00,-4.0,\n")
    with open(f"{p}/weather.csv", "wb") as fh:
        fh.write(text.encode("cp1252"))
    ordered = SF.read_records(spark, p, "windows-1252")
    assert rows(SF.skip_leading(ordered, 3), "pos", "record")[0] == (3, "time,temperature (°C)")
    assert weather_columns(ordered) == ["time", "temperature (°C)"]
    typed = clean_weather(ordered, ["time", "temperature"])
    assert typed.count() == 2 and typed.where(F.col("time").isNull()).count() == 0


def test_weather_keeps_rows_with_bad_times(spark, tmp_dir):
    p = f"{tmp_dir}/w2"
    os.makedirs(p)
    text = "a,b,\n1,2,\n,\ntime,temp,\n2023-01-01T00:00,-3.5,\nbad-time,-4.0,\n"
    with open(f"{p}/weather.csv", "wb") as fh:
        fh.write(text.encode("cp1252"))
    out = clean_weather(SF.read_records(spark, p, "windows-1252"), ["time", "temp"])
    assert sorted(r.temp for r in out.collect()) == ["-3.5", "-4.0"]
    assert out.where(F.col("time").isNull()).count() == 1


def test_windows_1252_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a,b", 1), ("måling €‚…Ÿ™, 1", 2), (None, 3)], "`å€` string, n int")
    SF.write_csv(df, f"{tmp_dir}/o", encoding="windows-1252")
    back = SF.read_csv(spark, f"{tmp_dir}/o", ["n", "å€"], encoding="windows-1252")
    assert rows(back, "å€", "n") == rows(df.select("å€", F.col("n").cast("string")))


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    p = f"{tmp_dir}/c.csv"
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("Nr,Navn,Dato\n7,Ship,01.05.2023\n")
    assert rows(SF.read_csv(spark, p, ["Dato", "Navn"])) == [("01.05.2023", "Ship")]
    with pytest.raises(ValueError, match="ETA"):
        SF.read_csv(spark, p, ["Dato", "ETA"])


def test_row_ids_and_lines(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    with_id = SF.with_row_id(df)
    assert with_id.columns[0] == "ID" and with_id.select("ID").distinct().count() == 3
    stable = SF.with_row_id(df, key=["v"])
    assert rows(stable) == rows(SF.with_row_id(df, key=["v"]))
    SF.write_lines(df, "v", f"{tmp_dir}/lines")
    assert rows(spark.read.text(f"{tmp_dir}/lines")) == [("a",), ("b",), ("c",)]
    SF.write_csv(with_id, f"{tmp_dir}/csv", header=True)
    assert spark.read.option("header", True).csv(f"{tmp_dir}/csv").columns == ["ID", "v"]


def test_csv_without_header_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "x string, y string")
    SF.write_csv(df, f"{tmp_dir}/nohdr", header=False)
    back = SF.read_csv(spark, f"{tmp_dir}/nohdr", ["c0", "c1"], header=False)
    assert rows(back) == [("a", "1"), ("b", "2")]
    assert back.toDF("x", "y").columns == ["x", "y"]


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    from quayside.session import ensure_checkpoint_dir, shared_scratch
    base = ensure_checkpoint_dir(spark)
    assert base == spark.conf.get("spark.checkpoint.dir")
    a, b = shared_scratch(spark, "x"), shared_scratch(spark, "x")
    assert a.startswith(base.rstrip("/") + "/") and a != b


def test_a_cluster_session_needs_a_shared_folder():
    from types import SimpleNamespace as N

    from quayside.session import ensure_checkpoint_dir
    cluster = N(conf=N(get=lambda k, d=None: None),
                sparkContext=N(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(cluster)
