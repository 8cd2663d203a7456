"""Registered text and time cleaning queries.

The raw texts are built from whole tables by fixed rules that reproduce the shapes found
in hand-kept exports: ``"0800 - 1700"``, ``"1300-2400"``, ``": 0900 -1500"``,
``"0700 - ?"``, a lone ``"0800"``, unpadded ``m/d/yyyy`` dates and names with stray
``" ?"`` decorations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.functions.text import strip_chars, strip_whitespace, zero_pad
from quayside.functions.time import (clean_clock_text, compact_time, iso_hour_text,
                                     join_date_time, lenient_timestamp, reorder_date_text,
                                     split_time_range)
from quayside.operators.corrections import recode
from quayside.plans.cleaning import END_OF_DAY
from quayside.plans.registry import register
from quayside.sources.tables import read_table

_RAW_RANGE_SQL = """
    SELECT event_id, ts,
           CASE event_type
             WHEN 'view' THEN strftime(ts, '%H%M') || ' - ' || strftime(ts + INTERVAL 2 HOUR, '%H%M')
             WHEN 'click' THEN strftime(ts, '%H%M') || '-2400'
             WHEN 'error' THEN ': ' || strftime(ts, '%H%M') || ' -' || strftime(ts + INTERVAL 1 HOUR, '%H%M')
             WHEN 'purchase' THEN strftime(ts, '%H%M') || ' - ?'
             ELSE strftime(ts, '%H%M') END AS raw
    FROM events"""


def _raw_ranges(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    hhmm = F.date_format("ts", "HHmm")
    plus = lambda h: F.date_format(F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(h)), "HHmm")
    t = F.col("event_type")
    raw = (F.when(t == "view", F.concat(hhmm, F.lit(" - "), plus(2)))
           .when(t == "click", F.concat(hhmm, F.lit("-2400")))
           .when(t == "error", F.concat(F.lit(": "), hhmm, F.lit(" -"), plus(1)))
           .when(t == "purchase", F.concat(hhmm, F.lit(" - ?")))
           .otherwise(hhmm))
    return ev.select("event_id", "ts", raw.alias("raw"))


@register("time_range_parsing", """
    WITH parts AS (
        SELECT event_id, ts, raw,
               trim(trim(trim(string_split(trim(raw), '-')[1]), ':'), '?') AS eta,
               trim(trim(trim(string_split(trim(raw), '-')[2]), ':'), '?') AS etd0
        FROM raw_ranges),
    clocks AS (
        SELECT event_id, ts, raw, eta,
               CASE WHEN etd0 = '2400' THEN '2359' ELSE etd0 END AS etd
        FROM parts),
    fmt AS (
        SELECT event_id, ts, raw,
               CASE WHEN substr(eta, 1, 2) || ':' || substr(eta, 3, 3) = ':' THEN ''
                    ELSE substr(eta, 1, 2) || ':' || substr(eta, 3, 3) END AS eta_clock,
               CASE WHEN substr(etd, 1, 2) || ':' || substr(etd, 3, 3) = ':' THEN ''
                    ELSE substr(etd, 1, 2) || ':' || substr(etd, 3, 3) END AS etd_clock
        FROM clocks)
    SELECT event_id, raw, eta_clock, etd_clock,
           TRY_CAST(strftime(ts, '%Y-%m-%d') || ' ' || eta_clock || ':00' AS TIMESTAMP) AS eta_ts,
           TRY_CAST(strftime(ts, '%Y-%m-%d') || ' ' || etd_clock || ':00' AS TIMESTAMP) AS etd_ts
    FROM fmt""".replace("FROM raw_ranges", f"FROM ({_RAW_RANGE_SQL})"))
def q_time_range_parsing(spark, sf_dir):
    """X7 split, X1/X2 strips, C5 end-of-day recode, X6 compact -> clock, X8 lenient parse."""
    df = _raw_ranges(spark, sf_dir)
    eta_raw, etd_raw = split_time_range("raw")
    df = df.withColumns({"eta": clean_clock_text(eta_raw), "etd": clean_clock_text(etd_raw)})
    df = df.withColumn("etd", recode("etd", END_OF_DAY))
    df = df.withColumns({"eta_clock": compact_time("eta"), "etd_clock": compact_time("etd")})
    day = F.date_format("ts", "yyyy-MM-dd")
    return df.select("event_id", "raw", "eta_clock", "etd_clock",
                     lenient_timestamp(join_date_time(day, "eta_clock")).alias("eta_ts"),
                     lenient_timestamp(join_date_time(day, "etd_clock")).alias("etd_ts"))


_PAD_SQL = "CASE WHEN length({x}) < 2 THEN lpad({x}, 2, '0') ELSE {x} END"


@register("date_text_reformat", f"""
    SELECT event_id, mdy,
           string_split(mdy, '/')[3] || '-' || {_PAD_SQL.format(x="string_split(mdy, '/')[1]")}
               || '-' || {_PAD_SQL.format(x="string_split(mdy, '/')[2]")} AS date_iso,
           iso_hour, TRY_CAST(iso_hour AS TIMESTAMP) AS ts_hour,
           {_PAD_SQL.format(x="CAST(event_id % 1000 AS VARCHAR)")} AS padded
    FROM (SELECT event_id, strftime(ts, '%-m/%-d/%Y') AS mdy,
                 CAST(year(ts) AS VARCHAR) || '-' || {_PAD_SQL.format(x="CAST(month(ts) AS VARCHAR)")}
                 || '-' || {_PAD_SQL.format(x="CAST(day(ts) AS VARCHAR)")}
                 || 'T' || {_PAD_SQL.format(x="CAST(hour(ts) AS VARCHAR)")} || ':00' AS iso_hour
          FROM events)""")
def q_date_text_reformat(spark, sf_dir):
    """X12 m/d/yyyy -> yyyy-mm-dd with X3 padding, X13 ISO hour assembly + X8, X5."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    ev = ev.withColumn("mdy", F.date_format("ts", "M/d/yyyy"))
    iso = iso_hour_text(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"))
    return ev.select("event_id", "mdy",
                     reorder_date_text("mdy", "/", (2, 0, 1), pad=True).alias("date_iso"),
                     iso.alias("iso_hour"), lenient_timestamp(iso).alias("ts_hour"),
                     zero_pad((F.col("event_id") % 1000).cast("string")).alias("padded"))


@register("strip_names", """
    SELECT c_custkey, raw, trim(raw) AS trimmed, trim(raw, ' ?') AS stripped
    FROM (SELECT c_custkey,
                 CASE c_mktsegment WHEN 'MACHINERY' THEN c_name || ' ?'
                                   WHEN 'BUILDING' THEN '  ' || c_name || '?'
                                   WHEN 'FURNITURE' THEN c_name || '   '
                                   ELSE c_name END AS raw
          FROM customer)""")
def q_strip_names(spark, sf_dir):
    """X1 white-space strip and X2 character-set strip on decorated names."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    seg, name = F.col("c_mktsegment"), F.col("c_name")
    raw = (F.when(seg == "MACHINERY", F.concat(name, F.lit(" ?")))
           .when(seg == "BUILDING", F.concat(F.lit("  "), name, F.lit("?")))
           .when(seg == "FURNITURE", F.concat(name, F.lit("   ")))
           .otherwise(name))
    c = c.select("c_custkey", raw.alias("raw"))
    return c.select("c_custkey", "raw", strip_whitespace("raw").alias("trimmed"),
                    strip_chars("raw", " ?").alias("stripped"))
