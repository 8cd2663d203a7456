"""Registered end-to-end checks of the cleaning pipelines (Q8-Q12).

Each check writes raw exports derived from the supplied tables to a fresh folder under the
shared checkpoint folder, in the raw formats the pipelines read (a cruise-call CSV and a
roster grid, a Windows-1252 weather export, a sales CSV with subtotal rows), runs the
pipeline on them and returns its output.  The oracle SQL computes the same rows from the
source tables directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans import analogue as A
from quayside.plans import cleaning, inputs
from quayside.plans import roster as R
from quayside.plans.registry import register
from quayside.session import shared_scratch
from quayside.sources import files as SF
from quayside.sources.tables import read_table

# --------------------------------------------------------------------------- Q8

# A visit is a visitor's stay of a day; every seventh visitor who is there the next day too
# leaves then.  The exports carry the faults that the corrections are for, by the visitor's
# number; the SQL states what must come out.
_VISITS_SQL = """
    SELECT a.boat AS uid, a.d, a.arrival, a.passengers, hour(a.arrival) < 12 AS in_roster,
           a.boat % 7 = 0 AND b.arrival IS NOT NULL AS next_day,
           CASE WHEN a.boat % 7 = 0 AND b.arrival IS NOT NULL THEN b.arrival
                ELSE a.departure END AS departure,
           a.passengers = 1 OR a.boat % 17 = 5 AS no_call,
           a.boat % 19 = 7 AND a.boat % 11 <> 1 AS no_etd
    FROM stays a LEFT JOIN stays b ON b.boat = a.boat AND b.d = a.d + 1"""


def _visits_sql(sql: str) -> str:
    return A.with_views(sql, "stays", ctes={"visits": _VISITS_SQL})


_CALL_NUMBERS_SQL = "uid * 100 + 0.25::DOUBLE AS {}, uid + 0.5::DOUBLE AS {}"

_PRESENCE_SQL = _visits_sql(f"""
    SELECT unnest(generate_series(eta, etd, INTERVAL 1 HOUR)) AS hourly_timestamp,
           'Guest ' || uid AS boat, CAST(passengers AS BIGINT) AS passengers,
           'Quay ' || uid % 3 AS quay, 'Agent ' || uid % 5 AS agent,
           {_CALL_NUMBERS_SQL.format("weight", "lenght")}
    FROM (SELECT uid, passengers,
                 CASE WHEN in_roster THEN date_trunc('hour', arrival) ELSE arrival END AS eta,
                 CASE WHEN in_roster AND hour(departure) = 23
                           THEN date_trunc('hour', departure) + INTERVAL 59 MINUTE
                      WHEN in_roster THEN date_trunc('hour', departure) + INTERVAL 1 HOUR
                      ELSE departure END AS etd
          FROM visits WHERE NOT no_call AND (in_roster OR NOT no_etd))""")


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with their clock texts as the exports show them (see ``_VISITS_SQL``), written
    once: the exports and every table of corrections are made from them."""
    stays = A.stays(spark, sf_dir)
    following = stays.select("boat", F.date_sub("d", 1).alias("d"), F.col("arrival").alias("later"))
    v = stays.join(following, ["boat", "d"], "left").withColumnRenamed("boat", "uid")
    v = v.withColumn("next_day", (F.col("uid") % 7 == 0) & F.col("later").isNotNull())
    v = v.withColumn("departure", F.when(F.col("next_day"), F.col("later"))
                     .otherwise(F.col("departure"))).drop("later")
    hour = F.hour("departure") + 1
    v = v.withColumns({
        "in_roster": F.hour("arrival") < 12,
        "call_eta": F.date_format("arrival", "HH:mm"),
        "call_etd": F.date_format("departure", "HH:mm"),
        "roster_eta": F.format_string("%02d00", F.hour("arrival")),
        "roster_etd": F.format_string("%02d00", hour),
        "name": F.concat(F.lit("Guest "), F.col("uid").cast("string")),
        "raw_name": F.concat(F.when(F.col("uid") % 6 == 5, F.lit("GUEST "))
                             .otherwise(F.lit("Guest ")), F.col("uid").cast("string")),
        "raw_date": F.date_format("d", "dd.MM.yyyy"),
        "date": F.date_format("d", "yyyy-MM-dd")})
    folder = shared_scratch(spark, "visit-rows")
    v.write.parquet(folder)
    return spark.read.schema(v.schema).parquet(folder)


def _unless(condition, c):
    return F.when(~condition, c)


def _visit_exports(spark: SparkSession, visits: DataFrame, sf_dir: str, base: str,
                   roster: bool = True) -> None:
    """Write the calls CSV (``base``/calls) and the roster (``base``/roster) of the visits.

    Calls have more columns than are used, in an order of their own; some lack times or
    passengers, some passenger counts are no numbers, and some names are in capitals.  The
    roster lists the visits that arrive before noon with times widened to whole hours (a
    closing hour of 24 is written ``2400``), stray ``" ?"`` after names, times in words, wrong
    times, and entries listed twice under another name.
    """
    uid = F.col("uid")
    count = F.col("passengers").cast("string")
    passengers = (F.when(uid % 17 == 5, F.concat(F.lit("about "), count))
                  .when(uid % 11 == 3, F.lit(None))
                  .when(uid % 17 == 6, F.concat(count, F.lit(".0"))).otherwise(count))
    calls = visits.select(
        uid.alias("Nr"), F.concat(F.lit("Quay "), (uid % 3).cast("string")).alias("Kai"),
        F.col("raw_name").alias("Navn"), passengers.alias("Passasjerer"),
        _unless(uid % 11 == 1, F.col("call_eta")).alias("ETA"),
        _unless((uid % 11 == 1) | (uid % 19 == 7), F.col("call_etd")).alias("ETD"),
        F.col("raw_date").alias("Dato"),
        F.concat(F.lit("Agent "), (uid % 5).cast("string")).alias("Agent"),
        F.concat((uid * 100).cast("string"), F.lit(",25")).alias("Tonn"),
        F.lit("x").alias("Merknad"), F.concat(uid.cast("string"), F.lit(".5")).alias("Lengde"))
    SF.write_csv(calls, f"{base}/calls")
    if not roster:
        return
    d = F.col("d")
    week = F.date_sub(F.next_day(d, "Mon"), 7)
    time = (F.when(uid % 13 == 2, F.lit("0000 - 0100"))
            .when(uid % 10 == 3, _time_words())
            .otherwise(F.concat_ws(" - ", "roster_eta", "roster_etd")))
    shown = F.when(uid % 4 == 0, F.concat("raw_name", F.lit(" ?"))).otherwise(F.col("raw_name"))
    slots = visits.where("in_roster").select(
        week.alias("week"), F.floor(uid / 3).alias("kb"), (uid % 3).cast("int").alias("pair"),
        F.datediff(d, week).alias("dow"), shown.alias("boat"), time.alias("time"), "uid")
    twice = slots.where(uid % 9 == 4).withColumns({
        "kb": F.col("kb") + (1 << 40), "boat": F.concat(F.lit("Copy of "), "boat")})
    R.write_roster(spark, slots.unionByName(twice).drop("uid"), f"{base}/roster",
                   SF.export_file_count(read_table(spark, sf_dir, "events")))


def _time_words():
    return F.concat(F.lit("from "), "roster_eta", F.lit(" to "), "roster_etd")


def _visit_corrections(visits: DataFrame) -> cleaning.Corrections:
    """The correction tables that put the exports right, with some that match nothing."""
    uid = F.col("uid")
    none = F.lit(None).cast("string")
    ghost = F.concat(F.lit("Ghost "), uid.cast("string"))

    def call_fix(rows, boat, eta=none, etd=none, passengers=none):
        return rows.select(F.col("raw_date").alias("date"), boat.alias("boat"), eta.alias("ETA"),
                           etd.alias("ETD"), passengers.alias("passengers"))

    raw = F.col("raw_name")
    call_fixes = (
        call_fix(visits.where(uid % 11 == 1), raw, eta=F.col("call_eta"))
        .unionByName(call_fix(visits.where(uid % 11 == 1), raw, etd=F.col("call_etd")))
        .unionByName(call_fix(visits.where(uid % 11 == 3), raw,
                              passengers=F.col("passengers").cast("string")))
        .unionByName(call_fix(visits.where(uid % 11 == 2), ghost, eta=F.lit("00:00"))))
    closing = F.when(F.col("roster_etd") == "2400", F.lit("2359")).otherwise(F.col("roster_etd"))
    roster_fixes = visits.where(uid % 13 == 2).select(
        "date", F.col("name").alias("boat"), F.col("roster_eta").alias("ETA"), closing.alias("ETD")
    ).unionByName(visits.where(uid % 13 == 3).select(
        "date", ghost.alias("boat"), F.lit("0000").alias("ETA"), F.lit("0100").alias("ETD")))
    # The next-day rule moves a departure only when its clock is before the arrival's.
    later = F.when(F.col("in_roster"), F.col("roster_etd") >= F.col("roster_eta")).otherwise(
        F.col("call_etd") >= F.col("call_eta"))
    listed = F.when(uid % 4 == 0, F.concat("raw_name", F.lit(" ?"))).otherwise(F.col("raw_name"))
    return cleaning.Corrections(
        call_fixes=call_fixes,
        call_exclusions=visits.where("passengers = 1").select(
            F.col("raw_date").alias("date"), raw.alias("boat")),
        roster_exclusions=visits.where(uid % 9 == 4).select(
            F.date_format("d", "M/d/yyyy").alias("Date"),
            F.concat(F.lit("Copy of "), listed).alias("Boat")),
        roster_fixes=roster_fixes,
        stay_offsets=visits.where(F.col("next_day") & later).select(
            "date", F.col("name").alias("boat"), F.lit(1).alias("days")),
        boat_names=visits.where(uid % 6 == 5).select(
            raw.alias("from_value"), F.col("name").alias("to_value")),
        time_texts=visits.where(uid % 10 == 3).select(
            _time_words().alias("from_value"),
            F.concat_ws(" - ", "roster_eta", "roster_etd").alias("to_value")))


def _presence(spark: SparkSession, sf_dir: str):
    base = shared_scratch(spark, "visits")
    visits = _visits(spark, sf_dir)
    _visit_exports(spark, visits, sf_dir, base)
    raw_calls = SF.read_csv(spark, f"{base}/calls", cleaning.CALL_COLUMNS)
    roster_calls, _ = R.read_roster(spark, f"{base}/roster")
    return cleaning.presence_build(raw_calls, roster_calls, _visit_corrections(visits))


@register("presence_build", _PRESENCE_SQL)
def q_presence_build(spark, sf_dir):
    """Q8 end to end: calls CSV + roster grid + corrections -> hourly presence rows."""
    return _presence(spark, sf_dir)[0]


@register("presence_rejects", _visits_sql("""
    SELECT strftime(d, '%Y-%m-%d') AS date, 'Guest ' || uid AS boat FROM visits
    WHERE (in_roster AND no_call) OR (NOT in_roster AND NOT no_call AND no_etd)"""))
def q_presence_rejects(spark, sf_dir):
    """Q8: roster entries without a call and calls without a departure time."""
    return _presence(spark, sf_dir)[1]["rejects"].select("date", "boat")


@register("presence_unused_fixes", _visits_sql("""
    SELECT 'call' AS kind, strftime(d, '%d.%m.%Y') AS date, 'Ghost ' || uid AS boat FROM visits
    WHERE uid % 11 = 2
    UNION ALL
    SELECT 'roster', strftime(d, '%Y-%m-%d'),
           CASE WHEN uid % 13 = 3 THEN 'Ghost ' ELSE 'Guest ' END || uid FROM visits
    WHERE uid % 13 = 3 OR (uid % 13 = 2 AND NOT in_roster)"""))
def q_presence_unused_fixes(spark, sf_dir):
    """Q8: the corrections that met no row, of calls and of the roster."""
    _, reports = _presence(spark, sf_dir)
    return reports["unused_call_fixes"].select(F.lit("call").alias("kind"), "date", "boat") \
        .unionByName(reports["unused_roster_fixes"].select(
            F.lit("roster").alias("kind"), "date", "boat"))


_RAW_NAME_SQL = "CASE WHEN uid % 6 = 5 THEN 'GUEST ' ELSE 'Guest ' END || uid"


@register("call_reports", _visits_sql(f"""
    SELECT 'incomplete' AS report, strftime(d, '%d.%m.%Y') AS date, {_RAW_NAME_SQL} AS boat
    FROM visits WHERE no_etd
    UNION ALL
    SELECT 'unparsed', strftime(d, '%d.%m.%Y'), 'Guest ' || uid FROM visits
    WHERE uid % 17 = 5 AND passengers <> 1"""))
def q_call_reports(spark, sf_dir):
    """F4 and typing: calls still incomplete after the fixes, and those with no number."""
    base = shared_scratch(spark, "calls")
    visits = _visits(spark, sf_dir)
    _visit_exports(spark, visits, sf_dir, base, roster=False)
    raw = SF.read_csv(spark, f"{base}/calls", cleaning.CALL_COLUMNS)
    _, reports = cleaning.clean_calls(raw, _visit_corrections(visits))
    return reports["incomplete"].select(F.lit("incomplete").alias("report"), "date", "boat") \
        .unionByName(reports["unparsed"].select(F.lit("unparsed").alias("report"), "date", "boat"))


# --------------------------------------------------------------------------- Q10

# The weather export's preamble and header.
WEATHER_PREAMBLE = ["latitude,longitude,elevation", "69.65,18.96,10.0", ""]
WEATHER_HEADER = "time,temperature (°C),note"


@register("weather_records", """
    SELECT date_trunc('minute', ts) AS time, value AS temperature,
           event_type || ' målt' AS note, event_id
    FROM events""")
def q_weather_records(spark, sf_dir):
    """Q10 end to end: a Windows-1252 export with a preamble per file -> typed rows.

    The preamble is skipped by position; a file spans as many tasks as it has splits.
    """
    base = shared_scratch(spark, "weather")
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    files = SF.export_file_count(ev)
    data = ev.select(
        F.pmod(F.col("event_id"), F.lit(files)).cast("int").alias("part"),
        F.lit(1).alias("section"), F.col("event_id").alias("seq"),
        F.concat_ws(",", F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.col("value").cast("string"),
                    F.concat(F.col("event_type"), F.lit(" målt")),
                    F.col("event_id").cast("string")).alias("record"))
    head = [*WEATHER_PREAMBLE, WEATHER_HEADER + ",id"]
    heads = spark.range(files).select(
        F.col("id").cast("int").alias("part"), F.lit(0).alias("section"),
        F.posexplode(F.array(*[F.lit(h) for h in head])).alias("seq", "record"))
    heads = heads.select("part", "section", F.col("seq").cast("bigint").alias("seq"), "record")
    SF.write_ordered_export(data.unionByName(heads), base, "part", ["section", "seq"],
                            encoding="windows-1252")
    recs = SF.read_records(spark, base, "windows-1252")
    rows = cleaning.clean_weather(recs, ["time", "temperature", "note", "id"],
                                  preamble=len(WEATHER_PREAMBLE))
    return rows.select("time", F.col("temperature").try_cast("double").alias("temperature"),
                       "note", F.col("id").try_cast("bigint").alias("event_id"))


# --------------------------------------------------------------------------- Q9

_SALES_ROWS_SQL = """
    SELECT make_timestamp(year(l_shipdate), month(l_shipdate), day(l_shipdate),
                          l_linenumber, 0, 0) AS Datetime,
           l_returnflag || l_linestatus AS "Product group", CAST(l_quantity AS BIGINT) AS units,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_orderkey % 50 AS kind
    FROM lineitem"""


@register("sales_cleaning", f"""
    SELECT Datetime, "Product group", units AS "Units sold",
           CAST(amount AS DOUBLE) AS "Amount with VAT"
    FROM ({_SALES_ROWS_SQL}) WHERE kind NOT IN (3, 4)""")
def q_sales_cleaning(spark, sf_dir):
    """Q9 end to end: a sales CSV per year, with monthly subtotal rows -> typed sales."""
    clean, _ = _cleaned_sales(spark, sf_dir)
    return clean.withColumn("Amount with VAT", F.col("Amount with VAT").cast("double"))


@register("sales_rejects", f"""
    SELECT Datetime, "Product group",
           CASE kind WHEN 3 THEN units || ' pcs' ELSE CAST(units AS VARCHAR) END AS "Units sold",
           CASE kind WHEN 4 THEN 'n/a' ELSE CAST(amount AS VARCHAR) END AS "Amount with VAT"
    FROM ({_SALES_ROWS_SQL}) WHERE kind IN (3, 4)""")
def q_sales_rejects(spark, sf_dir):
    """Q9: the rows whose units or amount are no numbers, as they were read."""
    return _cleaned_sales(spark, sf_dir)[1]


def _cleaned_sales(spark, sf_dir):
    """Sales exported as people write them (``12.0`` pieces, ``1 234,50``; some no numbers)."""
    base = shared_scratch(spark, "sales")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity",
        "l_extendedprice")
    kind = F.col("l_orderkey") % 50
    units = F.col("l_quantity").cast("bigint").cast("string")
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    rows = li.select(
        F.year("l_shipdate").alias("Year"), F.lit("x").alias("Kasse"),
        F.month("l_shipdate").cast("string").alias("Måned"),
        F.when(kind == 1, F.concat(units, F.lit(".0"))).when(kind == 3, F.concat(units, F.lit(" pcs")))
        .otherwise(units).alias("Antall"),
        F.dayofmonth("l_shipdate").cast("string").alias("Dag"),
        F.col("l_linenumber").cast("string").alias("Time"),
        F.concat("l_returnflag", "l_linestatus").alias("Varegruppe"),
        F.when(kind == 2, F.translate(amount, ".", ","))
        .when(kind == 4, F.lit("n/a")).otherwise(amount).alias("Belåp m/mva"))
    subtotals = rows.groupBy("Year", "Måned").agg(F.count("*").cast("string").alias("Antall"))
    subtotals = subtotals.select(
        "Year", F.lit(None).cast("string").alias("Kasse"), "Måned", "Antall",
        *[F.lit(None).cast("string").alias(c) for c in ("Dag", "Time")],
        F.lit("Sum").alias("Varegruppe"), F.lit("0").alias("Belåp m/mva"))
    export = rows.unionByName(subtotals)
    export.write.mode("overwrite").partitionBy("Year").option("header", True).csv(base)
    raw = SF.read_csv(spark, base, [*cleaning.SALES_RENAMES, "Year"])
    return cleaning.clean_sales(raw, year=F.col("Year"))


# --------------------------------------------------------------------------- Q11, Q12

@register("dictionary_cleaning", """
    SELECT CAST(p_partkey AS VARCHAR) AS product, p_type AS EN, p_brand AS brand
    FROM part WHERE p_size > 5""")
def q_dictionary_cleaning(spark, sf_dir):
    """Q11 end to end: a dictionary CSV with gaps (no English name for the smallest part
    sizes) -> complete rows with an id; the id is checked in the tests."""
    base = shared_scratch(spark, "dictionary")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    export = part.select(F.col("p_partkey").cast("string").alias("product"),
                         F.when(F.col("p_size") > 5, F.col("p_type")).alias("EN"),
                         F.col("p_brand").alias("brand"))
    SF.write_csv(export.select(F.lit(None).cast("string").alias("note"), "brand", "EN", "product"),
                 base)
    raw = SF.read_csv(spark, base, ["product", "EN", "brand"])
    return cleaning.clean_dictionary(raw).drop("ID")


@register("cruise_calls_cleaning", _visits_sql(f"""
    SELECT CAST(d AS TIMESTAMP) AS "Date of arrival",
           CAST(d AS TIMESTAMP) + CASE WHEN etd < eta THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
               AS "Date of departure",
           eta AS ETA, etd AS ETD, 'Guest ' || uid AS Navn, CAST(passengers AS BIGINT) AS Passasjerer,
           'Quay ' || uid % 3 AS Kai, 'Agent ' || uid % 5 AS Agent,
           {_CALL_NUMBERS_SQL.format("Tonn", "Lengde")}
    FROM (SELECT *, strftime(arrival, '%H:%M') AS eta,
                 CASE WHEN NOT no_etd THEN strftime(departure, '%H:%M') END AS etd
          FROM visits WHERE NOT no_call)"""))
def q_cruise_calls_cleaning(spark, sf_dir):
    """Q12 end to end: the calls CSV of the visits and its corrections -> typed calls."""
    base = shared_scratch(spark, "calls")
    visits = _visits(spark, sf_dir)
    _visit_exports(spark, visits, sf_dir, base, roster=False)
    raw = SF.read_csv(spark, f"{base}/calls", cleaning.CALL_COLUMNS)
    calls, _ = cleaning.clean_cruise_calls(raw, _visit_corrections(visits))
    return calls


# --------------------------------------------------------------------------- inputs of the analytics

@register("stable_ids", """
    SELECT k - 1 AS ID, p_type AS EN, CAST(p_partkey AS VARCHAR) AS product
    FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS k FROM part) WHERE p_size > 5""")
def q_stable_ids(spark, sf_dir):
    """K3 as the export counts: each row's number in a dictionary of several files, with gaps where
    rows were dropped; it does not depend on the tasks that read them."""
    base = shared_scratch(spark, "numbered")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    export = part.repartitionByRange(5, "p_partkey").sortWithinPartitions("p_partkey").select(
        F.when(F.col("p_size") > 5, F.col("p_type")).alias("EN"),
        F.col("p_partkey").cast("string").alias("product"))
    SF.write_csv(export, base)
    return cleaning.clean_dictionary(SF.read_csv(spark, base, ["EN", "product"], position="ID"))


@register("analytics_rejects", """
    SELECT 'sales' AS input, CAST(l_partkey AS VARCHAR) AS name,
           CASE l_orderkey % 40 WHEN 3 THEN 'some' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
               END AS amount
    FROM lineitem WHERE l_orderkey % 40 IN (3, 4, 5)
    UNION ALL
    SELECT 'harbour', CAST(o_custkey AS VARCHAR), 'about ' || o_orderkey FROM orders
    WHERE o_orderkey % 30 = 2 AND o_custkey % 7 <> 1""")
def q_analytics_rejects(spark, sf_dir):
    """Exports of harbour and sales with texts that are no times or numbers: what the analytics
    leave out, after the passenger fixes."""
    base = shared_scratch(spark, "inputs")
    kind = F.col("l_orderkey") % 40
    SF.write_csv(read_table(spark, sf_dir, "lineitem").select(
        F.when(kind == 5, F.lit("soon")).otherwise(F.col("l_shipdate").cast("string"))
        .alias("Datetime"), F.col("l_partkey").alias("Product group"),
        F.when(kind == 3, F.lit("some")).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("Units sold"),
        F.when(kind == 4, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
        .alias("Amount with VAT")), f"{base}/sales")
    key = F.col("o_orderkey").cast("string")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    SF.write_csv(orders.select(
        F.col("o_orderdate").alias("hourly_timestamp"), F.col("o_custkey").alias("boat"),
        F.when(F.col("o_orderkey") % 30 == 2, F.concat(F.lit("about "), key)).otherwise(key)
        .alias("passengers"), F.lit("x").alias("agent")), f"{base}/harbour")
    fixes = orders.where("o_custkey % 7 = 1").select(
        F.col("o_custkey").cast("string").alias("boat"), F.lit("12").alias("passengers"))
    _, bad_sales = inputs.typed_sales(SF.read_csv(spark, f"{base}/sales"))
    _, bad_harbour = inputs.typed_harbour(SF.read_csv(spark, f"{base}/harbour"), fixes)
    return bad_sales.select(F.lit("sales").alias("input"), F.col("product").alias("name"),
                            F.col("units").alias("amount")).union(
        bad_harbour.select(F.lit("harbour"), "boat", "passengers"))
