"""Registered operator queries on the supplied tables: corrections, filters, joins,
reshaping and projection (C1-C9, F1-F10, J1, X10/X11, X14-X16, U1, U2, P1-P8, O4, O5).

Each query runs over whole tables.  Where an operator needs nulls, empty strings or a
correction table, they are derived from the data by a fixed rule, in Spark and in the
oracle SQL alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import left, mid
from quayside.functions.time import (is_overnight, lenient_timestamp, roll_overnight,
                                     timestamp_text, zero_minutes)
from quayside.operators import corrections as C
from quayside.operators import filters as FL
from quayside.operators.joins import dealt, outer_merge, task_count
from quayside.operators.reshape import union_all, unpivot_pairs
from quayside.plans import analogue as A
from quayside.plans.analytics import harbour, harbour_updates
from quayside.plans.registry import register
from quayside.sources.tables import read_table


def _orders(spark, sf_dir, *cols):
    return read_table(spark, sf_dir, "orders").select(*cols)


# --------------------------------------------------------------------------- X14-X16, C7

@register("minute_zeroing", """
    SELECT event_id, ts, ts_text,
           CASE WHEN substr(ts_text, 15, 2) <> '00'
                THEN TRY_CAST(left(ts_text, 14) || '00' || substr(ts_text, 17, 12) AS TIMESTAMP)
                ELSE ts END AS corrected,
           ts - to_minutes(CAST(minute(ts) AS BIGINT)) AS zeroed
    FROM (SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events)""")
def q_minute_zeroing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 written as the text update (X14, X15) and as interval arithmetic."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    ev = ev.withColumn("ts_text", timestamp_text("ts"))
    text_fix = lenient_timestamp(F.concat(left("ts_text", 14), F.lit("00"), mid("ts_text", 17, 12)))
    ev = ev.withColumn("corrected", F.col("ts"))
    ev = C.set_where(ev, "corrected", text_fix, mid("ts_text", 15, 2) != F.lit("00"))
    return ev.withColumn("zeroed", zero_minutes("ts"))


# --------------------------------------------------------------------------- X10, X11

@register("overnight_rollover", """
    SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate AS arrival, l.l_shipdate AS departure,
           l.l_shipdate < o.o_orderdate AS overnight,
           CASE WHEN l.l_shipdate < o.o_orderdate THEN l.l_shipdate + INTERVAL 1 DAY
                ELSE l.l_shipdate END AS departure_rolled
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def q_overnight_rollover(spark, sf_dir):
    """Departure before arrival moves to the next day (ship date vs order date)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _orders(spark, sf_dir, "o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", F.col("o_orderdate").alias("arrival"),
                    F.col("l_shipdate").alias("departure"),
                    is_overnight("o_orderdate", "l_shipdate").alias("overnight"),
                    roll_overnight("o_orderdate", "l_shipdate").alias("departure_rolled"))


# --------------------------------------------------------------------------- J1, C8, C9

_MERGE_SIDES = {
    "calls": """
        SELECT o_orderdate AS date, o_orderkey AS boat, NULLIF(o_orderpriority, '5-LOW') AS ETA
        FROM orders WHERE o_orderstatus <> 'F'""",
    "shifts": """
        SELECT o_orderdate AS date, o_orderkey AS boat,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ''
                    WHEN o_orderpriority = '2-HIGH' THEN NULL
                    ELSE lower(o_orderpriority) END AS ETA
        FROM orders WHERE o_orderstatus <> 'O'""",
}


@register("outer_merge_override", A.with_views("""
    SELECT COALESCE(c.date, s.date) AS date, COALESCE(c.boat, s.boat) AS boat,
           c.ETA AS ETA_x, s.ETA AS ETA_y, COALESCE(NULLIF(s.ETA, ''), c.ETA) AS ETA
    FROM calls c FULL OUTER JOIN shifts s ON c.date = s.date AND c.boat = s.boat""",
    ctes=_MERGE_SIDES))
def q_outer_merge_override(spark, sf_dir):
    """Full outer merge on (date, boat) with suffixes; the right time wins when present."""
    o = _orders(spark, sf_dir, "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority")
    calls = o.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("boat"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("ETA"))
    prio = F.col("o_orderpriority")
    shifts = o.where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderdate").alias("date"), F.col("o_orderkey").alias("boat"),
        F.when(prio == "1-URGENT", F.lit("")).when(prio == "2-HIGH", F.lit(None))
        .otherwise(F.lower(prio)).alias("ETA"))
    merged = outer_merge(calls, shifts, ["date", "boat"])
    return merged.withColumn("ETA", C.override_when_present("ETA_x", "ETA_y"))


# --------------------------------------------------------------------------- C1-C4

_GAPPY_SQL = """
    SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS priority,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
    FROM orders"""
_FIXES_SQL = """
    SELECT l_orderkey AS o_orderkey,
           CASE WHEN COUNT(*) >= 4 THEN 'FIX-' || CAST(COUNT(*) AS VARCHAR) END AS priority,
           CASE WHEN COUNT(*) >= 2
                THEN CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) END AS price
    FROM lineitem GROUP BY l_orderkey
    UNION ALL SELECT -p_partkey - 1, 'FIX-' || p_size, p_retailprice FROM part"""


def _gappy_orders(spark, sf_dir):
    """All orders with gaps: no priority for 5-LOW, no price when pending."""
    o = _orders(spark, sf_dir, "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.select(
        "o_orderkey", "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice")).alias("price"))


def _order_fixes(spark, sf_dir):
    """A correction table: one row per order, derived from its line items, and one per part
    under a key that no order has."""
    stray = read_table(spark, sf_dir, "part").select(
        (-F.col("p_partkey") - 1).alias("o_orderkey"),
        F.concat(F.lit("FIX-"), F.col("p_size").cast("string")).alias("priority"),
        F.col("p_retailprice").alias("price"))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    # Orders have few lines: a partial aggregate in the scan's tasks would hold nearly all of them.
    li = dealt(li, ["l_orderkey"], task_count(li))
    agg = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("s"))
    return agg.select(
        "o_orderkey",
        F.when(F.col("n") >= 4, F.concat(F.lit("FIX-"), F.col("n").cast("string"))).alias("priority"),
        F.when(F.col("n") >= 2, F.col("s").cast("double")).alias("price")).unionByName(stray)


def _fix_sql(mode: str) -> str:
    pick = ("COALESCE(g.{c}, f.{c})" if mode == "soft" else "COALESCE(f.{c}, g.{c})")
    return A.with_views(f"""
    SELECT g.o_orderkey, g.o_orderstatus, {pick.format(c='priority')} AS priority,
           {pick.format(c='price')} AS price
    FROM gappy g LEFT JOIN fixes f ON g.o_orderkey = f.o_orderkey""",
                        ctes={"gappy": _GAPPY_SQL, "fixes": _FIXES_SQL})


@register("soft_fix", _fix_sql("soft"))
def q_soft_fix(spark, sf_dir):
    """Fill only missing cells from the keyed correction table."""
    fixed, _ = C.apply_fixes(_gappy_orders(spark, sf_dir), _order_fixes(spark, sf_dir),
                             ["o_orderkey"], ["priority", "price"], "soft")
    return fixed


@register("hard_fix", _fix_sql("hard"))
def q_hard_fix(spark, sf_dir):
    """Overwrite cells from the keyed correction table."""
    fixed, _ = C.apply_fixes(_gappy_orders(spark, sf_dir), _order_fixes(spark, sf_dir),
                             ["o_orderkey"], ["priority", "price"], "hard")
    return fixed


@register("unused_fixes", A.with_views("""
    SELECT f.o_orderkey, f.priority, f.price FROM fixes f
    WHERE NOT EXISTS (SELECT 1 FROM gappy g WHERE g.o_orderkey = f.o_orderkey)""",
                                       ctes={"gappy": _GAPPY_SQL, "fixes": _FIXES_SQL}))
def q_unused_fixes(spark, sf_dir):
    """Corrections whose key matches no row."""
    _, unused = C.apply_fixes(_gappy_orders(spark, sf_dir), _order_fixes(spark, sf_dir),
                              ["o_orderkey"], ["priority", "price"], "soft")
    return unused


@register("exclude_keys", """
    SELECT o_orderkey, o_orderstatus FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l
                      WHERE l.l_returnflag = 'R' AND l.l_orderkey = o.o_orderkey)""")
def q_exclude_keys(spark, sf_dir):
    """Drop listed keys (orders with a returned line)."""
    li = read_table(spark, sf_dir, "lineitem")
    excl = li.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return C.exclude_keys(_orders(spark, sf_dir, "o_orderkey", "o_orderstatus"), excl,
                          ["o_orderkey"])


@register("offset_fix", """
    SELECT o.o_orderkey, o.o_orderdate AS arrival,
           o.o_orderdate + to_days(CAST(COALESCE(f.days, 0) AS INTEGER)) AS departure
    FROM orders o LEFT JOIN (SELECT l_orderkey, CAST(COUNT(*) AS INTEGER) AS days FROM lineitem
                             WHERE l_linestatus = 'F' GROUP BY l_orderkey) f
      ON o.o_orderkey = f.l_orderkey""")
def q_offset_fix(spark, sf_dir):
    """C4: add a keyed number of days (finished lines per order) to a timestamp."""
    li = read_table(spark, sf_dir, "lineitem")
    offsets = (li.where(F.col("l_linestatus") == "F")
               .groupBy(F.col("l_orderkey").alias("o_orderkey"))
               .agg(F.count(F.lit(1)).cast("int").alias("days")))
    o = _orders(spark, sf_dir, "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.col("o_orderdate").alias("arrival"), F.col("o_orderdate").alias("departure"))
    return C.add_days(o, offsets, ["o_orderkey"], ["departure"])


# --------------------------------------------------------------------------- C5, C6

# Fixed values for the recode check: one pass, so "click" ends at "tap", not "press".
EVENT_RECODE = {"view": "page_view", "click": "tap", "tap": "press"}


@register("recode_values", """
    SELECT event_id, event_type,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'tap'
                           WHEN 'tap' THEN 'press' ELSE event_type END AS recoded
    FROM events""")
def q_recode_values(spark, sf_dir):
    """Exact full-value recode in a single pass."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return ev.withColumn("recoded", C.recode("event_type", EVENT_RECODE))


@register("conditional_update", A.with_views("""
    SELECT date_trunc('hour', dt) AS DateTime, boat,
           CASE WHEN agent LIKE '%1' THEN CAST(length(agent) AS INTEGER)
                WHEN boat % 5 = 3 THEN boat * 10 ELSE passengers END AS passengers,
           agent
    FROM presence""", "presence"))
def q_conditional_update(spark, sf_dir):
    """``UPDATE harbour SET passengers = n WHERE ...`` statements applied in order."""
    return C.apply_updates(harbour(spark, sf_dir), harbour_updates())


# --------------------------------------------------------------------------- F1-F4

_HOLES_SQL = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
           NULLIF(o_orderpriority, '5-LOW') AS priority,
           CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN NULL
                ELSE o_orderstatus END AS status
    FROM orders"""


def _orders_with_holes(spark, sf_dir):
    o = _orders(spark, sf_dir, "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                "o_orderstatus")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(st == "P", F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("price"),
        F.nullif(pr, F.lit("5-LOW")).alias("priority"),
        F.when((st == "O") & (pr == "1-URGENT"), F.lit(None)).otherwise(st).alias("status"))


@register("drop_any_null", A.with_views("""
    SELECT * FROM holes
    WHERE price IS NOT NULL AND priority IS NOT NULL AND status IS NOT NULL""",
                                        ctes={"holes": _HOLES_SQL}))
def q_drop_any_null(spark, sf_dir):
    """rows without any null."""
    return FL.drop_nulls(_orders_with_holes(spark, sf_dir))


@register("drop_subset_null", A.with_views("""
    SELECT * FROM holes WHERE price IS NOT NULL AND priority IS NOT NULL""",
                                           ctes={"holes": _HOLES_SQL}))
def q_drop_subset_null(spark, sf_dir):
    """rows without a null in the chosen columns."""
    return FL.drop_nulls(_orders_with_holes(spark, sf_dir), ["price", "priority"])


@register("drop_all_null", A.with_views("""
    SELECT * FROM holes WHERE price IS NOT NULL OR status IS NOT NULL""",
                                        ctes={"holes": _HOLES_SQL}))
def q_drop_all_null(spark, sf_dir):
    """drop rows where every chosen column is null."""
    return FL.drop_all_null(_orders_with_holes(spark, sf_dir), ["price", "status"])


@register("incomplete_rows", A.with_views("""
    SELECT * FROM holes WHERE price IS NULL OR priority IS NULL OR status IS NULL""",
                                          ctes={"holes": _HOLES_SQL}))
def q_incomplete_rows(spark, sf_dir):
    """completeness report - rows still missing a value."""
    return FL.incomplete_rows(_orders_with_holes(spark, sf_dir), ["price", "priority", "status"])


# --------------------------------------------------------------------------- F5-F9, X21

_LINES_SQL = """
    SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no,
           unnest(parts) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""

# Keywords whose lines are dropped (licence notices and e-mail addresses).
LINE_KEYWORDS = ["License", "@"]


def document_lines(spark, sf_dir):
    """Documents as (doc_id, line_no, line); the whole text of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@register("keyword_exclude", A.with_views("""
    SELECT doc_id, line_no, line FROM lines
    WHERE NOT (contains(line, 'License') OR contains(line, '@'))""", ctes={"lines": _LINES_SQL}))
def q_keyword_exclude(spark, sf_dir):
    """Drop lines containing any keyword (case-sensitive, anywhere)."""
    return FL.exclude_keywords(document_lines(spark, sf_dir), "line", LINE_KEYWORDS)


@register("keyword_exclude_table", A.with_views("""
    SELECT doc_id, line_no, line FROM lines
    WHERE NOT EXISTS (SELECT 1 FROM words WHERE contains(line, word))""", ctes={
    "lines": _LINES_SQL, "words": """
        SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark"""}).replace(
            "contains(line, word)", "word <> '' AND contains(line, word)"))
def q_keyword_exclude_table(spark, sf_dir):
    """F6 with a keyword table: every word of every benchmark item."""
    words = read_table(spark, sf_dir, "benchmark").select(
        F.explode(F.split("text", " ")).alias("keyword"))
    return FL.exclude_keywords(document_lines(spark, sf_dir), "line", words)


@register("long_keyword_lines", A.with_views("""
    SELECT line, count(*) AS n_lines FROM lines
    WHERE EXISTS (SELECT 1 FROM words WHERE contains(line, word)) GROUP BY line""", ctes={
    "lines": _LINES_SQL, "words": """
        SELECT DISTINCT c_name || '@' AS word FROM customer UNION
        SELECT DISTINCT lower(p_type) FROM part UNION
        SELECT DISTINCT unnest(string_split(text, '. ')) FROM benchmark"""}).replace(
            "contains(line, word)", "length(word) > 2 AND contains(line, word)"))
def q_long_keyword_lines(spark, sf_dir):
    """F6's hits of long keywords (names, part types, sentences), most of which no line has."""
    def column(table, c):
        return read_table(spark, sf_dir, table).select(c.alias("keyword"))

    words = (column("customer", F.concat("c_name", F.lit("@")))
             .union(column("part", F.lower("p_type")))
             .union(column("benchmark", F.explode(F.split("text", "\\. "))))
             .where(F.length("keyword") > 2))
    lines = document_lines(spark, sf_dir)
    return (lines.join(FL.keyword_hits(lines, "line", words), "line", "left_semi")
            .groupBy("line").agg(F.count("*").alias("n_lines")))


@register("recode_table", """
    SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS boat
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_nationkey < 20""")
def q_recode_table(spark, sf_dir):
    """C5 with a table of pairs: customer keys become names where the table has them."""
    pairs = read_table(spark, sf_dir, "customer").where("c_nationkey < 20").select(
        F.col("c_custkey").cast("string").alias("from_value"), F.col("c_name").alias("to_value"))
    o = _orders(spark, sf_dir, "o_orderkey", "o_custkey").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("boat"))
    return C.recode_column(o, "boat", pairs)


@register("blank_filter", A.with_views("""
    SELECT doc_id, line_no, line FROM lines WHERE line <> ''""", ctes={"lines": _LINES_SQL}))
def q_blank_filter(spark, sf_dir):
    """drop blank records."""
    return FL.drop_blank_records(document_lines(spark, sf_dir), "line", "")


@register("regex_keep", r"""
    SELECT page_id, url FROM pages
    WHERE regexp_full_match(url, 'https://[a-z.]+/[a-z]{2}/\d+')""")
def q_regex_keep(spark, sf_dir):
    """keep values fully matching a pattern."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.where(FL.regex_full_match("url", r"https://[a-z.]+/[a-z]{2}/\d+"))


@register("any_cell_contains", """
    SELECT page_id, url FROM pages
    WHERE contains(url, '?page=') OR contains(html, '?page=')""")
def q_any_cell_contains(spark, sf_dir):
    """F8: rows where any of several columns contains a marker."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.where(FL.any_cell_contains(["url", "html"], "?page=")).select("page_id", "url")


@register("label_filter", """
    SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de')""")
def q_label_filter(spark, sf_dir):
    """keep rows whose label is one of a set."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return d.where(FL.label_in("lang", ["en", "de"]))


# --------------------------------------------------------------------------- U1, U2

@register("unpivot_pairs", """
    SELECT o_orderdate AS Date, CAST(o_orderkey AS VARCHAR) AS Boat, o_orderpriority AS Time
    FROM orders
    UNION ALL
    SELECT o_orderdate, CAST(o_custkey AS VARCHAR), NULLIF(o_orderstatus, 'P') FROM orders
    WHERE NULLIF(o_orderstatus, 'P') IS NOT NULL""")
def q_unpivot_pairs(spark, sf_dir):
    """U2 + F2: (Boat1, Time1), (Boat2, Time2) -> (Boat, Time), incomplete pairs dropped."""
    o = _orders(spark, sf_dir, "o_orderdate", "o_orderkey", "o_custkey", "o_orderpriority",
                "o_orderstatus")
    wide = o.select(F.col("o_orderdate").alias("Date"),
                    F.col("o_orderkey").cast("string").alias("Boat1"),
                    F.col("o_orderpriority").alias("Time1"),
                    F.col("o_custkey").cast("string").alias("Boat2"),
                    F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("Time2"))
    long = unpivot_pairs(wide, ["Date"], [("Boat1", "Time1"), ("Boat2", "Time2")],
                         ("Boat", "Time"))
    return FL.drop_nulls(long, ["Boat", "Time"])


@register("union_all", A.with_views("""
    SELECT 'orders' AS source, dt AS date, boat, passengers FROM presence
    UNION ALL
    SELECT 'events', CAST(d AS TIMESTAMP), CAST(boat AS INTEGER), passengers FROM stays""",
                                    "presence", "stays"))
def q_union_all(spark, sf_dir):
    """Visits from two sources stacked, duplicates kept."""
    p = A.presence(spark, sf_dir).select(F.lit("orders").alias("source"),
                                         F.col("dt").alias("date"), "boat", "passengers")
    s = A.stays(spark, sf_dir).select(F.lit("events").alias("source"),
                                      F.col("d").cast("timestamp_ntz").alias("date"),
                                      F.col("boat").cast("int").alias("boat"), "passengers")
    return union_all(p, s)


# --------------------------------------------------------------------------- P1-P8, O4, O5

@register("project_rename", """
    SELECT '2023' AS Year, o_orderkey AS id, o_custkey AS boat, o_orderdate AS arrival,
           o_orderdate AS departure, o_totalprice AS amount,
           CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * 1.25, 2) AS DOUBLE) AS amount_with_vat
    FROM orders""")
def q_project_rename(spark, sf_dir):
    """Select, rename, add a constant first column, copy, compute, cast, drop."""
    o = read_table(spark, sf_dir, "orders")
    o = o.withColumnsRenamed({"o_orderkey": "id", "o_custkey": "boat", "o_totalprice": "amount",
                              "o_orderdate": "arrival"})
    o = o.withColumn("departure", F.col("arrival"))
    o = o.withColumn("amount_with_vat", F.round(
        F.col("amount").cast("decimal(18,2)") * F.lit(1.25).cast("decimal(3,2)"), 2).cast("double"))
    o = o.drop("o_orderstatus", "o_orderpriority")
    return o.select(F.lit(2023).cast("string").alias("Year"), "id", "boat", "arrival",
                    "departure", "amount", "amount_with_vat")


@register("first_rows", """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 20""")
def q_first_rows(spark, sf_dir):
    """O4 + O5: sort by date then key (a total order) and preview the first 20 rows."""
    o = _orders(spark, sf_dir, "o_orderkey", "o_orderdate", "o_totalprice")
    return o.orderBy("o_orderdate", "o_orderkey").limit(20)
