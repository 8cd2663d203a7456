"""The weekly roster grid: parsing (S4, S6, F5, F7, F9, C10, R1, C8, F3, U2, F2) and a
derived roster export for the registered check.

A roster file holds weekly blocks.  A block starts with a header record whose second
cell is a date (``m/d/yyyy``); each further record of the block is one slot (ship, time,
ship, time, ...) and each cell position is one day.  Records of other people (staff
rows) carry a label in cell 0 and are dropped; blank records are dropped.  The first
record of a file is a title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import empty_to_null
from quayside.functions.time import reorder_date_text
from quayside.operators import filters as FL
from quayside.operators.reshape import mark_headers, regrid_blocks, unpivot_pairs
from quayside.operators.windows import position_bucket, running_sums
from quayside.sources import files as SF
from quayside.plans.registry import register
from quayside.session import shared_scratch
from quayside.sources.tables import read_table

# Fixed values of the roster layout.
DATE_PATTERN = r"^\d{1,2}\/\d{1,2}\/\d{4}$"
BLANK_RECORD = ",,,,,,,"
SHIP_LABELS = ["", "*"]
SLOT_NAMES = ["Date", "Boat1", "Time1", "Boat2", "Time2", "Boat3", "Time3"]
PAIRS = [("Boat1", "Time1"), ("Boat2", "Time2"), ("Boat3", "Time3")]
# Days of a block with none of these filled are dropped (the label column of each block
# and days without a second ship slot filled in).
DAY_PRESENT = ["Time1", "Boat2", "Time2", "Boat3"]


def roster_grid(records: DataFrame, slot_names=SLOT_NAMES,
                staff_names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Ordered roster records -> (grid, rejects).

    ``records`` has ``file, pos, record`` (see :func:`read_records`).  The grid
    has ``file, block, cell`` and one column per slot (empty cells are null); rejects are
    ship records before the first block header of a file and those beyond the slots.  With ``staff_names``,
    records mentioning any of them anywhere are dropped first (F6), as an alternative to
    the label rule for rosters whose staff rows carry no label.
    """
    recs = FL.drop_blank_records(records, "record", BLANK_RECORD)
    if staff_names:
        recs = FL.exclude_keywords(recs, "record", staff_names)
    recs = recs.withColumn("cells", SF.split_cells("record"))
    recs = recs.withColumn("is_header", F.coalesce(mark_headers("cells", 1, DATE_PATTERN),
                                                   F.lit(False)))
    label = F.when(F.col("is_header"), F.lit("*")).otherwise(F.get(F.col("cells"), 0))
    listed = F.coalesce(FL.label_in(label, SHIP_LABELS), F.lit(False))
    # Staff records are no slots, but the first record, of whatever label, is the title.
    recs = recs.withColumn("is_listed", listed).withColumn(
        "cells", F.when(F.col("is_listed"), F.col("cells"))).drop("record")
    return regrid_blocks(recs, "file", "pos", "cells", "is_header", list(slot_names),
                         drop_empty=True, keep_col="is_listed", title=True)


def roster_calls(grid: DataFrame) -> DataFrame:
    """Grid -> (Date, Boat, Time): empty cells to null, empty days dropped, pairs stacked."""
    cols = [c for c in SLOT_NAMES]
    g = grid.select(*[empty_to_null(c).alias(c) for c in cols])
    g = FL.drop_all_null(g, DAY_PRESENT)
    long = unpivot_pairs(g, ["Date"], PAIRS, ("Boat", "Time"))
    return FL.drop_nulls(long, ["Boat", "Time"])


def read_roster(spark: SparkSession, path: str, encoding: str = "UTF-8",
                staff_names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Roster files under ``path`` -> (Date, Boat, Time) rows, and the rejected records."""
    grid, rejects = roster_grid(SF.read_records(spark, path, encoding), staff_names=staff_names)
    return roster_calls(grid), rejects


# --------------------------------------------------------------------------- derived export

def _order_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one roster slot: week block, pair, weekday, ship text, time text.

    Orders are ranked within their day by key (a running count per day, computed in
    key buckets so a busy day still spreads over tasks); rank r goes to block r / 3 of
    the week and to ship pair r % 3, which packs three ships per day into each block.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    o = o.withColumns({"day": d, "__one": F.lit(1)})
    ranked = running_sums(o, "o_orderkey", {"rank": "__one"}, partition_cols=("day",),
                          bucket=position_bucket("o_orderkey", 1 << 20))
    week = F.date_sub(F.next_day("day", "Mon"), 7)
    hour = F.col("o_orderkey") % 12 + 6
    r = F.col("rank") - 1
    return ranked.select(
        week.alias("week"),
        F.floor(r / 3).alias("kb"),
        (r % 3).cast("int").alias("pair"),
        F.datediff("day", week).alias("dow"),
        F.concat(F.lit("Ship "), F.col("o_custkey").cast("string")).alias("boat"),
        F.format_string("%02d00 - %02d00", hour, hour + 6).alias("time"))


def write_roster(spark: SparkSession, slots: DataFrame, out_dir: str,
                 files: int | None = None) -> None:
    """Write roster slots as a roster export (weekly blocks of up to three ships a day).

    ``slots`` has ``week`` (Monday), ``kb`` (block key within the week), ``pair`` (0-2),
    ``dow`` (0-6), ``boat`` and ``time``; (week, kb, pair, dow) must be unique.  A block
    is a header, six slot records, a staff record and a blank record.  Blocks are spread
    over ``files`` files by week and block, each file opening with a title record and holding
    whole blocks in order.  Size ``files`` from the base table the slots come from
    (:func:`quayside.sources.files.export_file_count` on its scan); default 4.
    """
    files = files or 4
    slots = slots.withColumn(
        "cell", F.concat(F.col("pair").cast("string"), F.lit("_"), F.col("dow").cast("string")))
    # At most 21 cells per block: a small map keeps the aggregation hash-based.
    blocks = slots.groupBy("week", "kb").agg(F.map_from_entries(F.collect_list(
        F.struct("cell", F.struct("boat", "time")))).alias("m"))

    def cell(pair: int, dow: int, field: str):
        return F.coalesce(F.try_element_at("m", F.lit(f"{pair}_{dow}"))[field], F.lit(""))

    header = F.concat_ws(",", F.lit("week"),
                         *[F.date_format(F.date_add("week", k), "M/d/yyyy") for k in range(7)])
    lines = [header]
    for pair in range(3):
        for field in ("boat", "time"):
            lines.append(F.concat_ws(",", F.lit(""), *[cell(pair, k, field) for k in range(7)]))
    lines.append(F.lit("Staff," + ",".join(["8-16"] * 7)))
    lines.append(F.lit(BLANK_RECORD))
    recs = blocks.select("week", F.col("kb").cast("bigint").alias("kb"),
                         F.posexplode(F.array(*lines)).alias("line", "record"))
    recs = recs.withColumn("part", F.pmod(F.hash("week", "kb"), F.lit(files)))
    titles = spark.range(files).select(
        F.lit(None).cast("date").alias("week"), F.lit(-1).cast("bigint").alias("kb"),
        F.lit(-1).alias("line"), F.lit("Roster" + "," * 7).alias("record"),
        F.col("id").cast("int").alias("part"))
    SF.write_ordered_export(recs.unionByName(titles), out_dir, "part",
                            [F.asc_nulls_first("week"), "kb", "line"])


def write_orders_roster(spark: SparkSession, sf_dir: str, out_dir: str,
                        files: int | None = None) -> None:
    """Every order as one roster cell: up to three ships a day in each weekly block."""
    files = files or SF.export_file_count(read_table(spark, sf_dir, "orders"))
    write_roster(spark, _order_slots(spark, sf_dir), out_dir, files)


def orders_roster_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the orders roster to the shared scratch folder, read it back, clean dates."""
    path = shared_scratch(spark, "roster")
    write_orders_roster(spark, sf_dir, path)
    calls, _ = read_roster(spark, path)
    return calls.select(reorder_date_text("Date", "/", (2, 0, 1), pad=True).alias("date"),
                        F.col("Boat").alias("boat"), F.col("Time").alias("time"))


@register("roster_regrid", """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, 'Ship ' || CAST(o_custkey AS VARCHAR) AS boat,
           printf('%02d00 - %02d00', o_orderkey % 12 + 6, o_orderkey % 12 + 12) AS time
    FROM orders""")
def q_roster_regrid(spark, sf_dir):
    """Every order through a roster export and back: the grid must give the orders."""
    return orders_roster_check(spark, sf_dir)
