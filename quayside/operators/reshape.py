"""Set and shape operators.

All of them are narrow (per-row generators) except the block regrid R1, which needs the
line order of its input file and therefore windows by file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.time import one_hour
from quayside.operators.filters import regex_full_match
from quayside.operators.windows import position_bucket


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenation by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unpivot_pairs(df: DataFrame, keep: list[str], pairs: list[tuple[str, ...]],
                  names: tuple[str, ...]) -> DataFrame:
    """Paired wide -> long in one pass.

    ``pairs`` = [("Boat1", "Time1"), ("Boat2", "Time2"), ...] and ``names`` = ("Boat", "Time")
    give one output row per input row and pair, in pair order.  Null pairs are kept; drop
    them with :func:`quayside.operators.filters.drop_nulls`.
    """
    structs = [F.struct(*[F.col(src).alias(dst) for src, dst in zip(pair, names)])
               for pair in pairs]
    return df.select(*keep, F.inline(F.array(*structs)))


def expand_hours(df: DataFrame, arrival: str, departure: str, out: str,
                 step=None) -> DataFrame:
    """One row per hour from ``arrival`` stepping by ``step`` while <= ``departure``.

    Rows with a missing bound or a departure before the arrival give no rows (see
    :func:`hours_rejects` for them); other columns are repeated on every hour.
    """
    a, d = F.col(arrival), F.col(departure)
    hours = F.when(a <= d, F.sequence(a, d, step if step is not None else one_hour()))
    return df.withColumn(out, F.explode(hours))


def hours_rejects(df: DataFrame, arrival: str, departure: str) -> DataFrame:
    """Rows :func:`expand_hours` cannot expand: a null bound or departure < arrival."""
    a, d = F.col(arrival), F.col(departure)
    return df.where(a.isNull() | d.isNull() | (d < a))


def _placed(records: DataFrame, file_col: str, pos_col: str, width: int,
            title: bool) -> DataFrame:
    """``records`` (with 0/1 columns ``__h``, header, and ``__k``, kept) with ``__block`` and
    ``__slot``, without each file's first one where that is its title.

    A two-level scan.  Within a bucket of ``width`` positions windows count headers and kept
    records and carry the last header's rank; one row a bucket sums that up, and its scan over
    the file gives each bucket the counts before it, the rank of the last header before it and
    what the file's first record was.
    """
    b = position_bucket(pos_col, width)
    here = Window.partitionBy(file_col, "__b").orderBy(pos_col)
    rows = (records.withColumn("__b", b)
            .withColumns({"__run_h": F.sum("__h").over(here), "__run_k": F.sum("__k").over(here)})
            .withColumn("__last", F.max(F.when(F.col("__h") == 1, F.col("__run_k"))).over(here)))
    summary = rows.groupBy(file_col, "__b").agg(
        F.max("__run_h").alias("__n_h"), F.max("__run_k").alias("__n_k"),
        F.max("__last").alias("__top"), F.min(F.struct(pos_col, "__h")).alias("__first"))
    order = Window.partitionBy(file_col).orderBy("__b")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carry = (summary.withColumns({
        "__off_h": F.coalesce(F.sum("__n_h").over(before), F.lit(0)),
        "__off_k": F.coalesce(F.sum("__n_k").over(before), F.lit(0)),
        "__title": F.first("__first").over(order)})
        .withColumn("__off_last", F.max(F.col("__off_k") + F.col("__top")).over(before))
        .select(F.col(file_col).alias("__f"), F.col("__b").alias("__c"), "__off_h", "__off_k",
                "__off_last", "__title"))
    met = rows.join(carry, (rows[file_col] == carry["__f"]) & (rows["__b"] == carry["__c"]))
    block = F.col("__off_h") + F.col("__run_h")
    if title:  # it opens no block, even if it looks like a header
        first = F.col("__title")
        met = met.where(F.col(pos_col) > first[pos_col])
        block = block - first["__h"]
    slot = F.col("__off_k") + F.col("__run_k") - F.coalesce(
        F.col("__off_k") + F.col("__last"), F.col("__off_last"))
    return met.withColumns({"__block": block, "__slot": slot.cast("int")}).drop(
        "__b", "__c", "__f", "__run_h", "__run_k", "__last", "__off_h", "__off_k", "__off_last",
        "__title")


def regrid_blocks(records: DataFrame, file_col: str, pos_col: str, cells_col: str,
                  header_col: str, slot_names: list[str], width: int = 2048,
                  drop_empty: bool = False, keep_col: str | None = None,
                  title: bool = False) -> tuple[DataFrame, DataFrame]:
    """Block regrid of an ordered record file.

    Input rows are records of a file in order (``pos``), with their cells as an array and
    a flag marking block headers.  A block runs from a header to the next one; the k-th
    record of every block becomes output column ``slot_names[k]`` and every cell position
    within the block becomes an output row.  The header's cell 0 reads ``"*"``.  Missing
    slots are null.  Records whose ``keep_col`` is false are no slots; with ``title`` the first
    record of each file is its title and left out.

    Block number and slot come from one two-level scan over the positions (``width`` records
    per bucket), whose one row a bucket also carries the rank of the last header; so no window
    holds a whole file, and the records are scanned once for the summary and once for the rows.

    With ``drop_empty`` empty cells are left out before the regrid (they come out null
    instead of ``""``), which saves most of the work on sparse grids.

    Returns ``(grid, rejects)``; rejects are the kept records before a file's first header and
    those of slots beyond ``len(slot_names)``, as ``(file, pos, cells, reason)``.
    Output columns: ``file``, ``block``, ``cell``, then ``slot_names``.
    """
    kept = F.col(keep_col) if keep_col else F.lit(True)
    marked = records.withColumn("__k", kept.cast("int")).withColumn(
        "__h", F.coalesce(F.col(header_col), F.lit(False)).cast("int") * F.col("__k"))
    placed = _placed(marked, file_col, pos_col, width, title).where(F.col("__k") == 1)
    reject = (F.col(file_col).alias("file"), F.col(pos_col).alias("pos"),
              F.col(cells_col).alias("cells"))
    reason = F.when(F.col("__block") == 0, F.lit("no block")).when(
        F.col("__slot") >= len(slot_names), F.lit("no slot"))
    rejects = placed.select(*reject, reason.alias("reason")).where(F.col("reason").isNotNull())
    cells = F.when(F.col(header_col), F.concat(
        F.array(F.lit("*")), F.slice(F.col(cells_col), F.lit(2), F.size(cells_col)))) \
        .otherwise(F.col(cells_col))
    cells = placed.where(reason.isNull()).select(
        F.col(file_col).alias("file"), F.col("__block").alias("block"),
        F.col("__slot").alias("slot"), F.posexplode(cells).alias("cell", "value"))
    if drop_empty:
        cells = cells.where(F.col("value") != F.lit(""))
    # At most len(slot_names) values per (file, block, cell): a small map per group keeps
    # the aggregation hash-based (string "first" would force a sort-based one).
    grid = (cells.groupBy("file", "block", "cell")
            .agg(F.map_from_entries(F.collect_list(F.struct("slot", "value"))).alias("m")))
    grid = grid.select("file", "block", "cell",
                       *[F.try_element_at("m", F.lit(i)).alias(n)
                         for i, n in enumerate(slot_names)])
    return grid, rejects


def mark_headers(cells_col: str, probe_index: int, pattern: str):
    """C10 + F7: a record is a block header when cell ``probe_index`` fully matches."""
    return regex_full_match(F.get(F.col(cells_col), probe_index), pattern)
