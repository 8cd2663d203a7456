"""File sources and sinks.

Raw exports are read as strings and typed later with lenient parsers.  CSV columns are chosen
by the names in the file's header.  Record files are read by the splittable line reader; where
the order of lines matters (the weekly roster grid, a preamble) each record gets its number in
its file, so one file still spans many tasks.

Windows-1252 is read and written as Latin-1, which Spark has everywhere, with the 27 characters
that differ translated; no session setting is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import shared_scratch

_DIFFERING = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0)
              if bytes([b]).decode("cp1252", "ignore")]
_LATIN_1 = "".join(a for a, _ in _DIFFERING)
_WINDOWS = "".join(b for _, b in _DIFFERING)


def _is_windows(encoding: str) -> bool:
    return encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")


def _reader_charset(encoding: str) -> str:
    return "ISO-8859-1" if _is_windows(encoding) else encoding


def _as_read(c: Column, encoding: str) -> Column:
    """Text read as Latin-1 as the text that was meant."""
    return F.translate(c, _LATIN_1, _WINDOWS) if _is_windows(encoding) else c


def _as_written(c: Column, encoding: str) -> Column:
    return F.translate(c, _WINDOWS, _LATIN_1) if _is_windows(encoding) else c


def string_schema(names: list[str]) -> T.StructType:
    """All-string schema for a raw export."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


_PLACE = ("__file", "__split", "__id")


def _placed() -> list[Column]:
    """Where a row of a file scan comes from: its file, its split, and a number that grows there."""
    return [F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.file_block_start").alias("__split"),
            F.monotonically_increasing_id().alias("__id")]


def _numbered(rows: DataFrame, name: str, per_file: bool) -> DataFrame:
    """``rows`` (a file scan with the columns of ``_placed``) with their numbers from 0, without
    holes: in their file, or through all files in the order of their paths.

    The scan is written to the shared folder once.  One count a split, summed up in the order of
    files and offsets, makes the numbers within a split those of the file; so they depend on the
    files alone, not on the number of tasks.
    """
    spark = rows.sparkSession
    folder = shared_scratch(spark, "records")
    rows.write.parquet(folder)
    held = spark.read.schema(rows.schema).parquet(folder)
    # A task may read several splits, so the numbers of one start at its least.
    splits = held.groupBy("__file", "__split").agg(F.min("__id").alias("__first"),
                                                   F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy("__file").orderBy("__split") if per_file else \
        Window.orderBy("__file", "__split")
    before = F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("__file", "__split", (
        F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__start"))
    return held.join(starts, ["__file", "__split"]).withColumn(
        name, F.col("__start") + F.col("__id")).drop("__split", "__id", "__start")


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             header: bool = True, encoding: str = "UTF-8", sep: str = ",",
             position: str | None = None) -> DataFrame:
    """A CSV export as strings, in any Java charset.

    With ``position`` a first column of that name numbers the rows from 0 as the files list them
    (files in the order of their paths), the same on every run; see :func:`_numbered`.

    With a header the file's own names count: ``columns`` are selected by name, whatever their
    order and whatever else the file has, and a missing one is an error.  Without a header
    ``columns`` names the columns by position.
    """
    reader = (spark.read.option("header", header).option("encoding", _reader_charset(encoding))
              .option("sep", sep).option("mode", "PERMISSIVE"))
    def numbered(df: DataFrame) -> DataFrame:
        if position is None:
            return df.drop(*_PLACE)
        return _numbered(df, position, per_file=False).select(
            position, *[c for c in df.columns if c not in _PLACE])

    place = _placed() if position else []
    if not header:
        df = reader.schema(string_schema(columns)).csv(path)
        return numbered(df.select(*[_as_read(F.col(f"`{c}`"), encoding).alias(c) for c in columns],
                                  *place))
    df = reader.csv(path)
    names_read = df.columns
    df = df.select(*[F.col(f"`{c}`") for c in names_read], *place)
    if _is_windows(encoding):
        names = str.maketrans(_LATIN_1, _WINDOWS)
        df = df.toDF(*[c.translate(names) for c in df.columns])
        names_read = [c.translate(names) for c in names_read]
    wanted = columns or names_read
    missing = [c for c in wanted if c not in names_read]
    if missing:
        raise ValueError(f"{path} has no column {missing}; it has {names_read}")
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return numbered(df.select(*[_as_read(F.col(f"`{c}`"), encoding).alias(c) if c in text
                                else F.col(f"`{c}`") for c in wanted],
                              *[c for c in _PLACE if position]))


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-8",
                 terminator_regex: str = r",?\r?$") -> DataFrame:
    """``(file, pos, record)`` for every line of every file under ``path``.

    ``pos`` is the line's number in its file, from 0 and without holes.  Splittable: a file larger
    than a split is read by several tasks.  The files are read once and their records written to
    the shared folder (:func:`_numbered`), so whatever uses the records reads only the columns that
    it needs.  What ``terminator_regex`` matches at the end of a line is not part of the record.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path))
    text = F.col("value")
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        text = _as_read(F.decode(text.cast("binary"), _reader_charset(encoding)), encoding)
    at = lines.select(*_placed(), F.regexp_replace(text, terminator_regex, "").alias("record"))
    return _numbered(at, "pos", per_file=True).select(F.col("__file").alias("file"), "pos", "record")


def skip_leading(records: DataFrame, n: int) -> DataFrame:
    """S5 by position: drop the first ``n`` records of each file."""
    return records.where(F.col("pos") >= n)


def split_cells(record, sep: str = ",") -> Column:
    """Naive field split, quotes not honoured (``line.split(",")``)."""
    rx = "\\" + sep if sep in ".^$*+?()[]{}|\\/" else sep
    return F.split(record if isinstance(record, Column) else F.col(record), rx)


# --------------------------------------------------------------------------- sinks

def write_csv(df: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8",
              mode: str = "overwrite") -> None:
    """K1/K2: CSV directory of part files (one per task), with or without a header."""
    if _is_windows(encoding):
        names = str.maketrans(_WINDOWS, _LATIN_1)
        df = df.select(*[_as_written(F.col(f"`{f.name}`"), encoding).alias(f.name.translate(names))
                         if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                         for f in df.schema.fields])
    (df.write.mode(mode).option("header", header)
     .option("encoding", _reader_charset(encoding)).csv(path))


def with_row_id(df: DataFrame, name: str = "ID", key: list[str] | None = None) -> DataFrame:
    """K3: an id column first.

    Without ``key`` the id is ``monotonically_increasing_id()``: unique, increasing
    within a partition, not dense, no shuffle.  With ``key`` it is a stable hash of the
    key columns, the same on every run.
    """
    ident = F.xxhash64(*key) if key else F.monotonically_increasing_id()
    return df.select(ident.alias(name), *df.columns)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """K4: one text line per row (UTF-8)."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_ordered_export(records: DataFrame, path: str, part_col: str, order_cols: list,
                         record_col: str = "record", encoding: str = "UTF-8",
                         terminator: str = ",", mode: str = "overwrite") -> None:
    """Write records as ordered export files: one file per value of ``part_col``.

    Rows are hash-distributed by ``part_col`` and sorted by ``order_cols`` within it, so
    every file holds its records in order (put a file's preamble first in that order).
    Each record is written as ``<record><terminator>\\n`` in ``encoding``, unquoted.
    """
    line = _as_written(F.concat(F.col(record_col), F.lit(terminator)), encoding)
    out = (records.repartition(part_col)
           .sortWithinPartitions(part_col, *order_cols)
           .select(line.alias("value"), part_col))
    (out.write.mode(mode).partitionBy(part_col)
     .option("encoding", _reader_charset(encoding)).option("sep", "\u0001")
     .option("quote", "").option("escape", "").option("quoteAll", False)
     .option("header", False)
     .csv(path))


def export_file_count(df: DataFrame, bytes_per_file: int = 32 << 20, minimum: int = 4) -> int:
    """Number of files for an ordered export of ``df``, the scan of a base table: one per
    ``bytes_per_file`` of its files (text is several times larger), so that writer tasks grow
    with the data."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(minimum, -(-size // bytes_per_file))
