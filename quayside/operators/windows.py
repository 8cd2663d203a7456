"""Whole-table ordered windows (W1-W3) without a single-partition exchange.

``LAG(x) OVER (ORDER BY t)`` and ``SUM(x) OVER (ORDER BY t)`` have no partition key, and
Spark runs such a window in one task.  Here they are computed as a two-level scan:

1. rows get a time bucket (``width_days`` wide) and the window runs per bucket, spread
   over the cluster by bucket;
2. a summary with one row per bucket (last value, bucket sum) is scanned in order; it
   has ``span / width_days`` rows, independent of the row count;
3. the summary's carry (value before the bucket, sum before the bucket) is joined back.

Null times sort first, as ``ORDER BY t`` does, and form their own bucket.

Buckets of a fixed time span suit series with a row a time, such as hourly totals.  Rows that
are not aggregated go through :func:`running_sums_by_range` and :func:`lag_by_range`, whose
buckets are ranges of about as many rows each, however the rows lie in time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import shared_scratch

DEFAULT_BUCKET_DAYS = 30

_B, _RN = "__bucket", "__rn"
_PART = "__part"


def time_bucket(order_col: str, width_days: int):
    """Bucket for a date/timestamp order column: ``width_days``-day buckets (null -> null)."""
    days = F.datediff(F.to_date(F.col(order_col)), F.lit("1970-01-01").cast("date"))
    return F.floor(days / F.lit(width_days))


def _with_bucket(df: DataFrame, order_col: str, width_days: int) -> DataFrame:
    return df.withColumn(_B, time_bucket(order_col, width_days))


def _join_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    carry = carry.withColumnRenamed(_B, "__cb")
    joined = rows.join(carry, rows[_B].eqNullSafe(carry["__cb"]), "inner")
    return joined.drop("__cb")


def ordered_lag(df: DataFrame, order_col: str, value_col: str, out_col: str,
                width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """``LAG(value) OVER (ORDER BY order_col)``; null on the first row.

    ``order_col`` must be unique, as a grouped time column is: among equal ones the order is
    arbitrary (:func:`lag_by_range` takes further columns that settle it).
    """
    w = Window.partitionBy(_B).orderBy(order_col)
    rows = (_with_bucket(df, order_col, width_days)
            .withColumn(_RN, F.row_number().over(w))
            .withColumn("__lag_in", F.lag(value_col).over(w)))
    summary = rows.groupBy(_B).agg(F.max_by(value_col, _RN).alias("__last"))
    carry = summary.select(_B, F.lag("__last").over(Window.orderBy(_B)).alias("__prev_last"))
    out = _join_carry(rows, carry)
    lag = F.when(F.col(_RN) == 1, F.col("__prev_last")).otherwise(F.col("__lag_in"))
    return out.withColumn(out_col, lag).drop(_B, _RN, "__lag_in", "__prev_last")


def position_bucket(order_col: str, width: int) -> "F.Column":
    """Bucket for an integer order column (record positions): ``floor(pos / width)``."""
    return F.floor(F.col(order_col) / F.lit(width))


def running_sums(df: DataFrame, order_col: str, values: dict[str, str],
                 partition_cols: tuple[str, ...] = (), bucket=None,
                 width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """W2 for several columns at once, optionally per partition key.

    ``values`` maps output column -> summed column; each output is
    ``SUM(value) OVER (PARTITION BY partition_cols ORDER BY order_col)`` with the default
    RANGE frame.  ``bucket`` (a Column) overrides the time bucket, e.g.
    :func:`position_bucket` for record positions.  No window spans more than one bucket
    and one partition key, so a huge partition still spreads over many tasks.
    """
    parts = list(partition_cols)
    b = bucket if bucket is not None else time_bucket(order_col, width_days)
    rows = df.withColumn(_B, b)
    w = Window.partitionBy(*parts, _B).orderBy(order_col)
    rows = rows.withColumns({f"__run_{o}": F.sum(c).over(w) for o, c in values.items()})
    summary = rows.groupBy(*parts, _B).agg(
        *[F.sum(c).alias(f"__bsum_{o}") for o, c in values.items()])
    before = Window.partitionBy(*parts).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*parts, _B, *[F.sum(f"__bsum_{o}").over(before).alias(f"__off_{o}")
                                         for o in values])
    carry = carry.select(*[F.col(p).alias(f"__c_{p}") for p in parts],
                         F.col(_B).alias("__cb"), *[f"__off_{o}" for o in values])
    cond = [rows[p].eqNullSafe(carry[f"__c_{p}"]) for p in parts]
    cond.append(rows[_B].eqNullSafe(carry["__cb"]))
    out = rows.join(carry, cond, "inner")
    exprs = {}
    for o in values:
        off, run = F.col(f"__off_{o}"), F.col(f"__run_{o}")
        exprs[o] = F.when(off.isNull() & run.isNull(), F.lit(None)) \
            .otherwise(F.coalesce(off, F.lit(0)) + F.coalesce(run, F.lit(0)))
    drop = [_B, "__cb", *[f"__c_{p}" for p in parts]]
    drop += [f"__run_{o}" for o in values] + [f"__off_{o}" for o in values]
    return out.withColumns(exprs).drop(*drop)


def running_sum(df: DataFrame, order_col: str, value_col: str, out_col: str,
                width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """``SUM(value) OVER (ORDER BY order_col)`` with the default RANGE frame."""
    return running_sums(df, order_col, {out_col: value_col}, width_days=width_days)


def change_groups(df: DataFrame, order_col: str, value_col: str, out_col: str,
                  width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """W3 core: run id of maximal stretches of equal consecutive values.

    Equals ``SUM(CASE WHEN v = LAG(v) OVER (ORDER BY t) THEN 0 ELSE 1 END) OVER (ORDER BY t)``:
    the first row starts a run, and a null value always starts its own run.  ``order_col`` must
    be unique, as for :func:`ordered_lag`.
    """
    w = Window.partitionBy(_B).orderBy(order_col)
    v = F.col(value_col)
    rows = (_with_bucket(df, order_col, width_days)
            .withColumn(_RN, F.row_number().over(w))
            .withColumn("__prev_in", F.lag(value_col).over(w)))
    inner_flag = F.when(F.col(_RN) == 1, F.lit(0)) \
        .when(v == F.col("__prev_in"), F.lit(0)).otherwise(F.lit(1))
    rows = rows.withColumn("__flag_in", inner_flag) \
        .withColumn("__run_in", F.sum("__flag_in").over(w))
    summary = rows.groupBy(_B).agg(
        F.min_by(value_col, _RN).alias("__first"),
        F.max_by(value_col, _RN).alias("__last"),
        F.sum("__flag_in").alias("__inner"))
    ordered = Window.orderBy(_B)
    summary = summary.withColumn(
        "__first_flag",
        F.when(F.col("__first") == F.lag("__last").over(ordered), F.lit(0)).otherwise(F.lit(1)))
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        _B, "__first_flag",
        F.coalesce(F.sum(F.col("__first_flag") + F.col("__inner")).over(before), F.lit(0))
        .alias("__offset"))
    out = _join_carry(rows, carry)
    group = F.col("__offset") + F.col("__first_flag") + F.col("__run_in")
    return out.withColumn(out_col, group.cast("bigint")).drop(
        _B, _RN, "__prev_in", "__flag_in", "__run_in", "__first_flag", "__offset")


def change_point_intervals(df: DataFrame, order_col: str, value_col: str,
                           start: str = "interval_start", end: str = "interval_end",
                           width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """``(MIN(t), MAX(t), v)`` for every run of equal consecutive values of ``v``.

    "Consecutive" follows the rows present: equal values either side of a missing time
    merge into one interval that spans the gap.
    """
    grouped = change_groups(df.select(order_col, value_col), order_col, value_col,
                            "__group", width_days)
    return (grouped.groupBy(value_col, "__group")
            .agg(F.min(order_col).alias(start), F.max(order_col).alias(end))
            .select(start, end, value_col))


# --------------------------------------------------------------------------- rows of any density

def range_partitioned(df: DataFrame, order_cols: list[str]) -> DataFrame:
    """``df`` written by ranges of ``order_cols``, with the number of each row's range.

    Borders are sampled, so ranges hold about as many rows each; rows that are equal in all
    ``order_cols`` are in one range, and ranges are numbered in their order (nulls first).
    """
    folder = shared_scratch(df.sparkSession, "ranges")
    dealt = df.repartitionByRange(*order_cols).withColumn(_PART, F.spark_partition_id())
    dealt.write.parquet(folder)
    return df.sparkSession.read.schema(dealt.schema).parquet(folder)


def running_sums_by_range(df: DataFrame, order_cols: list[str], values: dict[str, str]) -> DataFrame:
    """W2 over rows of any density: ``SUM(value) OVER (ORDER BY order_cols)`` per output column.

    The default RANGE frame gives equal order values the same sum, that of all of them: so the
    values of an order value are summed first (partial aggregates, however many rows share it),
    the distinct order values are scanned range by range, and the sums are joined back to the
    rows.  A range's sum is carried to those after it by the ranges' numbers.
    """
    summed = df.groupBy(*order_cols).agg(*[F.sum(c).alias(f"__sum_{o}") for o, c in values.items()])
    held = range_partitioned(summed, order_cols)
    upto = Window.partitionBy(_PART).orderBy(*order_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = held.groupBy(_PART).agg(*[F.sum(f"__sum_{o}").alias(f"__all_{o}") for o in values]) \
        .select(_PART, *[F.sum(f"__all_{o}").over(before).alias(f"__off_{o}") for o in values])
    run = {o: F.sum(f"__sum_{o}").over(upto) for o in values}
    scanned = held.repartitionByRange(_PART).select(
        _PART, *order_cols, *[c.alias(f"__run_{o}") for o, c in run.items()]).join(carry, _PART)
    totals = scanned.select(
        *[F.col(c).alias(f"__key_{c}") for c in order_cols],
        *[F.when(F.col(f"__off_{o}").isNotNull() | F.col(f"__run_{o}").isNotNull(),
                 F.coalesce(f"__off_{o}", F.lit(0)) + F.coalesce(f"__run_{o}", F.lit(0))).alias(o)
          for o in values])
    same = [df[c].eqNullSafe(totals[f"__key_{c}"]) for c in order_cols]
    return df.join(totals, same).drop(*[f"__key_{c}" for c in order_cols])


def lag_by_range(df: DataFrame, order_cols: list[str], value_col: str, out_col: str) -> DataFrame:
    """W1 over rows of any density: ``LAG(value) OVER (ORDER BY order_cols)``.

    Together ``order_cols`` must be unique.  The last value of a range is carried to the next one
    that has rows.
    """
    held = range_partitioned(df, order_cols)
    order = Window.partitionBy(_PART).orderBy(*order_cols)
    rows = held.repartitionByRange(_PART).withColumns(
        {"__lag_in": F.lag(value_col).over(order), _RN: F.row_number().over(order)})
    # A struct of the order columns sorts as they do, nulls first.
    last = held.groupBy(_PART).agg(
        F.max_by(value_col, F.struct(*order_cols)).alias("__last"))
    carry = last.select(_PART, F.lag("__last").over(Window.orderBy(_PART)).alias("__prev"))
    lag = F.when(F.col(_RN) == 1, F.col("__prev")).otherwise(F.col("__lag_in"))
    return rows.join(carry, _PART).withColumn(out_col, lag).drop(
        _PART, _RN, "__lag_in", "__prev")
