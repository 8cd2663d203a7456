"""Occupancy analytics (Q3, Q4, Q5) and the hourly presence table they read.

``harbour`` columns: ``DateTime`` (timestamp_ntz), ``boat``, ``passengers``, ``agent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.time import zero_minutes
from quayside.operators.aggregates import percent_of, sum_by
from quayside.operators.joins import lookup_join, with_group_total
from quayside.operators.reshape import expand_hours
from quayside.operators.windows import DEFAULT_BUCKET_DAYS, change_point_intervals


def zero_harbour_minutes(harbour: DataFrame, time_col: str = "DateTime") -> DataFrame:
    """The correction run before the analytics - minutes set to zero."""
    return harbour.withColumn(time_col, zero_minutes(time_col))


def hourly_presence(stays: DataFrame, arrival: str = "arrival", departure: str = "departure",
                    out: str = "DateTime", keep: tuple[str, ...] = ("boat", "passengers")
                    ) -> DataFrame:
    """R3 then X16: one row per visit and hour present, minutes zeroed.

    Hours step from the arrival minute while <= departure, and the minutes are zeroed
    afterwards, so 08:30-17:00 gives 08..16 and 08:00-17:00 gives 08..17.
    """
    rows = expand_hours(stays.select(arrival, departure, *keep), arrival, departure, out)
    return rows.select(zero_minutes(out).alias(out), *keep)


def passengers_by_time(harbour: DataFrame, time_col: str = "DateTime") -> DataFrame:
    """Q3 without the order: ``DateTime, SUM(passengers) AS passengers_sum``."""
    return sum_by(harbour, time_col, "passengers", "passengers_sum")


def occupancy_by_time(harbour: DataFrame, time_col: str = "DateTime") -> DataFrame:
    """Q3: total people present per time, ascending by the total."""
    return passengers_by_time(harbour, time_col).orderBy("passengers_sum")


def occupancy_intervals(harbour: DataFrame, time_col: str = "DateTime",
                        width_days: int = DEFAULT_BUCKET_DAYS) -> DataFrame:
    """Q4: intervals of constant total occupancy, largest total first.

    Output: ``interval_start, interval_end, passengers_sum``.  The time series is the
    per-time total, so the ordered scan runs on one row per time, spread by time bucket.
    """
    totals = passengers_by_time(harbour, time_col)
    intervals = change_point_intervals(totals, time_col, "passengers_sum",
                                       width_days=width_days)
    return intervals.orderBy(F.desc("passengers_sum"))


def presence_share(harbour: DataFrame, nationalities: DataFrame,
                   time_col: str = "DateTime", collation: str | None = None) -> DataFrame:
    """Q5: each visitor group's share of the people present, with its nationality.

    Output: ``DateTime, passengers_sum, boat, nationality, passengers, agent,
    passengers_percentage`` (percent rounded to one decimal).  ``collation`` sets how ship
    names are matched (default: exactly).
    """
    with_total = with_group_total(harbour, time_col, "passengers", "passengers_sum")
    joined = lookup_join(with_total, nationalities, "boat", collation=collation)
    return joined.select(
        time_col, "passengers_sum", "boat", "nationality", "passengers", "agent",
        percent_of("passengers", "passengers_sum", 1).alias("passengers_percentage"))
