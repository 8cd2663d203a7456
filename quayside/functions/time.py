"""Scalar date and time functions.

Timestamps are zone-free (``timestamp_ntz``) end to end, so no result depends on the
session time zone or on daylight-saving gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._col import col_of
from quayside.functions.text import replace_value, slice_text, strip_sequence, zero_pad


def one_day() -> Column:
    return F.make_dt_interval(F.lit(1))


def one_hour() -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(1))


def compact_time(c) -> Column:
    """``"0800"`` -> ``"08:00"``.

    The text is cut as ``s[0:2] + ":" + s[2:5]`` (so ``"08:00"`` becomes ``"08::00"`` and is
    later rejected by the timestamp parse); an empty input gives ``":"`` which is turned back
    into ``""``.  Null stays null.
    """
    c = col_of(c)
    joined = F.concat(slice_text(c, 0, 2), F.lit(":"), slice_text(c, 2, 5))
    return replace_value(joined, ":", "")


def split_time_range(c, sep: str = "-") -> tuple[Column, Column]:
    """``"0800 - 1700"`` -> (``"0800 "``, ``" 1700"``) after stripping the whole text.

    A text without ``sep`` gives a null second part.  Use :func:`clean_clock_text` on the
    parts afterwards.
    """
    parts = F.split(strip_sequence(c, None), _regex_literal(sep))
    return F.get(parts, 0), F.get(parts, 1)


def clean_clock_text(c) -> Column:
    """X1+X2 on one time part: white space, then ``:``, then ``?``, each stripped once."""
    return strip_sequence(c, None, ":", "?")


def lenient_timestamp(c, fmt: str | None = None) -> Column:
    """Text -> ``timestamp_ntz``; anything unparsable becomes null.

    Without ``fmt`` the ISO forms Spark's cast accepts are read (``yyyy-M-d H:m:s``,
    ``T`` separator, optional fraction).  With ``fmt`` an explicit pattern is used.
    """
    c = col_of(c)
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")


def strict_timestamp(c) -> Column:
    """Text -> ``timestamp_ntz``; malformed text fails the query (ANSI cast)."""
    return col_of(c).cast("timestamp_ntz")


def is_overnight(arrival, departure) -> Column:
    """Departure earlier than arrival on the same date."""
    return col_of(departure) < col_of(arrival)


def roll_overnight(arrival, departure) -> Column:
    """X11: add one day to ``departure`` when it is earlier than ``arrival``."""
    d = col_of(departure)
    return F.when(is_overnight(arrival, d), d + one_day()).otherwise(d)


def reorder_date_text(c, sep: str, order: tuple[int, int, int], pad: bool = False) -> Column:
    """``"d.m.yyyy"``-style text -> ``"yyyy-mm-dd"`` text.

    ``order`` gives the positions of (year, month, day) among the ``sep``-separated parts.
    With ``pad`` month and day are left-padded to two digits (X3).  Missing parts give null.
    """
    parts = F.split(col_of(c), _regex_literal(sep))
    y, m, d = (F.get(parts, i) for i in order)
    if pad:
        m, d = zero_pad(m), zero_pad(d)
    return F.concat(y, F.lit("-"), m, F.lit("-"), d)


def iso_hour_text(year, month, day, hour) -> Column:
    """Parts -> ``yyyy-MM-ddTHH:00`` with month, day and hour padded to two digits."""
    return F.concat(col_of(year).cast("string"), F.lit("-"), zero_pad(col_of(month).cast("string")),
                    F.lit("-"), zero_pad(col_of(day).cast("string")), F.lit("T"),
                    zero_pad(col_of(hour).cast("string")), F.lit(":00"))


def timestamp_text(c) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text (ODBC canonical style)."""
    return F.date_format(col_of(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def zero_minutes(c) -> Column:
    """Set the minute to 0 and keep seconds and fraction (10:35:07.5 -> 10:00:07.5)."""
    c = col_of(c)
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(c), F.lit(0))


def truncate_to_minute(c) -> Column:
    """Drop seconds and fraction, staying ``timestamp_ntz``."""
    c = col_of(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                F.lit(0))


def join_date_time(date_text, clock_text, seconds: str = ":00") -> Column:
    """``"yyyy-mm-dd" + " " + "HH:MM" + ":00"`` (null when either part is null)."""
    return F.concat(col_of(date_text), F.lit(" "), col_of(clock_text), F.lit(seconds))


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)
