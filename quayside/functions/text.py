"""Scalar string functions.

Every function maps ``Column -> Column`` and stays inside Spark's built-in expressions, so
it is code-generated with the rest of the stage.  Null in gives null out unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._col import col_of

# Characters that a Python ``str.strip()`` removes: Unicode white space plus the four
# ASCII separators 0x1C-0x1F that Python also treats as white space.
_WS = r"[\s\x1c-\x1f]"


def strip_whitespace(c) -> Column:
    """Remove white space at both ends (``trim`` alone removes blanks only)."""
    return F.regexp_replace(col_of(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def strip_chars(c, chars: str) -> Column:
    """Remove any of ``chars`` from both ends, like ``str.strip(chars)``."""
    return F.trim(col_of(c), F.lit(chars))


def strip_sequence(c, *char_sets: str | None) -> Column:
    """X1+X2 applied once each, in order; ``None`` in the list means white space."""
    out = col_of(c)
    for chars in char_sets:
        out = strip_whitespace(out) if chars is None else strip_chars(out, chars)
    return out


def zero_pad(c, width: int = 2, fill: str = "0") -> Column:
    """Left-pad to ``width`` like ``str.rjust``; longer values are never cut."""
    c = col_of(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def slice_text(c, start: int, stop: int | None = None) -> Column:
    """Python slice ``s[start:stop]`` for non-negative bounds (short input gives '')."""
    c = col_of(c)
    if stop is None:
        return F.substring(c, start + 1, 2 ** 31 - 1)
    return F.substring(c, start + 1, max(stop - start, 0))


def left(c, n: int) -> Column:
    """SQL ``LEFT(s, n)``."""
    return F.substring(col_of(c), 1, n)


def mid(c, start: int, length: int) -> Column:
    """SQL ``SUBSTRING(s, start, length)`` with 1-based ``start``."""
    return F.substring(col_of(c), start, length)


def contains_any(c, needles: list[str]) -> Column:
    """True when the text contains any of ``needles`` (case-sensitive).

    A literal list is one expression, ORed in pairs so that a long list nests little; a table
    of keywords goes through :func:`quayside.operators.filters.exclude_keywords`.
    """
    parts = [col_of(c).contains(n) for n in needles] or [F.lit(False)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1:]
    return parts[0]


def replace_value(c, old: str, new) -> Column:
    """One value becomes another (``":"`` -> ``""``); ``new=None`` means null."""
    c = col_of(c)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def empty_to_null(c) -> Column:
    """``""`` becomes null."""
    return F.nullif(col_of(c), F.lit(""))


def number_text(c) -> Column:
    """A number as people write it, as one that casts: blanks out, decimal comma to point."""
    return F.translate(col_of(c), ",\u00a0\u202f ", ".")


def whole_number(c) -> Column:
    """Number text with no fraction (``12``, ``12.0``, ``1 200``) as bigint, else null."""
    d = number_text(c).try_cast("decimal(38,6)")
    return F.when(d == F.floor(d), d.cast("bigint"))


def unparsed(raw, value) -> Column:
    """True where text was given but no value came of it."""
    return col_of(raw).isNotNull() & (F.trim(col_of(raw)) != "") & col_of(value).isNull()
