"""Keyed corrections and recoding.

Fixes are data, not code: a correction table holds business keys and the values to write, so
the same job runs for any export.  Tables are joined by key; several fixes of one key are
merged first, so a fix never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions._col import col_of
from quayside.operators.joins import anti_join


def merge_fixes(fixes: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per key: for each field its least given value, and ``__conflict`` where a field
    of the key was given several."""
    return fixes.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in fields],
        F.greatest(F.lit(False), *[F.coalesce(F.min(c) != F.max(c), F.lit(False))
                                   for c in fields]).alias("__conflict"))


def fix_conflicts(fixes: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """The keys for which ``fixes`` gives several values of one field."""
    return merge_fixes(fixes, keys, fields).where("__conflict").select(*keys)


def apply_fixes(df: DataFrame, fixes: DataFrame, keys: list[str], fields: list[str],
                mode: str = "soft") -> tuple[DataFrame, DataFrame]:
    """C1 (``mode="soft"``) / C2 (``mode="hard"``): keyed cell corrections.

    ``fixes`` has the key columns and one nullable column per field in ``fields``; a null
    there means "no fix for this field".  Soft writes only where the cell is null, hard
    always writes.  Several fixes of a key are merged; of several values for one field the
    least is written (see :func:`fix_conflicts`).  Returns ``(fixed, unused)`` where
    ``unused`` lists the fixes whose key matches no row.
    """
    if mode not in ("soft", "hard"):
        raise ValueError("mode must be 'soft' or 'hard'")
    merged = merge_fixes(fixes, keys, fields).select(
        *keys, *[F.col(c).alias(f"__fix_{c}") for c in fields])
    joined = df.join(merged, on=keys, how="left")
    exprs = {}
    for c in fields:
        old, new = F.col(c), F.col(f"__fix_{c}")
        exprs[c] = (F.coalesce(old, new) if mode == "soft" else F.coalesce(new, old)).cast(
            df.schema[c].dataType)
    fixed = joined.withColumns(exprs).select(*df.columns)
    return fixed, anti_join(fixes, df, keys)


def merge_corrections(keys: list[str], fields: list[str], soft: DataFrame | None = None,
                      hard: DataFrame | None = None, exclusions: DataFrame | None = None,
                      offsets: DataFrame | None = None, days_col: str = "days") -> DataFrame | None:
    """C1-C4 of one key as one table: a row per key with ``__soft_<field>``, ``__hard_<field>``,
    ``__excluded`` and ``__days``.

    The given tables are stacked and grouped once, so that the rows to correct meet them in one
    join (:func:`apply_corrections`) whatever kinds there are.  Several fixes of a key are merged
    as by :func:`merge_fixes`, several offsets are added up.  None where no table is given.
    """
    none = F.lit(None)
    given = []
    for kind, table in (("soft", soft), ("hard", hard), ("out", exclusions), ("days", offsets)):
        if table is not None:
            given.append(table.select(
                *keys, *[(F.col(c) if kind == k else none).cast("string").alias(f"__{k}_{c}")
                         for k in ("soft", "hard") for c in fields],
                F.lit(kind == "out").alias("__excluded"),
                (F.col(days_col) if kind == "days" else none).cast("bigint").alias("__days")))
    if not given:
        return None
    stacked = given[0]
    for table in given[1:]:
        stacked = stacked.union(table)
    return stacked.groupBy(*keys).agg(
        *[F.min(f"__{k}_{c}").alias(f"__{k}_{c}") for k in ("soft", "hard") for c in fields],
        F.max("__excluded").alias("__excluded"), F.sum("__days").cast("int").alias("__days"))


def apply_corrections(df: DataFrame, merged: DataFrame | None, keys: list[str],
                      fields: list[str]) -> DataFrame:
    """``df`` with the fixes of :func:`merge_corrections` in ``fields`` (hard before soft), and
    ``__excluded`` and ``__days`` for the caller to use."""
    if merged is None:
        return df.withColumns({"__excluded": F.lit(False), "__days": F.lit(0)})
    joined = df.join(merged, on=keys, how="left")
    fixed = {c: F.coalesce(F.col(f"__hard_{c}").cast(df.schema[c].dataType), F.col(c),
                           F.col(f"__soft_{c}").cast(df.schema[c].dataType)) for c in fields}
    return joined.withColumns({**fixed, "__excluded": F.coalesce("__excluded", F.lit(False)),
                               "__days": F.coalesce("__days", F.lit(0))}) \
        .select(*df.columns, "__excluded", "__days")


def exclude_keys(df: DataFrame, exclusions: DataFrame, keys: list[str]) -> DataFrame:
    """Drop the rows whose key is listed in ``exclusions``."""
    return df.join(exclusions.select(*keys), on=keys, how="left_anti")


def add_days(df: DataFrame, offsets: DataFrame, keys: list[str], columns: list[str],
             days_col: str = "days") -> DataFrame:
    """C4: add ``days`` from a keyed offsets table to each timestamp in ``columns``.

    Several offsets of one key are added up.
    """
    o = offsets.groupBy(*keys).agg(F.sum(days_col).cast("int").alias("__days"))
    joined = df.join(o, on=keys, how="left")
    shift = F.make_dt_interval(F.coalesce(F.col("__days"), F.lit(0)))
    return joined.withColumns({c: F.col(c) + shift for c in columns}).select(*df.columns)


def recode(c, mapping: dict[str, str]) -> Column:
    """Exact full-value recode in one pass; values not in ``mapping`` are unchanged.

    One pass means ``a -> b`` and ``b -> c`` send ``a`` to ``b``, not to ``c``.  For the few
    pairs written in code; a table of pairs goes through :func:`recode_by_table`.
    """
    c = col_of(c)
    out = None
    for old, new in mapping.items():
        out = F.when(c == F.lit(old), F.lit(new)) if out is None else \
            out.when(c == F.lit(old), F.lit(new))
    return c if out is None else out.otherwise(c)


def recode_by_table(df: DataFrame, column: str, table: DataFrame,
                    from_col: str = "from_value", to_col: str = "to_value") -> DataFrame:
    """C5 for a table of pairs: a lookup join on the value (of several pairs for one value
    the least target)."""
    t = table.groupBy(F.col(from_col).alias("__from")).agg(F.min(to_col).alias("__to"))
    joined = df.join(t, F.col(column) == F.col("__from"), "left")
    return joined.withColumn(column, F.coalesce(F.col("__to"), F.col(column))) \
        .select(*df.columns)


def recode_column(df: DataFrame, column: str, pairs: dict[str, str] | DataFrame | None) -> DataFrame:
    """C5 on a column of ``df``, from a dict or a table (from_value, to_value)."""
    if pairs is None:
        return df
    if isinstance(pairs, DataFrame):
        return recode_by_table(df, column, pairs)
    return df.withColumn(column, recode(column, pairs))


def set_where(df: DataFrame, column: str, value, condition: Column) -> DataFrame:
    """``UPDATE t SET column = value WHERE condition`` as a projection.

    ``value`` is a literal or a Column expression; rows where the condition is false or
    null keep their value.
    """
    v = value if isinstance(value, Column) else F.lit(value)
    dtype = df.schema[column].dataType
    return df.withColumn(column, F.when(condition, v.cast(dtype)).otherwise(F.col(column)))


def apply_updates(df: DataFrame, updates: list[tuple[str, object, Column]]) -> DataFrame:
    """Several ``UPDATE`` statements in order; later ones see earlier results."""
    for column, value, condition in updates:
        df = set_where(df, column, value, condition)
    return df


def override_when_present(base, override) -> Column:
    """``override`` wins when it is non-null and non-empty, else ``base``."""
    return F.coalesce(F.nullif(col_of(override), F.lit("")), col_of(base))
