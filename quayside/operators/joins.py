"""Joins (J1-J6).

All are equi-joins left to the planner: it broadcasts a side whose statistics are small, AQE
does so when a finished stage proves small, and AQE splits skewed partitions.  Nothing is
persisted or measured while a plan is built.

Where both sides are large (:func:`task_count`), outer merges and anti joins deal their rows by
key over as many tasks as the files ask for: the planner's number of partitions is fixed, and AQE
joins them by their compressed bytes, up to one task that sorts all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_join(left: DataFrame, right: DataFrame, keys, how: str = "inner",
               collation: str | None = None) -> DataFrame:
    """Equi-join on named ``keys`` (kept once, from ``left``).

    With ``collation`` (e.g. ``"UTF8_LCASE_RTRIM"``: case- and trailing-space-insensitive,
    as a database server's default collation compares names) string keys are compared
    under that collation; the join stays an equi-join (hash or sort-merge).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if collation is None:
        return left.join(right, on=keys, how=how)
    r = right.select(*[F.col(k).alias(f"__rk_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])

    def side(df, name, k):
        c = df[name]
        is_text = dict(df.dtypes)[name] == "string"
        return F.collate(c, collation) if is_text else c

    cond = [side(left, k, k) == side(r, f"__rk_{k}", k) for k in keys]
    return left.join(r, cond, how).drop(*[f"__rk_{k}" for k in keys])


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
                collation: str | None = None) -> DataFrame:
    """Fact table enriched from a lookup table; unmatched facts are dropped (inner).

    Duplicate keys in ``dim`` multiply fact rows, as in SQL.  ``collation`` applies to
    named string keys (see :func:`keyed_join`).
    """
    if collation is None or not isinstance(on, (str, list, tuple)):
        return fact.join(dim, on=on, how=how)
    return keyed_join(fact, dim, on, how, collation)


DEALT_BYTES = 8 << 20  # bytes of the files read for each task of a dealt join
PLANNED_BYTES = 32 << 20  # joins that read less are left to the planner


def task_count(*inputs: DataFrame) -> int:
    """Tasks to deal rows over, by the sizes of the files that ``inputs`` read; 0 leaves it to the
    planner."""
    size = 0
    for df in inputs:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
        size += sum(x for x in sizes if x < 1 << 60)  # rows of the driver's have no known size
    return -(-size // DEALT_BYTES) if size > PLANNED_BYTES else 0


def dealt(df: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """``df`` with the rows of a key in one of ``tasks`` tasks; as it is where ``tasks`` is 0."""
    return df.repartition(tasks, *keys) if tasks else df


def anti_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``left`` whose key no row of ``right`` has."""
    n = task_count(left, right)
    return dealt(left, keys, n).join(dealt(right.select(*keys), keys, n), on=keys, how="left_anti")


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str],
                suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer equi-join; non-key columns present on both sides get ``suffixes``.

    Key columns are merged (the key of the side that has the row), as a pandas outer merge does.
    A full outer join gives every row of a hot key to one task, as nothing can split either side
    of it.  Here the matches are an inner join, of which both sides can be split at run time, and
    the rows without a match come from anti joins with the other side's distinct keys (partial
    aggregates), of which the rows' side can be split.  Rows with a null key match nothing.

    Large sides are dealt by key once for all three joins; then the rows of a hot key are in one
    task, which streams and spills them.  They are spread over tasks again only where the planner
    deals, below ``PLANNED_BYTES``.
    """
    n = task_count(left, right)
    common = (set(left.columns) & set(right.columns)) - set(keys)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in common else F.col(c)
            for c in left.columns if c not in keys]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in common else F.col(c)
            for c in right.columns if c not in keys]
    lk = [F.col(k).alias(f"__l_{k}") for k in keys]
    rk = [F.col(k).alias(f"__r_{k}") for k in keys]
    l2 = dealt(left.select(*lk, *lsel), [f"__l_{k}" for k in keys], n)
    r2 = dealt(right.select(*rk, *rsel), [f"__r_{k}" for k in keys], n)
    cond = [F.col(f"__l_{k}") == F.col(f"__r_{k}") for k in keys]
    l_only = l2.join(r2.select(*[f"__r_{k}" for k in keys]).distinct(), cond, "left_anti")
    r_only = r2.join(l2.select(*[f"__l_{k}" for k in keys]).distinct(), cond, "left_anti")
    names = {c: t for c, t in [*l2.dtypes, *r2.dtypes]}
    rest = [c for c in [*l2.columns, *r2.columns] if not c.startswith(("__l_", "__r_"))]

    def rows(df: DataFrame, side: str) -> DataFrame:
        return df.select(*[F.col(f"__{side}_{k}").alias(k) for k in keys],
                         *[F.col(c) if c in df.columns else F.lit(None).cast(names[c]).alias(c)
                           for c in rest])

    return rows(l2.join(r2, cond, "inner"), "l").union(rows(l_only, "l")).union(rows(r_only, "r"))


def with_group_total(df: DataFrame, key: str, value: str, total_name: str) -> DataFrame:
    """Each row next to the total of its group, as ``row JOIN (SUM .. GROUP BY key)``.

    Written as aggregate + equi-join rather than a window: the totals are partial sums and
    the join is broadcast when they are small (AQE) or split by AQE when a key is hot,
    while a window would gather every row of a hot key into one task.  Rows with a null
    key are dropped, as an inner join does.
    """
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(total_name))
    return df.join(totals, on=key, how="inner")
