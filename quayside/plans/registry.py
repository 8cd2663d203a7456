"""Query registry: a Spark builder per name and, where SQL can say it, a DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and reads the supplied tables under ``sf_dir``;
each oracle is a query over the same tables registered as views.  Column names and
types agree between the two (doubles for money and percentages, bigint for counts).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.session import ensure_checkpoint_dir

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: record ``fn`` under ``name`` with its optional oracle SQL.

    The registered callable first makes sure a shared folder is known.
    """
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
