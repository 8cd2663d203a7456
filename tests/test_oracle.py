"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from quayside.plans import catalog
from quayside.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(records, cols):
    lines = sorted("|".join(_norm(r[c]) for c in cols) for r in records)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


# Spark type -> DuckDB type of the same values.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    srows = [r.asDict() for r in df.collect()]
    rel = duck.sql(catalog.ORACLES[name])
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        st = f.dataType.simpleString()
        assert TYPES.get(st, st.upper()) == duck_types[f.name], (f.name, st, duck_types[f.name])
    cols = sorted(df.columns)
    assert len(srows) == len(orows)
    assert _digest(srows, cols) == _digest(orows, cols)
