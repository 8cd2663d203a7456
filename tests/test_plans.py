"""Plan checks: no Python, no cross join, nothing persisted while a plan is built, filters and
column pruning reach the scans."""

from quayside.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_nothing_left_persisted(spark):
    for name, fn in catalog.QUERIES.items():
        plan = _plan(fn(spark, SF))
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan, name
        assert "InMemoryTableScan" not in plan and "BroadcastNestedLoop" not in plan, name
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_scan_prunes_columns(spark):
    plan = _plan(catalog.QUERIES["label_filter"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan
    assert "PushedFilters: [In(lang" in plan or "PushedFilters: [IsNotNull(lang)" in plan \
        or "In(lang" in plan
