"""Write PLANS.md: what the executed plan (AQE final) of each query holds, one row a query.

Usage: python tools/plans.py [sf_dir]
"""

import collections
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quayside.plans import catalog  # noqa: E402
from quayside.session import build_session  # noqa: E402

HEAD = """# Physical plans

Operators in the executed plans (AQE final) on local[8], by `tools/plans.py`; a reused exchange
counts as reused only. "Single" is an exchange to one partition: those left are over one row a
time or position bucket (ordered scans) or a total order of a small result. No plan has Python, a
cross join or a cached table. Exports that a query writes before it reads them are not shown.

| query | shuffles (hash, range, single, reused) | joins | windows | scans: columns read |
| --- | --- | --- | --- | --- |
"""


def row(name: str, plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]
    kinds = collections.Counter(re.findall(r"Exchange (\w+?)partitioning|Exchange (SinglePartition)", plan))
    hashed = sum(n for (a, _), n in kinds.items() if a == "hash")
    ranged = sum(n for (a, _), n in kinds.items() if a == "range")
    single = sum(n for (_, b), n in kinds.items() if b)
    reused = len(re.findall(r"ReusedExchange", plan))
    joins = collections.Counter(re.findall(r"(BroadcastHash|SortMerge|ShuffledHash)Join", plan))
    windows = len(re.findall(r"\bWindow \[", plan))
    scans = collections.Counter(
        str(len(re.findall(r"[\w ()]+:", s)) if s else 0)
        for s in re.findall(r"ReadSchema: struct<([^>\n]*)>", plan))
    scans = ", ".join(f"{n} of {c}" for c, n in sorted(scans.items()))
    joins = ", ".join(f"{n} {k}" for k, n in joins.items()) or "-"
    return f"| {name} | {hashed}, {ranged}, {single}, {reused} | {joins} | {windows or '-'} | {scans} |"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(app_name="quayside-plans")
    rows = []
    for name, query in catalog.QUERIES.items():
        df = query(spark, sf_dir)
        df.collect()  # run through this DataFrame's own execution, so AQE's final plan shows
        rows.append(row(name, df._jdf.queryExecution().executedPlan().toString()))
    spark.stop()
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(top, "PLANS.md"), "w") as fh:
        fh.write(HEAD + "\n".join(rows) + "\n")


if __name__ == "__main__":
    main()
