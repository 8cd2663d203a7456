"""The entry point without a library that only the training-text part needs."""

import os
import subprocess
import sys

import pytest

from quayside.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {hidden!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as E
print("FOUND", len(E.queries()), len(E.oracle_sql()))
"""


@pytest.mark.parametrize("hidden", ["public_tokenizers", "zstandard", "corpus_pipeline"])
def test_core_queries_without_a_library(hidden):
    done = subprocess.run([sys.executable, "-c", HIDE.format(hidden=hidden)], cwd=ROOT,
                          capture_output=True, text=True, timeout=300)
    n = len(catalog.QUERIES)
    assert f"FOUND {n} {n}" in done.stdout, done.stderr
