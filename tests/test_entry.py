"""The entry module where a package of the training operators is missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "regex", "corpus_pipeline"])
def test_sync_queries_stay(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as E; from ferry.plans import catalog; "
            "assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env={**os.environ, "PYTHONPATH": ROOT})
