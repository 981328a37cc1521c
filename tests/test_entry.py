"""The entry module without the training-data operators, or without a module that they need."""

import subprocess
import sys
from pathlib import Path

import pytest

from autostrata.workload.queries import QUERIES


@pytest.mark.parametrize("absent", ["zstandard", "numpy", "autostrata.llm", "corpus_pipeline"])
def test_library_queries_stay(absent):
    code = (
        f"import sys; sys.modules[{absent!r}] = None\n"
        "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql().keys() <= e.queries().keys()"
    )
    root = str(Path(__file__).parents[1])
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == list(QUERIES)
