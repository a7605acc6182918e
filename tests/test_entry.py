"""The entry points without what only the operators on training text need."""

import os
import subprocess
import sys

import pytest

from checks.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "pairloom.llm", "corpus_pipeline"])
def test_other_queries_stay(name):
    said = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, text=True,
                          capture_output=True, timeout=120, check=True)
    assert said.stdout.split() == [*[str(len(QUERIES))] * 2, "False"]
    assert "left out" in said.stderr
