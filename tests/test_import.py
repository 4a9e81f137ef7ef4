"""The entry works without the part for training data, or without a module that only it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
HIDE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
from gleanset.plans.catalog import all_queries
assert set(entry.queries()) == set(all_queries())
assert set(entry.oracle_sql()) == set(all_queries())
"""


@pytest.mark.parametrize("name", ["ahocorasick", "regex", "public_tokenizers", "corpus_pipeline", "gleanset.llm"])
def test_a_missing_module_costs_only_what_needs_it(name):
    subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, check=True, timeout=120)
