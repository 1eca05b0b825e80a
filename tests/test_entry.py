"""The entry file with and without the optional training-data operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in HIDDEN:
            raise ModuleNotFoundError(name)

HIDDEN = {hidden!r}
sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {root!r})
import __spark_entry__ as driver
from panelwright.plans.catalog import QUERIES
assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
if HIDDEN:
    assert set(driver.queries()) == set(QUERIES)
"""


@pytest.mark.parametrize("hidden", [["panelwright.llm"], ["corpus_pipeline"], ["xxhash"], ["panelwright.llm", "corpus_pipeline"], []])
def test_entry_without_optional_parts(hidden):
    subprocess.run([sys.executable, "-c", CODE.format(hidden=hidden, root=str(ROOT))], check=True, timeout=120)
