"""The driver contract with and without the optional training-data operators."""

import os
import subprocess
import sys

import pytest

from daybook.plans import catalog, oracle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(blocked: str) -> tuple[list[str], str]:
    """Keys of queries() and oracle_sql() in a fresh interpreter that can't import ``blocked``."""
    code = f"""
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {blocked!r} or name.startswith({blocked!r} + "."):
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as e
print(",".join(e.queries()), ",".join(e.oracle_sql()))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True)
    queries, sql = done.stdout.strip().split(" ")
    assert set(sql.split(",")) <= set(queries.split(","))
    return queries.split(","), done.stderr


@pytest.mark.parametrize("blocked", ["daybook.llm", "corpus_pipeline", "public_tokenizers", "numpy"])
def test_reports_are_registered_whatever_the_operators_lack(blocked):
    queries, said = registered(blocked)
    assert queries == list(catalog.QUERIES) and blocked in said


def test_every_report_has_sql():
    assert set(oracle.all_sql()) == set(catalog.QUERIES)
