"""The entry without the operators for training data, or without a library that only they need."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

from checks import ORACLES, QUERIES

ROOT = Path(__file__).parents[1]


def names(blocked: str) -> tuple[set[str], set[str]]:
    code = (
        f"import sys; sys.modules['{blocked}'] = None; import __spark_entry__ as e;"
        " print(*e.queries()); print(*e.oracle_sql())"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    queries, sqls = done.stdout.splitlines()
    return set(queries.split()), set(sqls.split())


def test_a_missing_library_leaves_all_other_queries():
    assert names("xxhash") == (set(QUERIES), set(ORACLES))


def test_a_missing_subpackage_leaves_all_other_queries():
    assert names("sparkmart.llm") == (set(QUERIES), set(ORACLES))
