"""The entry without the corpus part, or without what only that needs."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from ledgerfold.sources.workspace import shared_folder

ROOT = Path(__file__).resolve().parents[1]

IMPORT = """
import builtins, sys
real = builtins.__import__
def hide(name, *a, **b):
    if name.split(".")[0] == {hidden!r} or name == {hidden!r}:
        raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
    return real(name, *a, **b)
builtins.__import__ = hide
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
print(len(entry.balance_queries()) == len(entry.queries()), len(entry.oracle_sql()) == len(entry.queries()))
"""


def run(hidden):
    code = IMPORT.format(hidden=hidden, root=str(ROOT))
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=ROOT)


@pytest.mark.parametrize("hidden", ["corpus_pipeline", "public_tokenizers", "ledgerfold.llm"])
def test_other_queries_stay(hidden):
    found = run(hidden)
    assert found.stdout.split() == ["True", "True"], found.stderr


@pytest.mark.parametrize("name, left", [
    ("stored_snapshot_alerts", 1), ("segment_store_alerts", 1), ("segment_store_days", 1), ("rejected_values", 1),
    ("ingest_quarantine", 1), ("dq_stored_suite", 1), ("stored_descriptions", 0), ("dq_folder_suite", 2),
])
def test_what_a_query_stored_is_removed(spark, name, left):
    """Only the folder of its result stays, and what the suite sums up per organisation; no database does."""
    root = Path(re.sub("^file:/*", "/", shared_folder(spark))).parent
    folders = lambda: {p.name for p in root.glob("ledger*")}
    before, databases = folders(), {d.name for d in spark.catalog.listDatabases()}
    found = contract.balance_queries()[name](spark, "/root/testdata/sf0.001")
    assert found.count() and len(folders() - before) == left
    assert {d.name for d in spark.catalog.listDatabases()} == databases


def test_a_broken_library_is_an_error():
    assert "ModuleNotFoundError" in run("ledgerfold.operators").stderr
