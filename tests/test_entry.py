"""The driver's entry with and without the part that can be taken out."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
LISTED = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder):
    out = subprocess.run(
        [sys.executable, "-B", "-c", LISTED], cwd=folder, capture_output=True, text=True, check=True
    )
    return json.loads(out.stdout.splitlines()[-1])


@pytest.fixture
def copy(tmp_path):
    for name in ("tripmill", "checks"):
        ignored = shutil.ignore_patterns("__pycache__", "llm")
        shutil.copytree(REPO / name, tmp_path / name, ignore=ignored)
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    return tmp_path


@pytest.mark.parametrize("left", ["nothing", "empty folder", "folder of caches", "broken import"])
def test_the_entry_works_without_the_other_part(copy, left):
    folder = copy / "tripmill" / "llm"
    if left != "nothing":
        folder.mkdir()
    if left == "folder of caches":
        (folder / "__pycache__").mkdir()
    if left == "broken import":
        (folder / "__init__.py").write_text("import no_such_library\n")
    queries, oracle = listed(copy)
    assert "mart_trasy" in queries and "mart_trasy" in oracle
    assert not [q for q in queries if q.startswith("op") or q == "pipeline"]
    assert set(oracle) <= set(queries)


def test_every_query_of_the_trip_part_has_sql():
    queries, oracle = listed(REPO)
    assert {q for q in queries if not q.startswith("op") and q != "pipeline"} <= set(oracle)
