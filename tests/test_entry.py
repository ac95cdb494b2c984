"""The entry module with the training-data operators taken out or unable to load."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from suite import QUERIES

REPO = Path(__file__).resolve().parent.parent
LIST = "import json, __spark_entry__ as e; print(json.dumps(sorted(e.queries()))); assert set(e.oracle_sql()) <= set(e.queries())"


def copied(to: Path) -> Path:
    for name in ("contractflow", "suite", "contracts"):
        shutil.copytree(REPO / name, to / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(REPO / "__spark_entry__.py", to)
    return to


def listed(where: Path) -> list[str]:
    env = os.environ | {"PYTHONPATH": str(where), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", LIST], cwd=where, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("left", ["nothing", "the pipeline", "an empty folder", "a folder that cannot load"])
def test_core_queries_stand_alone(tmp_path, left):
    where = copied(tmp_path)
    if left == "the pipeline":
        (where / "corpus_pipeline.py").write_text("from contractflow.llm.store import written\n")
    if left == "an empty folder":
        (where / "contractflow/llm/__pycache__").mkdir(parents=True)
    if left == "a folder that cannot load":
        (where / "contractflow/llm").mkdir()
        (where / "contractflow/llm/queries.py").write_text("import a_library_that_is_not_there\n")
    assert listed(where) == sorted(QUERIES)
