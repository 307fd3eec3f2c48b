"""The entry points import without a session, and without the training-data package."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; print('NAMES', *e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


def names(folder) -> set[str]:
    done = subprocess.run([sys.executable, "-B", "-c", LIST], cwd=folder, capture_output=True, text=True, check=True)
    return set(done.stdout.split("NAMES")[1].split())


@pytest.fixture(scope="module")
def bare(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bare")
    shutil.copy(REPO / "__spark_entry__.py", folder)
    shutil.copytree(REPO / "prodlake", folder / "prodlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return folder


def test_without_the_package(bare):
    found = names(bare)
    assert len(found) > 100 and not any(n.startswith("op") or n == "pipeline" for n in found)


def test_whole():
    if (REPO / "prodlake" / "llm").exists():
        found = names(REPO)
        assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in found if n == "pipeline" or n.startswith("op")}
