"""The entry module with and without its optional part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
OPTIONAL = ("shelfmark/llm", "corpus_pipeline.py")


def names(folder: Path) -> list[str]:
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(*e.queries())"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, check=True)
    return said.stdout.split()


@pytest.mark.parametrize("left_out", [OPTIONAL, OPTIONAL[:1]], ids=["both", "folder only"])
def test_entry_works_without_the_optional_part(tmp_path, left_out):
    skipped = {str(ROOT / name) for name in left_out}

    def ignore(folder: str, entries: list[str]) -> list[str]:
        return [e for e in entries if e in (".git", "__pycache__") or f"{folder}/{e}" in skipped]

    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    found = names(tmp_path / "copy")
    assert "dataset_vendas" in found and "pipeline" not in found
    assert not [name for name in found if name.startswith("op")]
