"""The entry point without the optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(sum(n.startswith('q') for n in e.queries()), *[n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"


@pytest.mark.parametrize("absent", [("tidewake/llm", "tests/llm", "corpus_pipeline.py"), ("tidewake/llm", "tests/llm"), ("corpus_pipeline.py",)])
def test_import_without_optional_parts(tmp_path, absent):
    gone = {str(ROOT / name) for name in (*absent, ".git")}
    shutil.copytree(ROOT, tmp_path / "repo", ignore=lambda folder, names: [n for n in names if f"{folder}/{n}" in gone])
    done = subprocess.run([sys.executable, "-B", "-c", NAMES], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    found = done.stdout.split()
    assert int(found[0]) > 20
    assert "pipeline" not in found
    assert ("op1_line_dedup" in found) == ("tidewake/llm" not in absent)
