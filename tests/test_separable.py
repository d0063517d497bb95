"""The entry module without the training-data part, and with a package of that part missing."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from lakeloom import queries as registry

registry.load_all()

ROOT = Path(__file__).resolve().parent.parent
NAMES = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries()), '/', *sorted(e.oracle_sql()))"


def names(root, before=""):
    made = subprocess.run(
        [sys.executable, "-B", "-c", before + NAMES], cwd=root, capture_output=True, text=True, timeout=300
    )
    assert made.returncode == 0, made.stderr
    queries, sql = made.stdout.rpartition("NAMES")[2].split("/")
    return set(queries.split()), set(sql.split())


@pytest.fixture
def rest(tmp_path):
    """A copy of the library without the part."""
    root = tmp_path / "rest"
    shutil.copytree(ROOT / "lakeloom", root / "lakeloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", root)
    return root


def test_without_the_part(rest):
    assert names(rest) == (set(registry.QUERIES), set(registry.ORACLES))


def test_without_the_folder_alone(rest):
    if (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", rest)
    assert names(rest) == (set(registry.QUERIES), set(registry.ORACLES))


def test_without_a_package_of_the_part():
    block = "import sys; sys.modules['sentencepiece'] = None; sys.modules['zstandard'] = None; "
    assert names(ROOT, block) == (set(registry.QUERIES), set(registry.ORACLES))


def test_other_folders_do_not_import_the_part():
    for file in (ROOT / "lakeloom").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "lakeloom.llm" not in file.read_text()
