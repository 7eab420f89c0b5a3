"""The driver's entry with and without the optional package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries(), 'align_quality' in e.queries())"


def copy(to, *without):
    shutil.copytree(REPO, to, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *without))
    return to


def ask(folder, code=ASK):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=False)


@pytest.mark.parametrize("without", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_optional_package(tmp_path, without):
    found = ask(copy(tmp_path / "copy", *without))
    assert found.returncode == 0, found.stderr
    number, oracles, pipeline, flagship = found.stdout.split()
    assert number == oracles and int(number) >= 105 and (pipeline, flagship) == ("False", "True")


def test_an_empty_folder_counts_as_gone(tmp_path):
    folder = copy(tmp_path / "copy", "llm")
    (folder / "kinetable" / "llm" / "__pycache__").mkdir(parents=True)
    assert ask(folder).stdout.split()[2:] == ["False", "True"]


@pytest.mark.skipif(not (REPO / "kinetable" / "llm" / "__init__.py").exists(), reason="the optional package is not there")
def test_a_broken_optional_package_is_an_error(tmp_path):
    folder = copy(tmp_path / "copy")
    (folder / "kinetable" / "llm" / "queries.py").write_text("import kinetable.llm.nowhere\n")
    assert "kinetable.llm.nowhere" in ask(folder).stderr
    (folder / "kinetable" / "llm" / "queries.py").write_text("import no_such_library\n")
    assert "no_such_library" in ask(folder).stderr
