"""The entry points with and without the folder of the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(n.startswith('op') and n[2].isdigit() for n in e.queries()))"


def counted(folder, before=""):
    code = f"import sys; sys.path.insert(0, {str(folder)!r}); {before}\n{COUNT}"
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True, check=True)
    return tuple(map(int, out.stdout.split()))


@pytest.fixture()
def copy(tmp_path):
    keep = shutil.ignore_patterns("llm", "__pycache__", "corpus_pipeline.py")
    for name in ("curbflow", "workload"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=keep)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    return tmp_path


def test_absent_or_empty_folder_leaves_the_other_queries(copy):
    bare = counted(copy)
    assert bare[0] >= 60 and bare[2] == 0
    (copy / "curbflow" / "llm" / "__pycache__").mkdir(parents=True)
    assert counted(copy) == bare


def test_a_lacking_library_leaves_the_other_queries(copy):
    bare = counted(copy)
    (copy / "curbflow" / "llm").mkdir()
    (copy / "curbflow" / "llm" / "__init__.py").write_text("import a_library_that_is_not_there\n")
    assert counted(copy) == bare
