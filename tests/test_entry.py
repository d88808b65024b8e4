import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def loaded(folder, code):
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.fixture
def copy(tmp_path):
    for name in ("tidewater", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(REPO, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    return tmp_path


def test_the_entry_works_without_the_training_data_operators(copy):
    shutil.rmtree(copy / "tidewater" / "llm", ignore_errors=True)
    if (copy / "corpus_pipeline.py").exists():
        (copy / "corpus_pipeline.py").unlink()
    got = loaded(copy, "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op1') for k in e.queries()))")
    assert got.returncode == 0, got.stderr
    queries, sql, has = got.stdout.split()
    assert int(queries) > 100 and int(sql) > 100 and has == "False"


def test_a_broken_operator_is_not_hidden(copy):
    if not (copy / "corpus_pipeline.py").exists():
        pytest.skip("no training-data operators here")
    (copy / "tidewater" / "llm" / "queries.py").write_text("import nowhere_to_be_found\n")
    got = loaded(copy, "import __spark_entry__ as e; e.queries()")
    assert got.returncode != 0 and "nowhere_to_be_found" in got.stderr
