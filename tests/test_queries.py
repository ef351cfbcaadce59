"""Every registered query against its SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from lumenframe.catalog import ORACLE, QUERIES
from tests.compare import differences

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["prediction", "count", "mean_confidence"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert differences(spark, SF_DIR, QUERIES[name], ORACLE[name]) is None


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_without_the_optional_part(tmp_path, with_pipeline):
    root = Path(entry.__file__).parent
    shutil.copytree(root / "lumenframe", tmp_path / "lumenframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (with_pipeline and (root / "corpus_pipeline.py").exists()):
        shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert ran.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
