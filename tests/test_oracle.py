"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry_file
from clearplate.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    count, problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert not problem, problem


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["borough", "grade_a_pass_rate", "total_inspections"]
    assert df.count() == 6  # five regions, and the records without one


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLES) <= set(entry_file.oracle_sql())


def test_rest_stands_without_the_pipeline(tmp_path):
    """With both folders of the pipeline operators gone, the entry file still imports and names all other queries."""
    root = Path(entry_file.__file__).parent
    for name in ("clearplate", "tests"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for keep_pipeline in (True, False):
        shutil.copy(root / "__spark_entry__.py", tmp_path)
        if keep_pipeline:
            shutil.copy(root / "corpus_pipeline.py", tmp_path)
        else:
            (tmp_path / "corpus_pipeline.py").unlink()
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
        run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
        assert run.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"], run.stderr
