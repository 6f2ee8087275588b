"""Every registered query with SQL agrees with DuckDB; the others run."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from sparkurate import queries as curation

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/sf0.01/{name}.parquet'")
    return connection


def rows_of(frame, columns):
    return sorted(tuple(str(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(curation.SQL))
def test_agrees_with_sql(spark, duck, name):
    ours = curation.QUERIES[name](spark, f"{DATA}/sf0.01").toPandas()
    theirs = duck.sql(curation.SQL[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert rows_of(ours, columns) == rows_of(theirs, columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_stands_without_the_optional_parts(tmp_path):
    """The other queries are registered where the training-data operators aren't there."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "sparkurate", tmp_path / "sparkurate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(curation.QUERIES)), str(len(curation.SQL))]
