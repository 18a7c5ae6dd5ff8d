"""Every registered query against its SQL, on the smallest tables; the library without the training-data operators."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from brevetlake.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def value(x):
    if x is None:
        return "null"
    if isinstance(x, float):
        return "null" if x != x else repr(round(x, 6))
    return str(x)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    df = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted(tuple(value(r[c]) for c in columns) for r in df.collect())
    if name not in catalogue.ORACLES:
        assert found
        return
    result = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(value(dict(zip(names, r, strict=True))[c]) for c in columns) for r in result.fetchall())
    assert found == want


def test_entry(spark):
    assert not __spark_entry__.entry(spark).isEmpty()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_library_stands_alone(tmp_path):
    """Without the folders of the training-data operators all other queries are still there."""
    repo = Path(__file__).parent.parent
    for item in repo.iterdir():
        if item.name in ("__spark_entry__.py", "bench.py"):
            (tmp_path / item.name).symlink_to(item)
    package = tmp_path / "brevetlake"
    package.mkdir()
    for item in (repo / "brevetlake").iterdir():
        if item.name not in ("llm", "__pycache__"):
            (package / item.name).symlink_to(item)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(catalogue.QUERIES)), "False"]
