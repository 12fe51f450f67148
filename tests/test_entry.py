"""The entry points and every registered query at the smallest scale."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry_module
import pytest

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry_module.queries())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert {r["dataset"] for r in rows} == {"SGD", "CCPE"}


def test_oracles_belong_to_queries():
    assert set(entry_module.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_duckdb(spark, name):
    import duckdb

    from tools.check import TABLES, rows_of

    df = entry_module.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, result.fetchall())


def test_import_without_the_optional_folders(tmp_path):
    """An export without the training-data operators has all other queries."""
    root = os.path.dirname(os.path.abspath(entry_module.__file__))
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.parquet", ".pytest_cache")
    shutil.copytree(root, tmp_path / "export", ignore=left_out)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') or q == 'pipeline' for q in e.queries()))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path / "export")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "export", env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    count, optional = out.stdout.split()[-2:]
    assert optional == "False"
    assert int(count) == len([n for n in NAMES if not n.startswith("op") and n != "pipeline"])
