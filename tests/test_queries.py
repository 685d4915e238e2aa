"""Every registered query against its SQL in DuckDB, and the entry module with and without what may be deleted."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    con = duck.execute(SQL[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted((tuple(r) for r in con.fetchall()), key=repr)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == want


def test_every_core_query_has_sql():
    from trailmark.plans.queries import ORACLE_SQL, QUERIES

    assert set(ORACLE_SQL) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_the_subpackage(tmp_path):
    """In a copy without what may be deleted."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'resolved' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) == set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "trailmark").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "trailmark.llm" not in p.read_text()
