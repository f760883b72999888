"""The entry module: every query with SQL agrees with DuckDB; it imports without the corpus subpackage."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans.queries import ORACLE_SQL, QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "as_integer_ratio"):
        return float(f"{float(v):.9g}")
    return str(v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v) if v is not None else None


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_agrees_with_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    told = duck.sql(ORACLE_SQL[name])
    assert sorted(told.columns) == cols
    at = [told.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in told.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_imports_without_corpus_parts():
    code = "import sys; sys.modules['tidemark.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not any(q.startswith('op') or q == 'pipeline' for q in e.queries()); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)
