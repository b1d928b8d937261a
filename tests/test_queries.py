"""Every query with SQL agrees with DuckDB on the smallest tables, and the library stands without its llm part."""

import os
import shutil
import subprocess
import sys

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"


def frame(df):
    df = df[sorted(df.columns)].copy()
    for c in df:
        if df[c].dtype == object or str(df[c].dtype).startswith(("datetime", "str")):
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else str(v).removesuffix(" 00:00:00"))
        else:
            df[c] = pd.to_numeric(df[c]).astype(float).round(5)
    return df.sort_values(list(df.columns), ignore_index=True)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_its_sql(spark, con, name):
    pd.testing.assert_frame_equal(frame(registry.queries()[name](spark, SF).toPandas()), frame(con.sql(registry.oracle_sql()[name]).df()), check_dtype=False, atol=2e-5)


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_query_without_sql_has_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_the_library_stands_without_the_corpus_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rate' in q and not any(n.startswith('op') and n[2:3].isdigit() for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
