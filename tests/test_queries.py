"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, rows_of

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got, columns = rows_of(df.columns, df.collect())
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        want, wanted_columns = rows_of([d[0] for d in result.description], result.fetchall())
        assert columns == wanted_columns
        assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "lowest_price" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_python_functions_reach_workers_from_any_folder(tmp_path):
    """Workers must not need the package on their own path."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        f"print('rows', [e.queries()[q](spark, {SF_DIR!r}).count() for q in ('fn28_deep_key_search', 'udf6_similarity')])\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows [" in done.stdout, done.stderr[-2000:]
