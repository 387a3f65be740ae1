"""Every query against its DuckDB statement, value for value."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry
from oracle.statements import STATEMENTS
from tests.parity import differences, duck
from tidemark.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_each_query_has_a_statement():
    assert set(STATEMENTS) == set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns and df.limit(1).count() == 1


def test_core_queries_stay_where_a_library_of_the_optional_part_is_missing():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(QUERIES))] * 2, done.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_statement(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(STATEMENTS[name]).df()
    assert len(got) > 0
    assert not differences(got, want)
