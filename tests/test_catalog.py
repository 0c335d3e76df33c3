"""Every registered query against DuckDB on the same tables."""

import datetime
import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.datetime):
        assert value.tzinfo is None
    return repr(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    ours = table(result.columns, result.collect())
    assert ours[1]
    theirs = duck.execute(ORACLES[name])
    assert ours == table([c[0] for c in theirs.description], theirs.fetchall())


def test_entry(spark):
    assert contract.entry(spark).columns == ["asset_id", "win_start", "cnt", "pw_1m", "prod_delta", "wind_avg"]


@pytest.mark.parametrize("library", ["tiktoken", "xxhash", "public_tokenizers", "corpus_pipeline", "tidemark.llm"])
def test_the_engine_works_without_an_extra(library):
    """A library that only the operators on training data need may be absent."""
    code = f"import sys; sys.modules[{library!r}] = None; import __spark_entry__ as e; print(*sorted(e.queries()))"
    folder = os.path.dirname(os.path.abspath(contract.__file__))
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()
    assert set(catalog.QUERIES) <= set(out) and "pipeline" not in out
