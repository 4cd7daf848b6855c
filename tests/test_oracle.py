"""Every registered query against its SQL, and the contract of the entry file."""

import re

import compare
import pytest

import __spark_entry__ as entry_file

# The queries over training data have their tests in a folder of their own.
OWN = re.compile(r"(?!op\d+_|pipeline$)")
QUERIES = {k: v for k, v in entry_file.queries().items() if OWN.match(k)}
ORACLES = {k: v for k, v in entry_file.oracle_sql().items() if OWN.match(k)}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert compare.spark_types(frame) == compare.sql_types(con, ORACLES[name])
    columns, rows = compare.spark_rows(frame)
    want_columns, want_rows = compare.sql_rows(con, ORACLES[name])
    assert columns == want_columns
    assert len(rows) == len(want_rows) > 0
    assert rows == want_rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_gives_rows(spark):
    assert entry_file.entry(spark).count() > 0
