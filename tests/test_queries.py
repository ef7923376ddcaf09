"""Every query with a SQL twin returns the twin's rows; the registration is complete."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
from tests.conftest import TEST_DATA

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(TEST_DATA):
        pytest.skip("the test tables are not here")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TEST_DATA}/{t}.parquet'")
    return connection


def assert_same_rows(left: pd.DataFrame, right: pd.DataFrame) -> None:
    """Equal as multisets of rows; floats to ten significant digits."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns) and len(left) == len(right)

    # A column of whole numbers with gaps arrives as floats from one engine only.
    numeric = [c for c in columns if "f" in left[c].dtype.kind + right[c].dtype.kind]

    def ordered(table: pd.DataFrame) -> pd.DataFrame:
        table = table[columns].copy()
        for c in numeric:
            table[c] = table[c].astype(float).round(9) + 0.0
        return table.sort_values(sorted(columns, key=numeric.__contains__), na_position="first", ignore_index=True)

    left, right = ordered(left), ordered(right)
    for c in columns:
        if c in numeric:
            assert np.allclose(left[c], right[c], rtol=1e-10, atol=1e-9, equal_nan=True), c
        else:
            assert (left[c].fillna("<null>") == right[c].fillna("<null>")).all(), c


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_twin(spark, duck, name):
    df = contract.queries()[name](spark, TEST_DATA)
    answer = duck.execute(contract.oracle_sql()[name])
    described = answer.description
    assert {c: KINDS[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in described}
    assert_same_rows(df.toPandas(), answer.df())


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
