"""Every registered query against its SQL counterpart on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from lakesieve.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_answer(spark, oracle, small, key):
    df = contract.queries()[key](spark, small)
    columns = sorted(df.columns)
    got = _sorted(df.select(*columns).collect())
    result = oracle.execute(contract.oracle_sql()[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = _sorted(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert got == expected


def test_entry(spark):
    card = contract.entry(spark)
    assert card.count() == 3
    assert len(card.columns) == 17
