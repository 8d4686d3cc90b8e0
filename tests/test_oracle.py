"""Every query with SQL: same columns, rows and values from Spark and DuckDB."""

import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
UNORDERED_NULL = (0, "")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def _sortable(row):
    return tuple(UNORDERED_NULL if v is None else (1, str(v)) for v in row)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_sortable)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == {"demand_model"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    want_names, want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got_names == want_names
    assert len(got) == len(want)
    assert len(want) > 0
    assert all(type(a) is type(b) or a is None or b is None for r, s in zip(got, want) for a, b in zip(r, s))
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_model_queries_give_finite_rows(spark, sf_dir, name):
    rows = queries()[name](spark, sf_dir).collect()
    assert rows
    for row in rows:
        assert all(math.isfinite(v) for v in row if isinstance(v, float))
