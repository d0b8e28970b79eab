"""Every registered query against its SQL counterpart in DuckDB, row for row."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from plumbline.plans.catalog import QUERIES
from plumbline.plans.oracles import ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


KINDS = {"long": "bigint", "integer": "integer", "string": "varchar", "double": "double", "boolean": "boolean"}


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    result = duck.execute(entry_points.oracle_sql()[name])
    described = [(column[0], str(column[1]).lower()) for column in result.description]
    expected = _sorted_rows([column for column, _ in described], result.fetchall())
    found = _sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])

    assert sorted(frame.columns) == sorted(column for column, _ in described)
    kinds = {field.name: KINDS[field.dataType.typeName()] for field in frame.schema}
    assert kinds == dict(described)
    assert len(found) == len(expected) > 0
    assert found == expected


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() == 953 + 793
