"""Every registered query with oracle SQL equals DuckDB on the same tables."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL
from .oracle_compare import compare_frames, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


# Spark type → DuckDB type of the same column
FAMILY = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    sql = E.oracle_sql()[name]
    spark_types = {f.name: FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    oracle_types = {d[0]: str(d[1]) for d in con.execute(sql).description}
    assert spark_types == oracle_types
    ok, msg = compare_frames(df.toPandas(), con.execute(sql).df())
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 70
    assert "playoffs" in df.columns
