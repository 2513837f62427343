"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ledgerline.plans.catalog import ORACLE, QUERIES
from parity import digest, duck

NAMES = sorted(QUERIES)
TYPES = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
         "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP", "FloatType()": "FLOAT",
         "BooleanType()": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {f.name: TYPES.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    duck_types = dict(zip(dcols, [str(t) for t in con.sql(E.oracle_sql()[name]).types]))
    assert spark_types == duck_types
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["CustomerID", "Age", "CorrectedAge", "Gender", "AgeCategory", "Rank"]
