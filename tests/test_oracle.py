"""Every registered query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SQL = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


SAME_TYPE = {("int", "INTEGER"), ("bigint", "BIGINT"), ("double", "DOUBLE"), ("string", "VARCHAR"),
             ("boolean", "BOOLEAN")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    got = sdf.toPandas()
    exp = con.execute(SQL[name]).df()
    assert _rows(got) == _rows(exp)
    rel = con.sql(SQL[name])
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert all((t, duck.get(c)) in SAME_TYPE for c, t in sdf.dtypes), [(c, t, duck.get(c)) for c, t in sdf.dtypes]


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "part_number" in df.columns


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL)))
def test_queries_without_oracle_run(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
