"""Every registered query with an oracle matches its DuckDB twin on the small fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
SLOW = {"m2_gbt_forecast"}
SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    cols = sorted(sdf.columns)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    spark_types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in sdf.schema.fields}
    assert spark_types == duck_types
    s = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    d = sorted((tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall()), key=repr)
    assert s == d


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF0001).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "y_next" in df.columns
