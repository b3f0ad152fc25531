"""Every registered driver query against its DuckDB oracle (small scale factor)."""

import os

import pytest

from blendwise.plans import registry
from blendwise.plans.checks import compare

SF_DIR = os.environ.get("BLENDWISE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = registry.queries()
SQL = registry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    result = compare(spark, df, SQL[name], SF_DIR)
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["match"], result


def test_entry_smoke(spark):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["channel", "campaign_name", "date", "date_granularity"]


_DUCK_TO_SPARK = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                  "INTEGER": "int", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from blendwise.plans.checks import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    spark_types = {f.name: f.dataType.simpleString() for f in QUERIES[name](spark, SF_DIR).schema.fields}
    duck_types = {r[0]: _DUCK_TO_SPARK.get(r[1], r[1]) for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert spark_types == duck_types
