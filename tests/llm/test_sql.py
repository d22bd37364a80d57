"""The corpus queries that have SQL give the rows that DuckDB gives, at the scale factor of the correctness run."""

import duckdb
import pytest

from stratiform.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(name, spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, got.select(names).toPandas().itertuples(index=False, name=None))) == sorted(map(repr, want.df().itertuples(index=False, name=None)))
