"""Training-data queries against their SQL twins on whole tables."""

import duckdb
import pytest

from propensio.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    cols = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    rows = [tuple(r) for r in got.select(*cols).collect()]
    assert len(rows) and sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)
