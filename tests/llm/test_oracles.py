import duckdb
import pytest

import __spark_entry__ as E
from locus.llm import queries as llm

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    assert {*llm.queries(), "pipeline"} <= set(E.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in llm.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    got = llm.queries()[name](spark, SF)
    found = con.execute(llm.oracle_sql()[name])
    cols = [c[0] for c in found.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted(found.fetchall(), key=repr)
