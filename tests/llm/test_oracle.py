import duckdb
import pytest

from verdant.llm.queries import LLM_ORACLE, LLM_QUERIES

D = "/root/testdata/sf0.01"
TABLES = ["documents", "benchmark", "pages", "embeddings"]


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{D}/{t}.parquet')")
    got = LLM_QUERIES[name](spark, D)
    want = con.execute(LLM_ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(columns, want.fetchall())
