"""The package's queries against their SQL oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from hirelens.llm.queries import QUERIES
from hirelens.sources.tables import table_path
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of, type_mismatches


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_query_matches_oracle(spark, name):
    build, sql = QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')").fetchall()
    df = build(spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert not type_mismatches(df.schema, cols, [str(d[1]) for d in res.description])
    assert rows and rows_of(df.columns, rows) == rows_of(cols, res.fetchall())
