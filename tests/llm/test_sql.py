"""The queries' SQL against the queries themselves, on rows with nulls, empty texts, repeats and clashing columns."""

import duckdb
import pytest

from payscope.llm import queries
from tests.llm.test_operators import ITEM, ROWS, SCHEMA


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, tmp_path, name):
    items = [(1, ITEM), (20, "one"), (3, ""), (4, None), (None, "two words"), (7, "two words")]
    con = duckdb.connect()
    for table, df in (("documents", spark.createDataFrame(ROWS, SCHEMA)), ("benchmark", spark.createDataFrame(items, "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect()) and len(want) == len(ROWS)
