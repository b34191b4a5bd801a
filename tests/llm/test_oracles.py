"""Every training-data query that has SQL, against that SQL in DuckDB, row by row."""

import glob
import os

import duckdb
import pytest

from cinderframe.llm.oracle import ORACLE
from cinderframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    return float(f"{value:.9g}") if isinstance(value, float) else value


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    found = QUERIES[name](spark, SF)
    with duckdb.connect() as db:
        for path in glob.glob(f"{SF}/*.parquet"):
            table = os.path.basename(path).removesuffix(".parquet")
            db.execute(f"create view {table} as select * from read_parquet('{path}')")
        result = db.execute(ORACLE[name])
        columns = [d[0] for d in result.description]
        want = result.fetchall()
    assert sorted(columns) == sorted(found.columns)
    assert rows(map(tuple, found.collect()), found.columns) == rows(want, columns)
