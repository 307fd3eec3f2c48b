"""Every registered query against its DuckDB SQL on the small tables; those without SQL must run."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from prodlake.plans import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def oracle(small):
    db = duckdb.connect()
    db.sql("set timezone = 'UTC'")
    for path in Path(small).iterdir():
        files = f"{path}/*.parquet" if path.is_dir() else str(path)
        db.sql(f"create view {path.stem} as select * from read_parquet('{files}')")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, oracle, name):
    df = QUERIES[name](spark, small)
    rows = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name in ORACLE_SQL:
        found = oracle.sql(ORACLE_SQL[name])
        places = sorted(range(len(found.columns)), key=lambda k: found.columns[k])
        assert sorted(found.columns) == sorted(df.columns)
        want = [tuple(plain(r[k]) for k in places) for r in found.fetchall()]
        assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert len(entry.entry(spark).columns) > 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
