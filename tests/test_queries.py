"""Every query with SQL against DuckDB over the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from keystrata.plans import oracle
from keystrata.plans import queries as plans

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps"


def connection():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    return [plain(i) for i in x] if isinstance(x, list) else x


def same(df, con, sql):
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    want = [[plain(r[names.index(c)]) for c in sorted(names)] for r in got.fetchall()]
    have = [[plain(r[c]) for c in sorted(names)] for r in df.collect()]
    assert sorted(map(str, have)) == sorted(map(str, want))


@pytest.mark.parametrize("name", list(plans.queries()))
def test_query(spark, name):
    same(plans.queries()[name](spark, FOLDER), connection(), oracle.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
