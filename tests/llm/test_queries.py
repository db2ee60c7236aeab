"""Registered queries: contract columns, and SQL where there is one."""

from __future__ import annotations

import duckdb

import __spark_entry__ as entry
from commerce_engine.llm import queries

FOLDER = "/root/testdata/sf0.01"


def test_all_are_registered():
    names = [n.split("_")[0] for n in entry.queries() if n in queries.QUERIES]
    assert names == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry.queries()


def test_mixing_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.execute(queries.MIXING_SQL).fetchall()
    got = queries.op4_mixing(spark, FOLDER)
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, got.collect())) == sorted(want)
