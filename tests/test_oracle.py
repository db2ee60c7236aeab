"""Every query against its SQL, and the queries without SQL against brute force."""

import json

import duckdb
import pytest

from check import TABLES, canonical
from commerce_engine.plans.registry import QUERIES
from oracle import ORACLE
from tests.conftest import FOLDER

WITHOUT_SQL = {"s09_dashboard_payload"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_is_covered():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canonical(df.columns, [tuple(r) for r in df.collect()], 0) == canonical(cols, cur.fetchall(), 0)


def test_scatter_sample_is_repeatable_and_without_replacement(spark, star):
    from commerce_engine.operators.stats import scatter_sample

    lines = star.lines("row_id", "discount", "profit")
    first = [r.row_id for r in scatter_sample(lines).collect()]
    again = [r.row_id for r in scatter_sample(lines.repartition(13)).collect()]
    everyone = [r.row_id for r in lines.select("row_id").collect()]
    assert first == again and len(first) == 3000
    assert all(first.count(x) <= everyone.count(x) for x in set(first))
    assert sorted(r.row_id for r in scatter_sample(lines, size=10**6).collect()) == sorted(everyone)


def test_payload_holds_the_dashboard_tables(spark):
    doc = json.loads(QUERIES["s09_dashboard_payload"](spark, FOLDER).first().payload)

    def rows(name):
        return [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]

    assert doc["topProducts"] == rows("d04_top_products")
    assert doc["topCustomers"] == rows("d04_top_customers")
    assert doc["subCategory"] == rows("d04_top_sub_categories")
    assert [k["delta_pct"] for k in doc["kpis"]] == [k["delta_pct"] for k in sorted(rows("d01_kpi_cards"), key=lambda k: k["place"])]
    assert [m["sales"] for m in doc["months"]] == [m["sales"] for m in sorted(rows("d02_calendar_months"), key=lambda m: m["order_month"])]
    assert doc["regions"] == [r for r in rows("d05_region_table") if r["region"] != "Total"]
    assert len(doc["states"]) == 25 and doc["totals"][0] == "Total"
