"""Invariants, plans and the whole job from a raw CSV."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from commerce_engine.operators import cleaning, customers, metrics, scenario, stats
from commerce_engine.pipeline import run
from commerce_engine.plans import analytics, views
from commerce_engine.plans.registry import CATEGORIES, QUERIES, REGIONS, SEGMENTS, state_codes
from commerce_engine.sources.extract import RAW_COLUMNS, raw_extract, read_raw_csv, read_typed_csv
from commerce_engine.sources.star import BASE_COLS
from tests.conftest import FOLDER


def test_shares_bands_and_running_totals(star):
    shares = [r.pct_of_sales for r in analytics.q06_category_performance(star).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.05)
    lines = star.lines("sales").count()
    assert sum(r.order_lines for r in analytics.q14_discount_impact(star).collect()) == lines
    yearly = {str(r.order_year): r.sales for r in analytics.q03_yearly_growth(star).collect()}
    last = {}
    for r in analytics.q15_monthly_running_total(star).collect():
        last[r.order_year] = r.running_total_ytd
    assert last == yearly


def test_total_row_equals_kpis(spark):
    total = [r for r in QUERIES["d05_region_table"](spark, FOLDER).collect() if r.region == "Total"][0]
    kpi = QUERIES["q01_executive_kpis"](spark, FOLDER).first()
    assert (total.sales, total.profit, total.orders, total.customers) == (
        kpi.total_sales, kpi.total_profit, kpi.total_orders, kpi.total_customers,
    )


def test_frame_sql_and_window_agree(spark, star):
    star.lines("sales", "profit", "order_id").createOrReplaceTempView("order_lines")
    sql = spark.sql("SELECT round(sum(sales), 2) s, round(sum(profit), 2) p, count(DISTINCT order_id) o FROM order_lines").first()
    kpi = analytics.q01_executive_kpis(star).first()
    assert (sql.s, sql.p, sql.o) == (kpi.total_sales, kpi.total_profit, kpi.total_orders)


def test_caps_are_monotone_and_the_loosest_changes_nothing(star):
    rows = scenario.discount_caps(star.lines("sales", "profit", "discount")).collect()
    assert rows[0].uplift == 0.0
    assert [r.profit for r in rows] == sorted(r.profit for r in rows)


def test_profile_has_one_row_per_customer(star):
    profile = customers.customer_profile(star.lines(*customers.PROFILE_INPUTS))
    assert profile.count() == profile.select("customer_id").distinct().count()
    assert profile.where(~F.col("rfm_score").between(3, 15)).count() == 0


@pytest.mark.parametrize("name", ["p02_p09_customer_profile", "q30_product_rank_within_category", "k24_five_numbers", "u09_dim_geography"])
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(str, QUERIES[name](spark, FOLDER).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "qud" and "profile" not in n))
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_read_only_what_is_asked(star):
    text = plan(analytics.q13_daily_sales_pattern(star))
    assert "l_tax" not in text.split("Physical Plan")[1]
    assert "customer.parquet" not in text and "part.parquet" not in text
    sliced = star.lines("order_date", "sales", "region").where(F.col("region") == "ASIA")
    assert "EqualTo(r_name,ASIA)" in plan(sliced)


@pytest.mark.parametrize(
    "name", ["b02_profit_margin", "b09_product_rank", "d03_category_share", "d04_top_products", "e02_category_table", "k32_category_shares", "q30_product_rank_within_category"]
)
def test_products_are_joined_to_totals_not_to_lines(spark, name):
    text = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [product_id" in text


def test_a_folder_of_files_gets_the_plan_of_one_file(spark, tmp_path):
    import re
    import shutil

    for f in ("orders", "lineitem", "customer", "nation", "region", "part"):
        target = tmp_path / f"{f}.parquet"
        target.mkdir()
        shutil.copy(f"{FOLDER}/{f}.parquet", target / "part-0.parquet")

    def shape(folder):
        text = QUERIES["q12_state_performance"](spark, str(folder))._jdf.queryExecution().sparkPlan().toString()
        return re.findall(r"\b(?:\w*Join|\w*Aggregate|Exchange|FileScan|Project|Filter|Repartition\w*)\b", text)

    assert shape(FOLDER) == shape(tmp_path)


def test_hot_keys_survive(spark):
    """One customer, one order and one product hold a third of all lines."""
    n = 3000
    hot = F.col("id") % 3 == 0
    lines = spark.range(n).select(
        F.when(hot, 0).otherwise(F.col("id")).alias("customer_id"),
        F.when(hot, "n0").otherwise(F.concat(F.lit("n"), "id")).alias("customer_name"),
        F.lit("s").alias("segment"),
        F.when(hot, 0).otherwise(F.col("id")).alias("order_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("order_date"),
        F.when(hot, 0).otherwise(F.col("id") % 50).alias("product_id"),
        F.lit(1).cast("decimal(18,2)").alias("sales"),
        F.lit(1).cast("decimal(18,2)").alias("profit"),
        F.lit(1).alias("quantity"),
        F.lit(0).cast("decimal(4,2)").alias("discount"),
    )
    profile = customers.customer_profile(lines)
    top = profile.orderBy(F.desc("lifetime_value")).first()
    assert (top.customer_id, top.lifetime_orders, float(top.lifetime_value)) == (0, 1, 1000.0)
    counts = {r.f_score: r["count"] for r in profile.groupBy("f_score").count().collect()}
    assert sum(counts.values()) == 2001 and max(counts.values()) - min(counts.values()) <= 1


@pytest.fixture(scope="module")
def job(spark, star, tmp_path_factory):
    """A Latin-1 CSV of the raw extract through every stage."""
    out = tmp_path_factory.mktemp("job")
    path = str(out / "raw.csv")
    rows = raw_extract(star).collect()
    with open(path, "w", encoding="latin-1", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(RAW_COLUMNS)
        for r in rows:
            name = r["Customer Name"]
            writer.writerow([("é" + name.strip() if c == "Customer Name" and name else r[c]) for c in RAW_COLUMNS])
    raw = read_raw_csv(spark, path)
    star_out = run(cleaning.clean(raw), str(out / "out"), ("United States", REGIONS, SEGMENTS, CATEGORIES), state_codes(star))
    return raw, star_out, out / "out"


def test_accents_survive_the_scan(job):
    raw, _, _ = job
    assert raw.where(F.col("`Customer Name`").startswith("é")).count() == raw.where("`Customer Name` is not null").count()


def test_star_reproduces_the_cleaned_totals(spark, job):
    _, star, out = job
    cleaned = spark.read.parquet(str(out / "cleaned"))
    want = cleaned.agg(F.round(F.sum("sales"), 2).alias("s"), F.count_distinct("order_id").alias("o")).first()
    kpi = analytics.q01_executive_kpis(star).first()
    assert (kpi.total_sales, kpi.total_orders) == (want.s, want.o)
    assert star.table("fact_sales").count() == cleaned.count()
    assert star.table("fact_sales").where("geo_id is null").count() == 0
    assert [r.region for r in analytics.q11_region_performance(star).collect()]
    assert views.regional_summary(star).count() > 0


def test_job_writes_every_output(job):
    _, _, out = job
    names = {p.name for p in (out / "questions").iterdir()}
    assert len(names) == 30
    assert len({p.name for p in (out / "exports").iterdir()}) == 14
    document = next((out / "dashboard").glob("part-*")).read_text()
    assert json.loads(document)["totals"][0] == "Total"
    years = {p.name for p in (out / "star" / "fact_sales").iterdir() if p.is_dir()}
    assert "order_year=1996" in years


def test_views_answer_sql(spark, job):
    names = ["vw_sales_detail", "vw_monthly_summary", "vw_product_performance", "vw_regional_summary", "vw_discount_analysis"]
    totals = {n: spark.sql(f"SELECT sum(sales) AS s FROM {n}").first().s for n in names}
    assert len({round(float(v), 2) for v in totals.values()}) == 1
    assert spark.sql("SELECT count(*) AS n FROM vw_customer_360").first().n == 150


def test_typed_csv_keeps_codes_as_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("order_date,postal_code,sales\n2018-11-08,01810,2.50\n2018-11-09,,3.00\n")
    got = read_typed_csv(spark, str(tmp_path / "t.csv"), "order_date date, postal_code string, sales decimal(18,2)")
    assert [str(r.order_date) + "|" + str(r.postal_code) for r in got.collect()] == ["2018-11-08|01810", "2018-11-09|None"]


def test_approximate_counts_are_close(star):
    lines = star.lines("order_id", "customer_id")
    exact = metrics.measure(lines, ["total_orders", "total_customers"]).first()
    near = metrics.measure(lines, ["total_orders", "total_customers"], approx=True).first()
    assert near.total_orders == pytest.approx(exact.total_orders, rel=0.06)
    assert near.total_customers == pytest.approx(exact.total_customers, rel=0.06)


def test_order_tables_and_written_star_agree(spark, star, tmp_path):
    from commerce_engine.pipeline import build_features, build_star

    base = star.base_lines(*BASE_COLS)
    profile = customers.customer_profile(base)
    written = build_star(build_features(base, profile), profile, str(tmp_path))
    for ask in (analytics.q09_customer_segments, analytics.q12_state_performance, analytics.q26_shipping_mode_analysis):
        assert sorted(map(str, ask(written).collect())) == sorted(map(str, ask(star).collect()))
    assert stats.agg_state(written.lines("state", "sales", "profit")).count() == 25
