"""Fingerprints, mergeable moments, sketches, running totals, pruning, quarantine and the plans of them."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from commerce_engine import pipeline
from commerce_engine.functions import dates
from commerce_engine.functions import fingerprint as fp
from commerce_engine.functions import moments
from commerce_engine.functions.columns import mean
from commerce_engine.functions.dates import read_date, unreadable
from commerce_engine.functions.quantiles import exact_quantiles
from commerce_engine.operators import cleaning, customers, features, metrics, quality, rollup, warehouse
from commerce_engine.plans import registry
from commerce_engine.sources.extract import RAW_COLUMNS, raw_extract, read_raw_csv
from commerce_engine.sources.star import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ cleaning
def test_fingerprints_tell_nulls_and_places_apart(spark):
    rows = [("a", None), (None, "a"), ("a", "a"), (None, None), ("", None), ("a", "")]
    df = spark.createDataFrame(rows, "x string, y string").withColumns(fp.fingerprint(["x", "y"]))
    assert df.select(*fp.FINGERPRINT).distinct().count() == len(rows)


def test_the_extract_is_read_once_and_nothing_is_sorted_to_aggregate(spark, star):
    work = cleaning.Cleaning(raw_extract(star))
    for df in (work.cleaned(), work.audit(), cleaning.drop_duplicates(cleaning.prepare(raw_extract(star)))):
        assert "SortAggregate" not in plan(df)
    assert "lineitem" not in plan(work.cleaned()) and "lineitem" not in plan(work.audit())


def test_observed_audit_equals_the_counted_one(spark, star, tmp_path):
    work = cleaning.Cleaning(raw_extract(star))
    rows, kept = work.observed()
    rows.write.parquet(str(tmp_path / "cleaned"))
    assert work.audit(kept).collect() == work.audit().collect() == cleaning.cleaning_audit(raw_extract(star)).collect()


def test_many_copies_and_rows_that_differ_in_one_value(spark):
    cols = [c.lower().replace(" ", "_").replace("-", "_") for c in RAW_COLUMNS]
    base = dict.fromkeys(cols, "1") | {"row_id": "7"}
    rows = [base | {"row_id": str(i)} for i in range(500, 3, -1)] + [base | {c: "2", "row_id": "0"} for c in cols[1:]] + [base | {c: None, "row_id": "x"} for c in cols[6:]]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols)).repartition(7)
    kept = cleaning.drop_duplicates(df).collect()
    # Row ids that are numbers are compared as numbers: 4 comes before 10.
    assert len(kept) == 1 + len(cols[1:]) + len(cols[6:]) and sum(r.row_id == "4" for r in kept) == 1


def test_dates_of_every_class(spark):
    day = dt.date(2018, 11, 8)
    good = [
        "2018-11-08", "2018/11/8", "2018.11.08", "11/8/2018", "11-8-2018", "11.08.2018", "Nov 8, 2018", "November 8th, 2018", "8-Nov-2018",
        "8 November 2018", "08nov2018", "20181108", "2018 Nov 8", "Thursday, November 8, 2018", "Thu 8 Nov 2018", "2018-11-08 13:45", "2018-11-08T13:45:59.123Z",
        "2018-11-08 13:45:59+01:00", "11/8/2018 1:45 PM", "11/8/18", "Nov 8 18", "8-Nov-18", " 11/8/2018 ", "Sept 8 2018",
    ]
    want = [day] * (len(good) - 1) + [dt.date(2018, 9, 8)]
    odd = {"13/02/2017": dt.date(2017, 2, 13), "1/5/97": dt.date(1997, 1, 5), "29 Feb 2016": dt.date(2016, 2, 29)}
    bad = ["13/45/2018", "29 Feb 2017", "soon", "", "2018", "11/8", "2018-11-08 25:99", "Foo 8, 2018", "1234567", "2018-13-01"]
    texts = [*good, *odd, *bad, None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.d for r in df.select("i", read_date("t").alias("d")).orderBy("i").collect()]
    assert got == [*want, *odd.values(), *[None] * (len(bad) + 1)]
    report = {r.shape: (r.cells, r.example) for r in unreadable(df, ["t"]).collect()}
    assert report["99/99/9999"] == (1, "13/45/2018") and report["aaaa"] == (1, "soon") and len(report) == len(bad)


def test_malformed_rows_are_set_aside_and_counted(spark, tmp_path):
    good = ["1", "O1", "2018-11-08", "11/10/2018", "m", "c", "Zoë\nLine", "s", "US", "A", "MA", "1810", "E", "p", "k", "u", 'n "q"', "10.0", "2", "0.1", "1"]
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [",".join(RAW_COLUMNS), ",".join(map(quote, good)), "2,O2,short", ",".join(map(quote, [*good, "extra"])), ",".join(map(quote, ["3", *good[1:5], "d", *good[6:]]))]
    path = tmp_path / "raw.csv"
    path.write_bytes("\n".join(lines).encode("latin-1"))
    cleaned = pipeline.clean_extract(read_raw_csv(spark, str(path)), str(tmp_path / "out"))
    assert sorted((r.row_id, r.customer_name) for r in cleaned.collect()) == [("1", "Zoë\nLine"), ("3", "Zoë\nLine")]
    audit = {r.step: int(r.rows) for r in spark.read.csv(str(tmp_path / "out" / "cleaning_audit"), header=True).collect()}
    assert audit["malformed rows set aside"] == 2 and audit["rows loaded"] == 2 == audit["rows kept"]
    assert sorted(r.line[:5] for r in spark.read.parquet(str(tmp_path / "out" / "malformed")).collect()) == ['"1","', "2,O2,"]


# ------------------------------------------------------------------- moments
def test_moments_keep_their_digits_beside_a_large_mean(spark):
    df = spark.createDataFrame([(float(x),) for x in (1e8 - 1, 1e8, 1e8 + 1, 1e8 + 4)], "sales double")
    row = quality.outlier_summary(df, ["sales"]).first()
    assert row.skew == 1.19
    one = moments.merged(moments.of_counts(quality.value_counts(df, ["sales"]))).select(moments.sample_deviation().alias("s")).first()
    assert abs(one.s - np.std([-1, 0, 1, 4], ddof=1)) < 1e-9


def test_moments_of_groups_merge_to_those_of_the_whole(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(1e6, 3, 4000), rng.exponential(2, 4000)
    rows = [(int(i % 7), float(a), None if i % 11 == 0 else float(b + a / 4)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    whole = {r.measure: r for r in moments.moments_of(df, ["x", "y"]).collect()}
    parts = moments.merged(moments.moments_of(df, ["x", "y"], ["g"])).collect()
    for r in parts:
        for c in moments.MOMENTS:
            assert np.isclose(r[c], whole[r.measure][c], rtol=1e-6, atol=1e-3), (r.measure, c)
    r = moments.merged_comoments(moments.comoments_of(df, [("x", "y")], ["g"])).first()
    both = np.array([v[1:] for v in rows if v[2] is not None], float)
    assert r.n == len(both) and np.isclose(r.r, np.corrcoef(both.T)[0, 1], atol=1e-9)


# ------------------------------------------------------------------- rollups
def test_running_totals_equal_direct_sums(spark):
    rng = np.random.default_rng(2)
    first = dt.date(2020, 12, 30)
    rows = [(["A", "B", None][int(rng.integers(3))], first + dt.timedelta(int(rng.integers(0, 70))), Decimal(int(rng.integers(-50, 500)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "region string, order_date date, sales decimal(18,2)")
    running = rollup.running_totals(df, ["region"], ["sales"])
    ranges = {f"r{i}": (str(a := first + dt.timedelta(int(rng.integers(-9, 70)))), str(a + dt.timedelta(int(rng.integers(0, 40))))) for i in range(12)}
    got = {(r.region, r.period): r.sales for r in rollup.range_totals(running, ranges, ["region"], ["sales"]).collect()}
    for (region, period), total in got.items():
        lo, hi = (dt.date.fromisoformat(v) for v in ranges[period])
        assert total == sum(s for g, d, s in rows if g == region and lo <= d <= hi)
    assert len(got) == 3 * len(ranges)
    assert rollup.running_totals(df.limit(0), (), ["sales"]).count() == 0


def test_sketches_unite_under_a_slicer(star):
    lines = star.lines(*rollup.ROLLUP_INPUTS, "region")
    where = {"start": "1995-03-01", "end": "1997-10-31", "region": ["ASIA", "EUROPE"]}
    about = rollup.united(rollup.daily_rollup(lines), where=where).first()
    exact = metrics.selected(lines, where).agg(F.count_distinct("order_id").alias("o"), F.count_distinct("customer_id").alias("c"), F.sum("sales").alias("s")).first()
    assert abs(about.orders_about / exact.o - 1) <= rollup.DISTINCT_ERROR and abs(about.customers_about / exact.c - 1) <= rollup.DISTINCT_ERROR
    assert about.sales == exact.s


# ---------------------------------------------------------------------- plans
@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("star"))
    cleaned = cleaning.Cleaning(raw_extract(star)).cleaned().write.parquet(f"{out}/cleaned")
    cleaned = spark.read.parquet(f"{out}/cleaned")
    profile = pipeline.customers.customer_profile(cleaned)
    lines = pipeline.build_features(cleaned, profile)
    return pipeline.build_star(lines, profile, f"{out}/star"), out


def test_a_date_slicer_reads_only_its_years(spark, stored):
    star, _ = stored
    rows = metrics.selected(star.lines("order_date", "order_year", "sales"), {"start": "1996-07-01", "end": "1997-02-28"})
    text = plan(rows)
    assert "order_year" in text.split("PartitionFilters:")[1].split("]")[0]
    assert {r.order_year for r in rows.select("order_year").distinct().collect()} == {1996, 1997}
    direct = star.lines("order_date", "sales").where("order_date between '1996-07-01' and '1997-02-28'")
    assert rows.agg(F.sum("sales")).first() == direct.agg(F.sum("sales")).first()


def test_a_calendar_prunes_the_fact_at_run_time(spark, stored):
    star, out = stored
    days = spark.read.parquet(f"{out}/star/dim_date").where("year_month between '1996-01' and '1996-03'")
    rows = metrics.on_calendar(star.lines("order_date", "order_year", "sales"), days.select("date", "year", "quarter"))
    assert "dynamicpruning" in plan(rows).lower()
    want = star.lines("order_date", "sales").where("order_date between '1996-01-01' and '1996-03-31'")
    assert rows.agg(F.sum("sales")).first() == want.agg(F.sum("sales")).first()


def test_lines_are_shuffled_once_with_customer_columns(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = features.customer_features(registry.views.profile_of(star))
        text = plan(star.lines("row_id", "customer_id", per_customer=known))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [x for x in text.splitlines() if "Exchange hashpartitioning(" in x]
    assert sum("l_orderkey" in x for x in moved) == 1 and not any("l_" in x and "custkey" in x for x in moved)


def test_missing_keys_equal_an_anti_join(spark):
    rows = [(k,) for k in [1, 2, 2, 70_000, 70_001, -5, None, None, 9_000_000_000]]
    fact = spark.createDataFrame(rows, "k bigint")
    dim = spark.createDataFrame([(1,), (70_000,), (-5,), (9_000_000_000,), (123,)], "k bigint")
    got = {r.k: r.lines for r in warehouse.missing_keys(fact, dim, "k").collect()}
    assert got == {2: 2, 70_001: 1, None: 2}
    text = warehouse.missing_keys(fact.select(F.col("k").cast("string")), dim.select(F.col("k").cast("string")), "k")
    assert {r.k: r.lines for r in text.collect()} == {"2": 2, "70001": 1, None: 2}


def test_the_fact_is_reconciled_while_it_is_written(spark, stored):
    star, out = stored
    row = spark.read.csv(f"{out}/star/reconciliation", header=True, inferSchema=True).first()
    fact = star.table("fact_sales").agg(F.count("*").alias("n"), F.sum("sales").cast("double").alias("s")).first()
    assert (row.lines, row.lines_without_place) == (fact.n, 0) and abs(row.sales - fact.s) < 0.01
    assert isinstance(star, Warehouse)


# ------------------------------------------------------------ cleaning at size
def test_only_rows_of_a_repeated_fingerprint_are_compared(spark):
    rows = [(str(i), "a" if i % 10 else str(i)) for i in range(2000)] + [("x", "a")]
    df = spark.createDataFrame(rows, "row_id string, v string").withColumns(fp.fingerprint(["v"]))
    known = cleaning.repeated(df)
    assert known.count() == 1
    assert fp.in_marks(df, known, "_fp1", True).count() == 1801
    assert fp.in_marks(df, known, "_fp1", False).count() == 200
    kept = {r.v: r.row_id for r in cleaning.without_copies(df).collect()}
    assert len(kept) == 201 and kept["a"] == "1"


def test_marks_of_negative_numbers_zero_and_word_ends(spark):
    hashes = [0, 63, 64, -1, -64, 2**63 - 1, -(2**63), 2**26, 2**26 + 63]
    df = spark.createDataFrame([(h,) for h in hashes], "h bigint")
    known = fp.marks(df, "h")
    assert fp.in_marks(df, known, "h", True).count() == len(hashes)
    others = spark.createDataFrame([(1,), (62,), (65,), (None,)], "h bigint")
    assert fp.in_marks(others, known, "h", True).count() == 0
    assert fp.in_marks(others, known, "h", False).count() == 4


def test_cleaned_rows_meet_the_codes_without_a_shuffle(spark, star):
    work = cleaning.Cleaning(raw_extract(star))
    text = plan(work.cleaned())
    # The one shuffle left is that of the rows that may be copies.
    assert text.count("Exchange hashpartitioning(") == 1 and "SortMergeJoin" not in text


def test_every_unicode_blank_is_trimmed_at_both_ends_only(spark):
    texts = [f"{chr(i)}a{chr(i)}b{chr(i)}{chr(i)}" for i in [*range(1, 0x300), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]] + [" ", "", None, " \n", "a\n \u2028"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    by_pattern = df.selectExpr("i", r"regexp_replace(t, r'(?U)^\s+|\s+$', '') AS t")
    assert cleaning.trim_text(df).exceptAll(by_pattern).count() == 0
    assert "regexp" not in plan(cleaning.trim_text(df))


def test_plain_dates_need_no_tokens_and_read_the_same(spark):
    texts = {"2018/1/2": "2018-01-02", "2018.01.02": "2018-01-02", "2018-1-2": "2018-01-02", "1/2/2018": "2018-01-02", "13.2.2018": "2018-02-13", "1/2-2018": "2018-01-02",
             "1/2/2018\n": "2018-01-02", "2018/1/2\n": "2018-01-02", "0/1/2018": None, "2018/13/1": None, "31/31/2018": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", read_date("t").alias("d"))
    assert {r.t: r.d and r.d.isoformat() for r in df.collect()} == texts
    assert dates.YEAR_FIRST in plan(df) and dates.YEAR_LAST in plan(df)


def test_lines_end_up_by_order_key(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.lines("category", "order_id", "profit").groupBy("category").agg(F.count_distinct("order_id")))
        assert not [x for x in text.splitlines() if "Exchange hashpartitioning(category" in x and "order_id" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reading_tasks_are_bounded_by_bytes(spark):
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 512
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


# ------------------------------------------------------- features of lines at size
def test_no_generated_method_is_too_large_for_the_compiler(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_month_and_weekday_names_are_looked_up(spark):
    # One date in ten is missing.
    days = spark.range(430).select(F.expr("CASE WHEN id % 10 > 0 THEN date_add(DATE'1899-12-25', int(id)) END AS order_date"))
    names = features.add_time_features(days.withColumn("ship_date", F.date_add("order_date", 40)))
    assert "MMM" not in plan(names) and "EEEE" not in plan(names)
    as_formatted = names.select(
        "*", F.date_format("order_date", "MMM").alias("m"), F.date_format("ship_date", "MMM").alias("s"), F.date_format("order_date", "EEEE").alias("d")
    )
    assert as_formatted.where("order_month_name <=> m AND processing_month <=> s AND order_day_name <=> d").count() == days.count()
    assert names.where("order_month_name IS NULL AND processing_month IS NULL AND order_day_name IS NULL").count() == 43


def test_lifetime_totals_count_orders_and_products_without_copies_of_lines(spark, star):
    rows = [
        # one order twice, an order and a product without a key, one id under two names, a name without a segment
        ("c", "n", "s", 1, 1, 10, 1), ("c", "n", "s", 1, 1, 10, 1), ("c", "n", "s", 1, 2, None, None), ("c", "n", "s", None, 2, 5, 3),
        ("c", "n", "s", 2, None, 1, 2), ("c", "m", "s", 1, 1, 7, 4), ("d", "n", "s", None, None, None, None), ("d", "n", None, 1, 1, 1, 1),
    ]
    names = "customer_id string, customer_name string, segment string, order_id int, product_id int, v int, day int"
    money = F.col("v").cast("decimal(18,2)")
    lines = spark.createDataFrame(rows, names).select(
        *customers.KEYS, "order_id", "product_id", F.date_add(F.lit("2018-01-01").cast("date"), F.col("day")).alias("order_date"),
        money.alias("sales"), money.alias("profit"), F.col("v").alias("quantity"), (F.col("v") / 10).cast("decimal(4,2)").alias("discount"),
    )
    got = customers.lifetime_totals(lines)
    want = lines.dropna(subset=customers.KEYS).groupBy(*customers.KEYS).agg(
        F.count_distinct("order_id").alias("lifetime_orders"), F.sum("sales").alias("lifetime_value"), F.sum("profit").alias("lifetime_profit"),
        F.sum("quantity").alias("lifetime_units"), mean("discount").alias("avg_discount"), F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"), F.count_distinct("product_id").alias("distinct_products"),
    )
    assert got.dtypes == want.dtypes and want.count() == 3
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert "Expand" not in plan(customers.lifetime_totals(star.lines(*customers.PROFILE_INPUTS)))


def test_quantiles_read_their_input_once(spark, star):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(exact_quantiles(star.lines("sales"), ["sales"], [0.25, 0.5]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert text.count("FileScan parquet") == 1 and "ReusedExchange" in text
