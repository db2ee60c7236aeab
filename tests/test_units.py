"""Edge cases on tiny tables."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from commerce_engine.functions.columns import cut, divide_or, label_order, rnd
from commerce_engine.functions.quantiles import exact_quantiles
from commerce_engine.functions.ranking import with_dense_rank, with_global_position
from commerce_engine.operators import cleaning, features, forecast, metrics, quality, scenario, stats, warehouse
from commerce_engine.operators.customers import customer_profile


def one(df, col):
    return [r[col] for r in df.collect()]


def test_discount_bands(spark):
    values = [-0.5, -0.01, -0.005, 0.0, 0.15, 0.30, 0.50, 1.0, 1.2, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d double")
    bands = one(df.orderBy("i").select(features.discount_band(F.col("d")).alias("b")), "b")
    assert bands == [None, None, "No discount", "No discount", "1-15%", "16-30%", "31-50%", "50%+", None, None]


def test_margin_bands_and_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.01), (2, 10.0), (3, 25.0), (4, 25.01), (5, None)], "i int, m double")
    got = one(df.orderBy("i").select(features.margin_band(F.col("m")).alias("b")), "b")
    assert got == ["Loss", "Low (0-10%)", "Low (0-10%)", "Healthy (10-25%)", "Strong (25%+)", None]
    row = spark.createDataFrame(
        [(Decimal("0.00"), Decimal("5.00"), 0, Decimal("0.00"))],
        "sales decimal(18,2), profit decimal(18,2), quantity int, discount decimal(4,2)",
    )
    out = features.add_value_features(row).first()
    assert out.profit_margin is None and out.unit_price is None and out.margin_band is None


def test_discount_value(spark):
    rows = [(Decimal("80"), Decimal("0.2")), (Decimal("10"), Decimal("1.0")), (Decimal("10"), None)]
    df = spark.createDataFrame(rows, "sales decimal(18,2), discount decimal(4,2)")
    assert one(features.add_value_features(df), "discount_value") == [pytest.approx(20.0), 0.0, 0.0]


def test_weekend_delay_and_calendar(spark):
    rows = [(dt.date(2018, 9, 1), dt.date(2018, 9, 7)), (dt.date(2018, 9, 2), None), (None, None), (dt.date(2016, 1, 1), dt.date(2016, 1, 6))]
    out = features.add_time_features(spark.createDataFrame(rows, "order_date date, ship_date date")).collect()
    assert [r.is_weekend_order for r in out] == [True, True, False, False]
    assert [r.is_delayed for r in out] == [True, False, False, False]
    assert out[3].order_week == 53 and out[3].year_quarter == "2016-Q1" and out[3].order_day_name == "Friday"


def test_cut_needs_matching_labels():
    with pytest.raises(ValueError):
        cut(None, [0, 1], ["a", "b"])


def test_label_order_and_rounding(spark):
    df = spark.createDataFrame([("b",), ("z",), ("a",)], "x string")
    assert one(df.orderBy(label_order(F.col("x"), ["b", "a"])), "x") == ["b", "a", "z"]
    got = spark.range(1).select(rnd(F.lit(1.005), 2).alias("a"), rnd(F.lit(float("nan")), 2).alias("b"), divide_or(F.lit(1), F.lit(0)).alias("c")).first()
    assert (got.a, got.b, got.c) == (1.01, None, 0.0)


RAW = ["Row ID", "Order ID", "Order Date", "Ship Date", "Customer ID", "Product ID", "Sales", "Quantity", "Discount", "Profit", "Postal Code", "City", "State"]


def raw(spark, *rows):
    base = dict(zip(RAW, ["1", "o", "2018-11-08", "11/10/2018", "c", "p", "10.0", "2", "0.1", "1", "1810.0", "A", "MA"]))
    return spark.createDataFrame([tuple({**base, **r}[c] for c in RAW) for r in rows], ", ".join(f"`{c}` string" for c in RAW))


def test_cleaning_steps(spark):
    empty = {c: None for c in RAW if c not in ("Row ID", "Order ID")}
    df = raw(
        spark,
        {"Row ID": "1"},
        {"Row ID": "2"},  # copy of 1
        {"Row ID": "3", "City": "A "},  # not a copy: texts are compared untrimmed
        {"Row ID": "4", "Sales": "10.00", "Order ID": "x"},
        {"Row ID": "5", "Sales": "10", "Order ID": "x"},  # copy of 4 as a number
        {"Row ID": "6", **empty},
        {"Row ID": "7", "Sales": "N/A"},
        {"Row ID": "8", "Order Date": "13/45/2018", "Order ID": "y", "Postal Code": None},
        {"Row ID": "9", "Quantity": "many", "Order ID": "z", "Postal Code": "90210.0"},
    )
    out = {r.row_id: r for r in cleaning.clean(df).collect()}
    assert sorted(out) == ["1", "3", "4", "8", "9"]
    assert out["8"].order_date is None and out["8"].postal_code == "01810"
    assert out["9"].quantity is None and out["9"].postal_code == "90210"
    assert out["3"].city == "A" and out["1"].ship_date == dt.date(2018, 11, 10)
    audit = {r.step: r.rows for r in cleaning.cleaning_audit(df).collect()}
    assert audit["shell rows removed"] == 1 and audit["incomplete rows removed"] == 1
    assert audit["duplicates removed"] == 2 and audit["postal codes imputed"] == 1 and audit["rows kept"] == 5


def test_dates_of_mixed_format(spark):
    df = spark.createDataFrame([("11/8/2018",), ("2018-11-08",), ("2018/11/08",), ("Nov 8, 2018",), ("13/45/2018",), (None,)], "d string")
    day = dt.date(2018, 11, 8)
    assert one(df.select(cleaning.parse_date("d").alias("d")), "d") == [day, day, day, day, None, None]
    more = ["2018-11-08 00:00:00", "08-Nov-2018", "11/8/18", "November 8, 2018", "20181108", "8 Nov 2018", "8 November 2018", "11-8-2018", "11/8/2018 0:00", "2018-11-08T00:00:00"]
    df = spark.createDataFrame([(t,) for t in more], "d string")
    assert one(df.select(cleaning.parse_date("d").alias("d")), "d") == [day] * len(more)


def test_common_postal_code_breaks_ties_low(spark):
    df = spark.createDataFrame([("S", "C", x) for x in ["2", "2", "1", "1", "3", None]], "state string, city string, postal_code string")
    assert one(cleaning.common_postal_codes(df), "common_code") == ["1"]


def test_null_matches_null_in_geography(spark):
    cols = "row_id string, country string, region string, state string, city string, postal_code string"
    rows = [("b", "U", "R", "S", "C", None), ("a", "U", "R", "S", "D", "1"), ("c", "U", "R", "S", "C", None)]
    geo = warehouse.dim_geography(spark.createDataFrame(rows, cols))
    assert sorted((r.geo_id, r.city) for r in geo.collect()) == [(1, "D"), (2, "C")]


def test_rules_count_nulls_where_they_should(spark):
    cols = (
        "row_id string, order_id string, customer_id string, sales double, quantity int, discount double, "
        "ship_date date, order_date date, shipping_days int, country string, region string, segment string, "
        "category string, postal_code string, profit_margin double"
    )
    d = dt.date(2020, 1, 2)
    good = ("1", "o", "c", 1.0, 1, 0.1, d, d, 0, "US", "W", "S", "T", "01810", 5.0)
    bad = ("2", None, None, None, 0, None, dt.date(2020, 1, 1), d, None, None, None, None, None, "1810", None)
    rules = quality.column_rules("US", ["W"], ["S"], ["T"])
    df = spark.createDataFrame([good, ("3", *good[1:]), bad, ("4", *bad[1:13], None, float("inf"))], cols)
    got = {r.rule: r.violations for r in quality.validate(df, rules).collect()}
    assert got.pop("No duplicate transactions") == 1
    assert got.pop("Sales are non-negative") == 0
    assert got.pop("Postal code is 5 chars or explicitly null") == 1
    assert set(got.values()) == {2}


def test_skew_and_kurtosis_are_bias_corrected(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 5, 30, 4, 4]], "v double")
    row = stats.shape(df, ["v"]).first()
    assert (row.skew, row.kurtosis) == (2.541697, 6.582969)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "v double")
    got = {r.bin: r.lines for r in stats.histogram(df, F.col("v"), 5).collect()}
    assert got == {1: 2, 2: 2, 3: 0, 4: 0, 5: 1}
    same = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert sum(r.lines for r in stats.histogram(same, F.col("v"), 3).collect()) == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    hot = np.full(4000, 12.34)  # a third of all rows share one value
    values = np.concatenate([hot, np.round(rng.lognormal(5, 3, 5000), 2), -np.round(rng.exponential(40, 3000), 2), [0.0, 1e12]])
    probs = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"v": values, "w": -values})).repartition(7)
    got = {r.measure: r.q for r in exact_quantiles(df, ["v", "w"], probs).collect()}
    np.testing.assert_allclose(got["v"], np.quantile(values, probs), rtol=1e-12)
    np.testing.assert_allclose(got["w"], np.quantile(-values, probs), rtol=1e-12)


@pytest.mark.parametrize("n", [0, 1, 7, 9, 500, 5000])
def test_global_position(spark, n):
    rng = np.random.default_rng(n)
    rows = [(int(v), f"c{i:05d}") for i, v in enumerate(rng.integers(0, 3, n))]
    df = spark.createDataFrame(rows, "v int, id string").repartition(5)
    got = {r.id: r.position for r in with_global_position(df, ["v", "id"]).collect()}
    assert got == {i: k + 1 for k, (v, i) in enumerate(sorted(rows))}


def test_dense_rank(spark):
    rows = [("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", None)]
    got = {r.k: r.rank for r in with_dense_rank(spark.createDataFrame(rows, "k string, v int"), "v", "rank").collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 3, "e": None}


def lines(spark, orders):
    cols = "customer_id string, customer_name string, segment string, order_id int, order_date date, product_id int, sales decimal(18,2), profit decimal(18,2), quantity int, discount decimal(4,2)"
    return spark.createDataFrame(orders, cols)


@pytest.mark.parametrize("n", [7, 12, 40])
def test_scores_equal_pandas(spark, n):
    rng = np.random.default_rng(n)
    rows, order = [], 0
    for c in range(n):
        for _ in range(int(rng.integers(1, 6))):
            order += 1
            day = dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.integers(0, 700)))
            rows.append((f"c{c:03d}", f"n{c}", "s", order, day, 1, Decimal(int(rng.integers(1, 10**6))) / 100, Decimal(1), 1, Decimal("0.1")))
    rows.append((None, "n", "s", 0, dt.date(2020, 1, 1), 1, Decimal(5), Decimal(1), 1, Decimal(0)))
    got = customer_profile(lines(spark, rows)).toPandas().set_index("customer_id").sort_index()
    value, recency = got.lifetime_value.astype(float), got.recency_days
    first = got.lifetime_orders.rank(method="first")
    assert list(got.f_score) == list(pd.qcut(first, 5, labels=[1, 2, 3, 4, 5]).astype(int))
    assert list(got.m_score) == list(pd.qcut(value, 5, labels=[1, 2, 3, 4, 5]).astype(int))
    edges = [recency.quantile(p) for p in (0.2, 0.4, 0.6, 0.8)]
    assert list(got.r_score) == [5 - sum(r > e for e in edges) for r in recency]
    assert list(got.is_high_value) == list(value >= value.quantile(0.8))
    assert len(got) == n


def monthly(spark, values, key=None):
    months = pd.period_range("2015-01", periods=len(values), freq="M").astype(str)
    return spark.createDataFrame([(key, m, float(v)) for m, v in zip(months, values)], "key string, year_month string, value double")


def naive(s, periods):
    growth = s[-12:].sum() / s[-24:-12].sum() if len(s) >= 24 else 1.0
    return [s[-12:][i % 12] * growth for i in range(periods)], growth


def test_forecast_of_many_series(spark):
    rng = np.random.default_rng(0)
    long, short = rng.uniform(10, 99, 40), rng.uniform(10, 99, 20)
    df = monthly(spark, long, "long").unionByName(monthly(spark, short, "short"))
    out = forecast.seasonal_naive(df, ["key"], 15).orderBy("key", "date").collect()
    for key, s in (("long", long), ("short", short)):
        want, growth = naive(s, 15)
        got = [r for r in out if r.key == key]
        np.testing.assert_allclose([r.forecast for r in got], want)
        assert got[0].growth == pytest.approx(growth)
    assert out[0].date == dt.date(2018, 5, 1)
    row = {r.key: r for r in forecast.backtest(df, ["key"]).collect()}["long"]
    pred, _ = naive(long[:-6], 6)
    assert row.mape == pytest.approx((abs(pred - long[-6:]) / long[-6:]).mean() * 100)
    assert row.mae == pytest.approx(abs(pred - long[-6:]).mean())


def test_discount_caps(spark):
    cols = "sales decimal(18,2), discount decimal(4,2), profit decimal(18,2)"
    df = spark.createDataFrame([(Decimal(50), Decimal("0.5"), Decimal(-10))], cols)
    got = {r.cap_pct: r.profit for r in scenario.discount_caps(df).collect()}
    assert got[100] == -10.0 and got[30] == 10.0
    full = spark.createDataFrame([(Decimal(10), Decimal("1.0"), Decimal(-5))], cols)
    assert {r.cap_pct: r.profit for r in scenario.discount_caps(full, [100, 30]).collect()}[30] == -8.0


def test_discount_caps_leave_out_or_keep_lines_without_a_discount(spark):
    cols = "region string, sales decimal(18,2), discount decimal(4,2), profit decimal(18,2)"
    rows = [("W", Decimal(100), None, Decimal(10)), ("W", Decimal(80), Decimal("0.20"), Decimal(5)), ("E", Decimal(9), None, Decimal(2))]
    df = spark.createDataFrame(rows, cols)
    assert {r.cap_pct: r.profit for r in scenario.discount_caps(df).collect()}[100] == 5.0
    got = {r.region: r for r in scenario.simulated_profit(df, 10, ["region"]).collect()}
    assert (got["W"].simulated_profit, got["W"].profit_uplift) == (25.0, 10.0)
    assert (got["E"].simulated_profit, got["E"].profit_uplift, got["E"].profit_uplift_ratio) == (2.0, 0.0, 0.0)
    assert scenario.discount_caps(df.limit(0)).count() == 0


def test_caps_are_exact_at_half_cents(spark):
    cols = "sales decimal(18,2), discount decimal(4,2), profit decimal(18,2)"
    lines = [(Decimal("0.06"), Decimal("0.80"), Decimal("-0.01"))] * 1001
    # 0.06 at 80 % is 0.075 at 75 %: 1001 lines gain 15.015, a tie that doubles would settle by their noise.
    got = {r.cap_pct: r for r in scenario.discount_caps(spark.createDataFrame(lines, cols), [100, 75]).collect()}
    assert got[75].profit == 5.01 and got[75].uplift == 15.02


def test_a_period_selection_shifts_its_dates(spark):
    rows = [(dt.date(2019, m, 5), m, Decimal(m), "W") for m in range(1, 13)] + [(dt.date(2020, m, 5), 20 + m, Decimal(10 * m), "W") for m in range(1, 4)]
    df = spark.createDataFrame(rows, "order_date date, order_id int, sales decimal(18,2), region string")
    where = {"start": "2020-02-01", "end": "2020-03-31", "region": "W"}
    got = {r.year_month: (r.sales, r.sales_prior) for r in metrics.compare_periods(df, {"total_sales": "sales"}, 12, where=where).collect()}
    assert got == {"2020-02": (20, 2), "2020-03": (30, 3)}


def test_last_complete_month(spark):
    def last(*days):
        return spark.createDataFrame([(d,) for d in days], "order_date date").transform(
            lambda df: df.limit(1).select(forecast.last_complete_month(df).alias("m"))
        ).first().m

    assert last(dt.date(2020, 2, 29), dt.date(2019, 5, 1)) == "2020-02"
    assert last(dt.date(2020, 3, 30)) == "2020-02"


def test_prior_period_is_by_date_not_by_row(spark):
    rows = [(dt.date(2020, 1, 5), 1, Decimal(10)), (dt.date(2020, 3, 5), 2, Decimal(30)), (dt.date(2020, 4, 5), 3, Decimal(45))]
    df = spark.createDataFrame(rows, "order_date date, order_id int, sales decimal(18,2)")
    got = {r.year_month: r for r in metrics.compare_periods(df, {"total_sales": "sales"}, 1).collect()}
    assert got["2020-03"].sales_prior is None and got["2020-04"].sales_change == 0.5


def test_slicers_and_empty_selection(spark):
    df = spark.createDataFrame([("W", dt.date(2020, 1, 5), 1, Decimal(10), Decimal(1))], "region string, order_date date, order_id int, sales decimal(18,2), profit decimal(18,2)")
    empty = metrics.measure(df, ["profit_margin", "avg_order_value"], where=metrics.slicer(region="E", start="2020-01-01")).first()
    assert (empty.profit_margin, empty.avg_order_value) == (0.0, 0.0)
    assert [r.region for r in metrics.top_n(df, "region", 1).collect()] == ["W"]
    assert metrics.top_n(df, "region", 40, where={"region": "E"}).count() == 0


def test_rolling_mean_waits_for_a_full_window(spark):
    df = spark.createDataFrame([(f"2020-0{i}", Decimal(i)) for i in range(1, 5)], "year_month string, sales decimal(18,2)")
    got = [r.rolling_mean for r in stats.rolling_mean(df).orderBy("year_month").collect()]
    assert got == [None, None, 2.0, 3.0]


def test_written_tables_are_removed(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from commerce_engine import session

    before = session.written_so_far()
    frames = [session.materialize(spark.range(5), "kept"), session.materialize(spark.range(3), "last")]
    folders = [Path(urlparse(df.inputFiles()[0]).path).parent for df in frames]
    session.remove_written(before, keep=1)
    assert [f.exists() for f in folders] == [False, True] and frames[1].count() == 3
    session.remove_written(before)
    assert not folders[1].exists()


@pytest.mark.parametrize("approx", [False, True])
def test_column_profile(spark, approx):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 1)], "t string, n int")
    got = {r["column"]: (r["dtype"], r["non_null"], r["null_count"], r["unique"], r["sample"], r["null_pct"]) for r in quality.column_profile(df, approx).collect()}
    assert got == {"t": ("string", 2, 1, 2, "a", 33.33), "n": ("int", 2, 1, 1, "1", 33.33)}
