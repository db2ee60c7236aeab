"""Dashboard tables (headline KPIs, trends, shares, leaders, regions) and their JSON payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    dbl,
    decimals_to_double,
    display_money,
    display_thousands,
    percent,
    ratio,
    rnd,
    share,
)

PAYLOAD_INPUTS = [
    "order_id", "customer_id", "customer_name", "product_name", "category", "sub_category", "segment", "region",
    "state", "order_date", "order_year", "order_month", "sales", "profit",
]


def _delta(now: Column, before: Column) -> Column:
    """Change in percent, one decimal; 0.0 where there is nothing to compare with."""
    return F.coalesce(rnd(percent(now - before, before), 1), F.lit(0.0))


def kpi_cards(df: DataFrame) -> DataFrame:
    """Five KPIs over everything, each with the change of the latest year on the year before.

    Lines first shrink to one row per order, customer and year, so the six distinct
    counts expand orders instead of lines.
    """
    df = df.groupBy("order_id", "customer_id", "order_year").agg(
        F.sum("sales").alias("sales"), F.sum("profit").alias("profit")
    )
    years = df.select("order_year").distinct().agg(F.sort_array(F.collect_set("order_year"), False)).scalar()
    latest, previous = F.try_element_at("_years", F.lit(1)), F.try_element_at("_years", F.lit(2))

    def of(year: Column, c: str) -> Column:
        return F.when(F.col("order_year") == year, F.col(c))

    row = df.withColumn("_years", years).agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        *[F.sum(of(y, c)).alias(f"{c}_{t}") for c in ("sales", "profit") for y, t in ((latest, "now"), (previous, "was"))],
        *[
            F.count_distinct(of(y, c)).alias(f"{n}_{t}")
            for c, n in (("order_id", "orders"), ("customer_id", "customers"))
            for y, t in ((latest, "now"), (previous, "was"))
        ],
    )
    cards = []
    for place, (label, c) in enumerate(
        [("Total Sales", "sales"), ("Total Profit", "profit"), ("Total Orders", "orders"), ("Total Customers", "customers")]
    ):
        delta = _delta(dbl(f"{c}_now"), dbl(f"{c}_was"))
        cards.append(F.struct(F.lit(place + 1).alias("place"), F.lit(label).alias("label"), dbl(c).alias("value"), delta.alias("delta_pct")))
    aov = [ratio(F.col(f"sales{t}"), F.col(f"orders{t}")) for t in ("", "_now", "_was")]
    cards.append(
        F.struct(
            F.lit(5).alias("place"),
            F.lit("Avg Order Value").alias("label"),
            rnd(aov[0], 2).alias("value"),
            _delta(aov[1], aov[2]).alias("delta_pct"),
        )
    )
    return row.select(F.explode(F.array(*cards)).alias("c")).select("c.*")


def calendar_months(df: DataFrame) -> DataFrame:
    """Sales and profit for each of the twelve months, 0 where nothing sold."""
    months = df.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("order_month"))
    by = df.groupBy("order_month").agg(F.sum("sales").alias("sales"), F.sum("profit").alias("profit"))
    return months.join(by, "order_month", "left").select(
        "order_month",
        F.date_format(F.make_date(F.lit(2020), "order_month", F.lit(1)), "MMM").alias("month"),
        F.round(F.coalesce("sales", F.lit(0)), 2).alias("sales"),
        F.round(F.coalesce("profit", F.lit(0)), 2).alias("profit"),
    )


def month_signs(df: DataFrame) -> DataFrame:
    """Profit per month with the sign that picks its bar colour."""
    by = df.groupBy("year_month").agg(F.sum("profit").alias("profit"))
    return by.withColumn("sign", F.when(F.col("profit") < 0, "loss").otherwise("profit"))


def share_of_sales(df: DataFrame, key: str) -> DataFrame:
    by = df.groupBy(key).agg(F.sum("sales").alias("sales"))
    pct = share(F.col("sales"), F.sum("sales").over(Window.partitionBy()), 1)
    return by.withColumn("share_pct", pct).orderBy(F.desc("sales"), key).select(key, "share_pct")


def leaders(df: DataFrame, key: str, measure: str, k: int = 5) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.round(F.sum(measure), 2).alias(measure))
        .orderBy(F.desc(measure), key)
        .limit(k)
    )


def region_table(df: DataFrame) -> DataFrame:
    """Regions and a Total row whose distinct counts are counted, not added."""
    body = (
        df.rollup("region")
        .agg(
            F.grouping_id().alias("is_total"),
            F.round(F.sum("sales"), 2).alias("sales"),
            F.round(F.sum("profit"), 2).alias("profit"),
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_id").alias("customers"),
            rnd(percent(F.sum("profit"), F.sum("sales")), 2).alias("margin_pct"),
        )
    )
    name = F.when(F.col("is_total") == 1, "Total").otherwise(F.col("region"))
    return body.orderBy("is_total", F.desc("sales")).select(
        name.alias("region"), "sales", "profit", "orders", "customers", "margin_pct"
    )


# Postal abbreviations of the contiguous states and the capital district.
STATE_CODES = {
    "Alabama": "AL", "Arizona": "AZ", "Arkansas": "AR", "California": "CA", "Colorado": "CO",
    "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC", "Florida": "FL", "Georgia": "GA",
    "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA",
    "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO", "Montana": "MT",
    "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK",
    "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def us_state_codes(spark) -> DataFrame:
    return spark.createDataFrame(list(STATE_CODES.items()), "state string, code string")


def state_sales(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Sales by state code; states without a code are left out."""
    by = df.groupBy("state").agg(F.round(F.sum("sales"), 2).alias("sales"))
    return by.join(codes, "state").select("code", "sales")


def as_of(df: DataFrame) -> DataFrame:
    return df.agg(F.max("order_date").alias("as_of"))


def payload(df: DataFrame, codes: DataFrame) -> DataFrame:
    """One JSON document: every table above as a field of one struct.

    Each part is a bounded aggregate that reaches the document as a scalar
    subquery; the lines themselves are never gathered.
    """

    def rows(part: DataFrame, order: list[Column], *cols: str) -> Column:
        keys = [c.alias(f"_{i}") for i, c in enumerate(order)]
        item = F.struct(*keys, F.struct(*[F.col(c) for c in cols]).alias("row"))
        listed = part.agg(F.sort_array(F.collect_list(item)).alias("items"))
        return listed.select(F.transform("items", lambda x: x["row"])).scalar()

    sales, profit = -dbl("sales"), -dbl("profit")
    total = df.agg(
        F.sum("sales").alias("s"),
        F.sum("profit").alias("p"),
        F.count_distinct("order_id").alias("o"),
        F.count_distinct("customer_id").alias("c"),
        F.max("order_date").alias("d"),
    )
    body = F.struct(
        F.date_format("d", "MMMM dd, yyyy").alias("asOf"),
        rows(kpi_cards(df), [F.col("place")], "label", "value", "delta_pct").alias("kpis"),
        rows(decimals_to_double(calendar_months(df)), [F.col("order_month")], "month", "sales", "profit").alias("months"),
        rows(share_of_sales(df, "category"), [-F.col("share_pct"), F.col("category")], "category", "share_pct").alias("category"),
        rows(share_of_sales(df, "segment"), [-F.col("share_pct"), F.col("segment")], "segment", "share_pct").alias("segment"),
        rows(decimals_to_double(leaders(df, "product_name", "sales")), [sales, F.col("product_name")], "product_name", "sales").alias("topProducts"),
        rows(decimals_to_double(leaders(df, "customer_name", "sales")), [sales, F.col("customer_name")], "customer_name", "sales").alias("topCustomers"),
        rows(decimals_to_double(leaders(df, "sub_category", "profit")), [profit, F.col("sub_category")], "sub_category", "profit").alias("subCategory"),
        rows(
            decimals_to_double(region_table(df)).where("region <> 'Total'"), [sales, F.col("region")],
            "region", "sales", "profit", "orders", "customers", "margin_pct",
        ).alias("regions"),
        F.array(
            F.lit("Total"),
            display_money(F.col("s"), 1e6, 2, "M"),
            display_money(F.col("p"), 1e3, 2, "K"),
            display_thousands(F.col("o")),
            display_thousands(F.col("c")),
            F.concat(F.format_string("%.2f", percent(F.col("p"), F.col("s"))), F.lit("%")),
        ).alias("totals"),
        rows(decimals_to_double(state_sales(df, codes)), [F.col("code")], "code", "sales").alias("states"),
        display_money(F.col("s"), 1e6, 2, "M").alias("totalSalesLabel"),
    )
    return total.select(F.to_json(body).alias("payload"))
