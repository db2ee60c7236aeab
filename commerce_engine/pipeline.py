"""The whole job: extract or order tables in, cleaned lines, star and reports out.

    python -m commerce_engine.pipeline --raw-csv extract.csv --out folder
    python -m commerce_engine.pipeline --tables folder --out folder
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import cleaning, customers, features, forecast, metrics, quality, scenario, stats, warehouse
from .plans import analytics, dashboard, views, workbook
from .session import build_session
from .sources.extract import read_raw_csv
from .sources.sinks import register_views, write_document, write_observed, write_report, write_reports, write_table
from .sources.star import BASE_COLS, OrderTables, Star, Warehouse

# Expected members of the retail extract.
COUNTRY = "United States"
REGIONS = ["West", "East", "Central", "South"]
SEGMENTS = ["Consumer", "Corporate", "Home Office"]
CATEGORIES = ["Technology", "Furniture", "Office Supplies"]


def build_features(cleaned: DataFrame, profile: DataFrame) -> DataFrame:
    lines = features.add_value_features(features.add_time_features(cleaned))
    return features.attach_customer_features(features.add_sales_category(lines, cleaned), profile)


def fact_totals() -> dict[str, Column]:
    """What must agree with the cleaned lines, and lines whose place is unknown."""
    return {
        "lines": F.count("*"),
        "sales": F.sum("sales"),
        "profit": F.sum("profit"),
        "lines_without_place": F.count_if(F.col("geo_id").isNull()),
    }


def build_star(lines: DataFrame, profile: DataFrame, out: str) -> Star:
    """Write the star's tables and open them; the fact's totals are taken as it is written."""
    spark = lines.sparkSession
    geography = write_table(warehouse.dim_geography(lines), f"{out}/dim_geography")
    write_table(warehouse.dim_customer(profile), f"{out}/dim_customer")
    write_table(warehouse.dim_product(lines), f"{out}/dim_product")
    fact = warehouse.fact_sales(lines, geography).withColumn("order_year", F.year("order_date"))
    _, totals = write_observed(fact, f"{out}/fact_sales", fact_totals(), partition_by="order_year")
    write_report(spark.range(1).select(*[F.lit(v).alias(k) for k, v in totals.items()]), f"{out}/reconciliation")
    write_table(metrics.calendar(lines), f"{out}/dim_date")
    star = Warehouse(spark, out)
    register_views({t: star.table(t) for t in ("dim_customer", "dim_product", "dim_geography", "fact_sales")})
    return star


def questions(star: Star, profile: DataFrame, categories: Sequence[str]) -> dict[str, DataFrame]:
    """All thirty questions against any star."""
    a = analytics
    with_profile = {a.q21_customer_lifetime_value, a.q22_rfm_segments, a.q23_high_value_customers}
    out = {}
    for name, ask in a.QUESTIONS.items():
        if ask in with_profile:
            out[name] = ask(star, profile=profile)
        elif ask is a.q28_segment_category_matrix:
            out[name] = ask(star, categories)
        else:
            out[name] = ask(star)
    return out


def audit(cleaned: DataFrame, lines: DataFrame, out: str, expected: tuple) -> None:
    rules = quality.column_rules(*expected)
    write_report(quality.validate(lines, rules), f"{out}/rules")
    write_report(quality.column_profile(cleaned), f"{out}/column_profile")
    write_report(quality.outlier_summary(lines), f"{out}/outlier_summary")
    write_table(quality.outlier_rows(lines), f"{out}/outliers")


def exports(lines: DataFrame, out: str) -> None:
    """Aggregates for BI tools and the flat projection for pivoting."""
    series = forecast.monthly_series(lines, complete=True)
    write_reports(
        {
            "agg_monthly": stats.monthly_totals(lines),
            "agg_yearly": stats.yearly_summary(lines),
            "agg_region": stats.agg_region(lines),
            "agg_category": stats.agg_category(lines),
            "agg_subcategory": stats.agg_sub_category(lines),
            "agg_state": stats.agg_state(lines),
            "agg_discount": stats.agg_discount(lines),
            "agg_forecast": forecast.forecast_with_band(series),
            "agg_discount_sim": scenario.discount_caps(lines),
            "workbook_kpis": workbook.kpis(lines),
            "workbook_months": workbook.monthly_grid(lines),
            "workbook_regions": workbook.region_sheet(lines),
            "workbook_customers": workbook.top_customers(lines),
        },
        out,
    )
    write_table(workbook.flat_projection(lines), f"{out}/flat")


def run(
    cleaned: DataFrame,
    out: str,
    expected: tuple = (COUNTRY, REGIONS, SEGMENTS, CATEGORIES),
    codes: DataFrame | None = None,
    written: bool = False,
) -> Star:
    """Every stage after cleaning; each stage that is read again is written once.

    ``written``: the cleaned lines come from their stage table already.
    """
    spark = cleaned.sparkSession
    if not written:
        cleaned = write_table(cleaned, f"{out}/cleaned")
    profile = write_table(
        customers.customer_profile(cleaned).orderBy(F.desc("lifetime_value"), "customer_id"), f"{out}/customer_profile"
    )
    lines = write_table(build_features(cleaned, profile), f"{out}/features")
    audit(cleaned, lines, f"{out}/quality", expected)
    star = build_star(lines, profile, f"{out}/star")
    write_reports(questions(star, profile, expected[3]), f"{out}/questions")
    views.register(star, profile)
    register_views({"vw_sales_detail": views.sales_detail(lines)})
    write_document(
        dashboard.payload(lines, dashboard.us_state_codes(spark) if codes is None else codes), f"{out}/dashboard"
    )
    exports(lines, f"{out}/exports")
    return star


def clean_extract(raw: DataFrame, out: str) -> DataFrame:
    """Write the cleaned lines, the malformed rows and the audit, from one reading of the extract."""
    work = cleaning.Cleaning(raw)
    rows, kept = work.observed()
    cleaned = write_table(rows, f"{out}/cleaned")
    write_report(work.audit(kept), f"{out}/cleaning_audit")
    if work.seen["malformed"]:
        write_table(work.malformed(), f"{out}/malformed")
    return cleaned


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw-csv", help="raw extract, one header line, Latin-1")
    source.add_argument("--tables", help="folder of order tables")
    parser.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    spark: SparkSession = build_session("commerce_engine pipeline")
    if args.raw_csv:
        clean_extract(read_raw_csv(spark, args.raw_csv), args.out)
        run(spark.read.parquet(f"{args.out}/cleaned"), args.out, written=True)
    else:
        run(OrderTables(spark, args.tables).base_lines(*BASE_COLS), args.out)


if __name__ == "__main__":
    main()
