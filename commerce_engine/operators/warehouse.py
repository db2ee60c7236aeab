"""Star schema: customer, product and geography dimensions and the order-line fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import appearance, first_rows, number_from
from ..functions.ranking import with_global_position
from ..session import materialize

GEO_KEYS = ["country", "region", "state", "city", "postal_code"]
FACT_COLS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id", "geo_id", "sales",
    "quantity", "discount", "profit", "shipping_days", "profit_margin", "discount_band", "sales_category",
    "is_weekend_order", "is_loss", "is_delayed",
]
FACT_FLAGS = ["is_weekend_order", "is_loss", "is_delayed"]


def flag(c: str):
    return F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)


def dim_customer(profile: DataFrame) -> DataFrame:
    return profile.select(
        "customer_id", "customer_name", "segment", "lifetime_orders", "lifetime_value", "lifetime_profit",
        "avg_order_value", "recency_days", flag("is_repeat"), flag("is_high_value"), "rfm_score", "rfm_segment",
    )


def dim_product(lines: DataFrame) -> DataFrame:
    """The attributes of each product's first line (lowest row id, numbers as numbers)."""
    columns = ["product_id", "product_name", "category", "sub_category"]
    return first_rows(lines.select("row_id", *columns), ["product_id"], appearance()).select(*columns)


def dim_geography(lines: DataFrame) -> DataFrame:
    """Distinct places numbered in order of first appearance (lowest row id)."""
    places = first_rows(lines.select("row_id", *GEO_KEYS), GEO_KEYS, appearance())
    number = number_from("row_id", "decimal(38,0)")
    ordered = places.withColumns({"_text": number.isNull(), "_number": number})
    numbered = with_global_position(materialize(ordered, "places"), ["_text", "_number", "row_id"], "geo_id")
    return numbered.select(F.col("geo_id").cast("int").alias("geo_id"), *GEO_KEYS)


def fact_sales(features: DataFrame, geography: DataFrame) -> DataFrame:
    """Fact columns with the place key attached; an unknown postal code matches itself."""
    geo = geography.select("geo_id", *[F.col(k).alias(f"g_{k}") for k in GEO_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in GEO_KEYS]
    joined = features.join(geo, same, "left")
    return joined.select(*[flag(c) if c in FACT_FLAGS else F.col(c) for c in FACT_COLS])


def orphans(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows whose key is absent from a dimension, per dimension."""
    out = None
    for name, (dim, key) in dims.items():
        missing = missing_keys(fact, dim, key)
        row = missing.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("orphans")).select(F.lit(name).alias("dimension"), "orphans")
        out = row if out is None else out.unionByName(row)
    return out


def missing_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(key, lines) of the keys of the fact that the dimension does not have, null included.

    Whole-number keys are compared as bitmaps first: each side shrinks to 4 kB for each
    range of 32,768 keys before the shuffle, and only lines of ranges where the fact has a
    key that the dimension lacks go on to the anti-join, grouped by key.
    """
    lines = fact.select(key)
    if dict(fact.dtypes)[key] in ("tinyint", "smallint", "int", "bigint") and dict(dim.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        number = F.col(key).cast("bigint")
        bucket, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)

        def ranges(df: DataFrame, known: bool) -> DataFrame:
            maps = df.where(F.col(key).isNotNull()).groupBy(bucket.alias("_range")).agg(F.bitmap_construct_agg(bit).alias("keys"))
            return maps.select("_range", "keys", F.when(F.lit(known), F.col("keys")).alias("known"))

        both = ranges(lines, False).unionByName(ranges(dim.select(key), True)).groupBy("_range")
        counts = both.agg(F.bitmap_count(F.bitmap_or_agg("keys")).alias("n"), F.bitmap_count(F.bitmap_or_agg("known")).alias("n_known"))
        suspect = counts.where("n > n_known").select("_range")
        found = lines.withColumn("_range", bucket).join(suspect, "_range", "left_semi").drop("_range")
        lines = found.unionByName(lines.where(F.col(key).isNull()))
    return lines.groupBy(key).agg(F.count("*").alias("lines")).join(dim.select(key), key, "left_anti")


def reconciliation(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("lines"),
        F.round(F.sum("sales"), 2).alias("sales"),
        F.round(F.sum("profit"), 2).alias("profit"),
        F.count_distinct("order_id").alias("orders"),
    )
