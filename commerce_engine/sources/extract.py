"""Raw text extracts: the CSV scan, and a dirtied extract derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .star import OrderTables

#: Holds the text of a row that does not have the extract's columns; null for all others.
MALFORMED = "_malformed"

# The header of the raw extract.
RAW_COLUMNS = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name", "Segment",
    "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category", "Sub-Category",
    "Product Name", "Sales", "Quantity", "Discount", "Profit",
]


def read_raw_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", line_breaks: bool = True) -> DataFrame:
    """Every column as text: dates, codes and numbers are typed by the cleaning steps.

    A row with too few or too many fields, or an open quote, keeps its text in a column of
    its own (:data:`MALFORMED`) and is set aside by the cleaning. Quoted values may hold
    line breaks. For them a file has to be read by one task: a large extract should come
    as many files, or, where no value holds a break, be read with ``line_breaks=False``.
    """
    schema = ", ".join(f"`{c}` string" for c in [*RAW_COLUMNS, MALFORMED])
    return spark.read.csv(
        path, header=True, schema=schema, encoding=encoding, escape='"', multiLine=line_breaks, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED,
    )


def read_typed_csv(spark: SparkSession, path: str, schema: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, dateFormat=date_format, escape='"')


def raw_extract(star: OrderTables) -> DataFrame:
    """All order lines as a raw extract with every defect the cleaning steps handle.

    Nothing is left out: each line appears, and on top of that some lines are
    repeated under another row id, some orders get shell rows, and dates, codes,
    numbers and text are spoiled by fixed rules on the line's own keys.
    """
    lines = star.base_lines(
        "row_id", "order_id", "order_date", "raw_ship_date", "ship_mode", "customer_id", "customer_name",
        "segment", "country", "city", "state", "postal_code", "region", "product_id", "category",
        "sub_category", "product_name", "sales", "quantity", "discount", "profit",
    )
    product, customer, quantity = F.col("product_id"), F.col("customer_id"), F.col("quantity")
    copies = F.when(product % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # As an extract comes in many files, its rows come in many partitions, also from one order file.
    repeated = lines.repartition("order_id").withColumn("copy", F.explode(copies))

    def iso(c: str):
        return F.date_format(c, "yyyy-MM-dd")

    def us(c: str):
        return F.date_format(c, "M/d/yyyy")

    order_text = (
        F.when(product % 3 == 0, iso("order_date"))
        .when(product % 3 == 1, us("order_date"))
        .otherwise(F.date_format("order_date", "yyyy/MM/dd"))
    )
    ship_text = (
        F.when(product % 89 == 0, "13/45/2018")
        .when(product % 83 == 1, F.date_format("raw_ship_date", "yyyy-MM-dd 00:00:00"))
        .when(product % 83 == 2, F.date_format("raw_ship_date", "dd-MMM-yyyy"))
        .when(product % 83 == 3, F.date_format("raw_ship_date", "MMMM d, yyyy"))
        .when(product % 83 == 4, F.date_format("raw_ship_date", "yyyyMMdd"))
        .when(quantity % 2 == 0, iso("raw_ship_date"))
        .otherwise(us("raw_ship_date"))
    )
    text = {
        "Row ID": F.when(F.col("copy") == 0, F.col("row_id")).otherwise(F.concat("row_id", F.lit("-R"))),
        "Order ID": F.col("order_id").cast("string"),
        "Order Date": order_text,
        "Ship Date": ship_text,
        "Ship Mode": F.col("ship_mode"),
        "Customer ID": customer.cast("string"),
        "Customer Name": F.when(quantity % 7 == 0, F.concat(F.lit("  "), "customer_name", F.lit("\t"))).otherwise(
            F.col("customer_name")
        ),
        "Segment": F.col("segment"),
        "Country": F.when(customer % 97 == 0, "Canada").otherwise(F.col("country")),
        "City": F.when(quantity % 11 == 0, F.concat("city", F.lit(" "))).otherwise(F.col("city")),
        "State": F.col("state"),
        "Postal Code": F.when(
            customer % 11 != 0, F.concat(F.col("postal_code").cast("int").cast("string"), F.lit(".0"))
        ),
        "Region": F.col("region"),
        "Product ID": F.when(product % 503 == 0, "NA").otherwise(product.cast("string")),
        "Category": F.col("category"),
        "Sub-Category": F.col("sub_category"),
        "Product Name": F.col("product_name"),
        "Sales": F.when(F.col("copy") == 0, F.col("sales").cast("string")).otherwise(
            F.concat(F.col("sales").cast("string"), F.lit("00"))
        ),
        "Quantity": F.when(product % 509 == 1, "")
        .when(product % 521 == 2, "many")
        .otherwise(quantity.cast("string")),
        "Discount": F.when(product % 601 == 3, "1.20").otherwise(F.col("discount").cast("string")),
        "Profit": F.col("profit").cast("string"),
    }
    body = repeated.select(*[text[c].alias(c) for c in RAW_COLUMNS])

    order = F.col("o_orderkey")
    shell_copies = (
        F.when(order % 26 == 0, F.array(F.lit(0), F.lit(1)))
        .when(order % 13 == 0, F.array(F.lit(0)))
        .otherwise(F.array().cast("array<int>"))
    )
    shells = (
        star.table("orders")
        .select(order, F.explode(shell_copies).alias("copy"))
        .select(
            F.concat(F.lit("S-"), order.cast("string")).alias("Row ID"),
            order.cast("string").alias("Order ID"),
            *[F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS[2:]],
        )
    )
    return body.unionByName(shells)
