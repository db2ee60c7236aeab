"""Order lines and their dimensions, assembled column by column.

``lines(*cols)`` joins only the tables that the asked-for columns live in, so a
query over measures alone never touches a dimension. Dimension rows are joined to
orders first (the smaller side) and order lines are shuffled once, on the order
key. No join carries a broadcast hint: Spark broadcasts a side only when its
measured size is under the session's threshold and shuffles both sides otherwise.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import add_time_features, add_value_features

# Schemas are stated, never inferred, so opening a table costs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}

PRODUCT_COLS = ["product_id", "product_name", "category", "sub_category"]
CUSTOMER_COLS = ["customer_id", "customer_name", "segment"]
GEOGRAPHY_COLS = ["country", "region", "state", "city", "postal_code"]
BASE_COLS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", *CUSTOMER_COLS, *GEOGRAPHY_COLS,
    *PRODUCT_COLS, "sales", "quantity", "discount", "profit",
]


SUMMED = ["sales", "profit", "quantity"]


class Star(ABC):
    """Source of order lines; queries are written against this interface only."""

    #: Derived columns that the source holds itself.
    stored: Sequence[str] = ()

    @abstractmethod
    def base_lines(self, *cols: str, per_customer: DataFrame | None = None) -> DataFrame:
        """Order lines with exactly the base columns asked for, then those of ``per_customer``.

        ``per_customer`` holds one row per customer_id; lines without one get nulls.
        """

    @abstractmethod
    def products(self) -> DataFrame:
        """product_id, product_name, category, sub_category."""

    @abstractmethod
    def customers(self) -> DataFrame:
        """customer_id, customer_name, segment."""

    def by_product(self, *cols: str) -> DataFrame:
        """Product attributes and summed measures, one row per product that was sold.

        It stands in for the lines wherever measures are only summed: the lines are
        grouped by product before any attribute joins.
        """
        return self._grouped("product_id", self.products(), cols)

    def by_customer(self, *cols: str) -> DataFrame:
        """As :meth:`by_product`, by customer."""
        return self._grouped("customer_id", self.customers(), cols)

    def _grouped(self, key: str, attributes: DataFrame, cols: Sequence[str]) -> DataFrame:
        measures = [c for c in cols if c in SUMMED]
        totals = self.lines(key, *measures).groupBy(key).agg(*[F.sum(m).alias(m) for m in measures])
        return totals.join(attributes, key).select(*cols)

    def lines(self, *cols: str, per_customer: DataFrame | None = None) -> DataFrame:
        """Order lines with base and derived (time, value) columns, and those of ``per_customer``."""
        base = [c for c in cols if c in BASE_COLS or c == "raw_ship_date" or c in self.stored]
        derived = [c for c in cols if c not in base]
        inputs = {i for c in derived for i in DERIVED_FROM[c]}
        df = self.base_lines(*dict.fromkeys([*base, *sorted(inputs)]), per_customer=per_customer)
        if derived:
            if inputs & {"order_date", "ship_date"}:
                df = add_time_features(df, only=derived)
            if any(c in VALUE_COLS for c in derived):
                df = add_value_features(df)
        return df.select(*cols, *attributes_of(per_customer))


def attributes_of(per_customer: DataFrame | None) -> list[str]:
    return [] if per_customer is None else [c for c in per_customer.columns if c != "customer_id"]


_TIME = {
    c: ["order_date"]
    for c in (
        "order_year", "order_month", "order_month_name", "order_quarter", "order_quarter_num", "year_month",
        "year_quarter", "order_day_name", "order_week", "is_weekend_order",
    )
} | {"processing_month": ["ship_date"]}
_TIME |= {c: ["order_date", "ship_date"] for c in ("shipping_days", "is_delayed")}
VALUE_COLS = {
    "profit_margin": ["profit", "sales"],
    "unit_price": ["sales", "quantity"],
    "is_loss": ["profit"],
    "is_discounted": ["discount"],
    "discount_value": ["sales", "discount"],
    "discount_band": ["discount"],
    "margin_band": ["profit", "sales"],
}
DERIVED_FROM = _TIME | VALUE_COLS


CENT = Decimal("0.01")


def hundredths(c: str) -> Column:
    """A two-decimal DOUBLE as a whole number of hundredths."""
    return F.rint(F.col(c) * 100).cast("bigint")


def per_hundred(c: Column) -> Column:
    """c / 100 as a whole number, half away from zero."""
    half = F.when(c < 0, -50).otherwise(50)
    return F.call_function("div", c + half, F.lit(100))


def as_money(cents: Column) -> Column:
    """Whole cents as DECIMAL(18,2)."""
    return cents.cast("decimal(15,0)") * F.lit(CENT)


class OrderTables(Star):
    """The star read from normalised order tables (Parquet files of one folder)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
        )

    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
        )

    def base_lines(self, *cols: str, per_customer: DataFrame | None = None) -> DataFrame:
        tables = {NEEDS[c] for c in cols if c in NEEDS}
        df = self.table("lineitem")
        attributes = attributes_of(per_customer)
        if "part" in tables:
            # While lines are narrow; behind the join on the order key they lie by order.
            df = df.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        if tables - {"part"} or attributes:
            orders = self._orders(tables)
            if attributes:
                # Joined to orders, so that lines are shuffled once, on the order key.
                of_customer = per_customer.select(F.col("customer_id").alias("_customer"), *[F.col(c).alias(f"_{c}") for c in attributes])
                orders = orders.join(of_customer, F.col("o_custkey") == F.col("_customer"), "left")
            df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        return df.select(*[EXPRESSIONS[c]().alias(c) for c in cols], *[F.col(f"_{c}").alias(c) for c in attributes])

    def _orders(self, tables: set[str]) -> DataFrame:
        orders = self.table("orders")
        if not tables & {"customer", "nation", "region"}:
            return orders
        customer = self.table("customer")
        if tables & {"nation", "region"}:
            nation = self.table("nation")
            if "region" in tables:
                nation = nation.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))


# column -> tables beyond the order lines it needs
NEEDS = {
    "order_date": "orders", "ship_date": "orders", "ship_mode": "orders", "customer_id": "orders",
    "customer_name": "customer", "segment": "customer", "postal_code": "customer", "profit": "customer",
    "city": "nation", "state": "nation", "region": "region",
    "product_name": "part", "category": "part", "sub_category": "part",
}


def _price() -> Column:
    # Whole-number cents keep the arithmetic exact and out of wide DECIMALs.
    return hundredths("l_extendedprice")


def _discount() -> Column:
    return hundredths("l_discount") * 8


def _sales() -> Column:
    return per_hundred(_price() * (100 - _discount()))


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def _ship_date() -> Column:
    days = F.pmod(F.datediff(F.col("l_shipdate").cast("date"), _order_date()), F.lit(8))
    return F.date_add(_order_date(), days)


def _profit() -> Column:
    return as_money(_sales() - per_hundred(_price() * (40 + 4 * (F.col("c_nationkey") % 10))))


def _postal_code() -> Column:
    """One city in twenty never has a code; the others have three."""
    area = F.col("c_custkey") % 20
    code = 501 + F.col("c_nationkey") * 1000 + area * 40 + F.col("c_custkey") % 3
    return F.when(area != 7, F.lpad(code.cast("string"), 5, "0"))


def _row_id() -> Column:
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return F.concat_ws("-", *keys, as_money(_price()).cast("string"))


EXPRESSIONS: dict[str, Callable[[], Column]] = {
    "row_id": _row_id,
    "order_id": lambda: F.col("l_orderkey"),
    "product_id": lambda: F.col("l_partkey"),
    "quantity": lambda: F.col("l_quantity").cast("int"),
    "discount": lambda: (_discount().cast("decimal(3,0)") * F.lit(CENT)).cast("decimal(4,2)"),
    "sales": lambda: as_money(_sales()),
    "profit": _profit,
    "raw_ship_date": lambda: F.col("l_shipdate").cast("date"),
    "order_date": _order_date,
    "ship_date": _ship_date,
    "ship_mode": lambda: F.col("o_orderpriority"),
    "customer_id": lambda: F.col("o_custkey"),
    "customer_name": lambda: F.col("c_name"),
    "segment": lambda: F.col("c_mktsegment"),
    "country": lambda: F.lit("United States"),
    "postal_code": _postal_code,
    "city": lambda: F.concat_ws("-", "n_name", (F.col("c_custkey") % 20).cast("string")),
    "state": lambda: F.col("n_name"),
    "region": lambda: F.col("r_name"),
    "product_name": lambda: F.col("p_name"),
    "category": lambda: F.col("p_type"),
    "sub_category": lambda: F.col("p_brand"),
}


class Warehouse(Star):
    """The star read back from the tables that the pipeline writes.

    The fact is partitioned by ``order_year``, which is read as it is stored: a predicate
    on it leaves out whole directories.
    """

    stored = ("order_year",)

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def products(self) -> DataFrame:
        return self.table("dim_product").select(*PRODUCT_COLS)

    def customers(self) -> DataFrame:
        return self.table("dim_customer").select(*CUSTOMER_COLS)

    def base_lines(self, *cols: str, per_customer: DataFrame | None = None) -> DataFrame:
        df = self.table("fact_sales")
        wanted = set(cols)
        for dim, key in (("dim_customer", "customer_id"), ("dim_product", "product_id"), ("dim_geography", "geo_id")):
            side = self.table(dim)
            extra = [c for c in side.columns if c in wanted and c not in df.columns]
            if extra:
                df = df.join(side.select(key, *extra), key)
        attributes = attributes_of(per_customer)
        if attributes:
            df = df.drop(*attributes).join(per_customer, "customer_id", "left")
        return df.select(*cols, *attributes)
