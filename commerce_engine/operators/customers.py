"""Customer profile: lifetime behaviour, value tier and RFM scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import mean, percent, qcut, ratio
from ..functions.quantiles import exact_quantiles
from ..functions.ranking import with_global_position
from ..session import materialize

KEYS = ["customer_id", "customer_name", "segment"]
QUINTILES = [0.2, 0.4, 0.6, 0.8]

# Segment labels in their natural order.
RFM_SEGMENTS = ["Champion", "Loyal", "Potential", "At Risk"]

PROFILE_INPUTS = [*KEYS, "order_id", "order_date", "product_id", "sales", "profit", "quantity", "discount"]


def lifetime_totals(lines: DataFrame) -> DataFrame:
    """One row per (id, name, segment); rows without a full key are left out.

    Two distinct counts in one aggregation would triple the lines before their shuffle. Here
    lines are summed by order, where a source keeps them by order, and each customer's distinct
    products are a second reading of two narrow columns; both meet as rows of one union.
    """
    known = lines.dropna(subset=KEYS)
    sums = {"sales": "lifetime_value", "profit": "lifetime_profit", "quantity": "lifetime_units"}
    by_order = known.groupBy(*KEYS, "order_id").agg(
        *[F.sum(c).alias(name) for c, name in sums.items()],
        F.sum("discount").alias("_discount"),
        F.count("discount").alias("_discounts"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )
    bought = known.select(*KEYS, "product_id").distinct()
    # A sum of sums keeps the type of the sums.
    types = dict(by_order.dtypes)
    return (
        by_order.unionByName(bought, allowMissingColumns=True)
        .groupBy(*KEYS)
        .agg(
            F.count("order_id").alias("lifetime_orders"),
            *[F.sum(name).cast(types[name]).alias(name) for name in sums.values()],
            ratio(F.sum("_discount"), F.sum("_discounts")).alias("avg_discount"),
            F.min("first_order").alias("first_order"),
            F.max("last_order").alias("last_order"),
            F.count("product_id").alias("distinct_products"),
        )
    )


def customer_profile(lines: DataFrame) -> DataFrame:
    """The 22-column profile.

    The per-customer totals are written once and every later pass (snapshot date,
    quintile edges, order-count positions) reads that table instead of the lines.
    """
    return score_customers(materialize(lifetime_totals(lines), "lifetime"))


def score_customers(totals: DataFrame) -> DataFrame:
    whole = totals.agg(F.struct(F.max("last_order").alias("newest"), F.count("*").alias("customers"))).scalar()
    dated = _dated(totals, whole)
    edges = exact_quantiles(dated, ["recency_days", "lifetime_value"], QUINTILES).agg(
        F.struct(
            F.max_by("q", F.col("measure") == "recency_days").alias("recency"),
            F.max_by("q", F.col("measure") == "lifetime_value").alias("value"),
        )
    )
    scored = (
        with_global_position(totals, ["lifetime_orders", *KEYS], "_place")
        .transform(_dated, whole)
        .withColumn("_edges", edges.scalar())
        .withColumns(
            {
                "is_high_value": F.col("lifetime_value").cast("double") >= F.col("_edges.value")[3],
                "r_score": _score("recency_days", "recency", [5, 4, 3, 2, 1]),
                "f_score": position_quintile("_place", F.col("_whole.customers")),
                "m_score": _score("lifetime_value", "value", [1, 2, 3, 4, 5]),
            }
        )
    )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_score", total).withColumn("rfm_segment", rfm_segment(F.col("rfm_score"))).select(
        *KEYS, "lifetime_orders", "lifetime_value", "lifetime_profit", "lifetime_units", "avg_discount",
        "first_order", "last_order", "distinct_products", "avg_order_value", "profit_margin", "tenure_days",
        "recency_days", "is_repeat", "is_high_value", "r_score", "f_score", "m_score", "rfm_score", "rfm_segment",
    )


def _dated(totals: DataFrame, whole) -> DataFrame:
    return totals.withColumn("_whole", whole).withColumns(
        {
            "avg_order_value": ratio(F.col("lifetime_value"), F.col("lifetime_orders")),
            "profit_margin": percent(F.col("lifetime_profit"), F.col("lifetime_value")),
            "tenure_days": F.datediff("last_order", "first_order"),
            "recency_days": F.datediff(F.date_add("_whole.newest", 1), "last_order"),
            "is_repeat": F.col("lifetime_orders") > 1,
        }
    )


def _score(measure: str, edges: str, labels: list[int]):
    return qcut(F.col(measure).cast("double"), [F.col(f"_edges.{edges}")[i] for i in range(4)], labels)


def position_quintile(place: str, n):
    """Quintile 1..5 of the position among ``n`` rows, with interpolated edges."""
    steps = (F.col(place) - 1) * 5
    gaps = F.greatest(n - 1, F.lit(1))
    return F.greatest(F.lit(1), F.ceil(steps / gaps)).cast("int")


def rfm_segment(score):
    champion, loyal, potential, at_risk = RFM_SEGMENTS
    return F.when(score >= 13, champion).when(score >= 10, loyal).when(score >= 7, potential).otherwise(at_risk)


def rfm_rollup(profile: DataFrame) -> DataFrame:
    """Customers, revenue, average orders and recency, share of revenue by segment."""
    by = profile.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"),
        F.sum("lifetime_value").alias("revenue"),
        mean("lifetime_orders").alias("avg_orders"),
        mean("recency_days").alias("avg_recency"),
    )
    total = F.sum("revenue").over(Window.partitionBy())
    return by.withColumn("pct_revenue", percent(F.col("revenue"), total)).orderBy(F.desc("revenue"))


def high_value_share(profile: DataFrame) -> DataFrame:
    flag = F.col("is_high_value")
    return profile.agg(
        F.count_if(flag).alias("high_value_customers"),
        ratio(F.count_if(flag), F.count("*")).alias("share_of_customers"),
        ratio(F.sum(F.when(flag, F.col("lifetime_value"))), F.sum("lifetime_value")).alias("share_of_revenue"),
    )
