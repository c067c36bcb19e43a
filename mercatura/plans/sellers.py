"""Seller performance with quintiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercatura.functions import MICROS_PER_HOUR, elapsed, exact, mean, mean_elapsed
from mercatura.operators.fanout import COUNT, weighted, weighted_scores, with_review_weight
from mercatura.operators.selection import SortKey, with_tiles
from mercatura.plans.sales import PURCHASED, ordered_items

SHIPPED_AT = "order_delivered_carrier_date"

QUINTILES = 5

# The numeric columns of the report, in order.
METRICS = (
    "total_orders",
    "unique_products",
    "revenue",
    "avg_rating",
    "avg_shipping_time",
    "revenue_quintile",
    "rating_quintile",
)


def seller_metrics(
    sellers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    *,
    one_review_per_order: bool = False,
    products: bool = True,
) -> DataFrame:
    """Per seller: orders, products, revenue, mean rating, mean shipping time in hours.

    The items are read and shuffled once, by order, and folded to one row per order, seller and
    product on that partitioning, before and after which they meet the orders and the reviews.
    One row of each order and seller is marked there, so that the distinct counts become a sum of
    marks and a count of product rows. Without ``products`` the fold is to orders and sellers
    alone. Sellers join at the end, one row per seller.
    """
    listed = ["product_id"] if products else []
    facts = ordered_items(
        orders,
        items.withColumn("price", exact(items, "price")),
        [PURCHASED],
        ["seller_id", *listed, "price"],
        [SHIPPED_AT],
    )
    per_order = (
        facts.withColumn("seconds", elapsed(PURCHASED, SHIPPED_AT))
        .groupBy("order_id", "seller_id", *listed)
        .agg(
            F.sum("price").alias("price"),
            F.sum("seconds").alias("seconds"),
            F.count("seconds").cast(COUNT).alias("timed"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    reviewed = with_review_weight(per_order, reviews, one_review_per_order=one_review_per_order)
    score_sum, scores = weighted_scores("rows")
    sums = {
        "price": weighted("price"),
        "score_sum": score_sum,
        "scores": scores,
        "seconds": weighted("seconds"),
        "timed": weighted("timed"),
    }
    if products:
        first = F.row_number().over(Window.partitionBy("order_id", "seller_id").orderBy("product_id"))
        sold = (
            reviewed.withColumn("first", (first == 1).cast("long"))
            .groupBy("seller_id", "product_id")
            .agg(F.sum("first").alias("orders"), *[v.alias(k) for k, v in sums.items()])
            .groupBy("seller_id")
            .agg(
                F.sum("orders").alias("total_orders"),
                F.count("product_id").alias("unique_products"),
                *[F.sum(k).alias(k) for k in sums],
            )
        )
    else:
        sold = reviewed.groupBy("seller_id").agg(
            F.count("order_id").alias("total_orders"), *[v.alias(k) for k, v in sums.items()]
        )
    # Repeated seller rows multiply the revenue; means and distinct counts are unaffected.
    shops = sellers.groupBy("seller_id", "seller_state").agg(
        F.count(F.lit(1)).cast(COUNT).alias("copies")
    )
    return shops.join(sold, "seller_id").select(
        "seller_id",
        "seller_state",
        "total_orders",
        *(["unique_products"] if products else []),
        (F.col("price") * F.col("copies")).cast("double").alias("revenue"),
        mean("score_sum", "scores").alias("avg_rating"),
        mean_elapsed("seconds", "timed", MICROS_PER_HOUR).alias("avg_shipping_time"),
    )


def seller_performance(
    sellers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    *,
    orders_at_least: int = 10,
    one_review_per_order: bool = False,
) -> DataFrame:
    """Seller metrics with revenue and rating quintiles over the sellers with enough orders.

    Quintile 1 holds the highest values; a missing value counts as highest, and the seller
    id breaks ties.
    """
    metrics = seller_metrics(
        sellers, items, orders, reviews, one_review_per_order=one_review_per_order
    )
    enough = metrics.where(F.col("total_orders") >= orders_at_least)
    tie = [SortKey("seller_id", nulls_first=False), SortKey("seller_state", nulls_first=False)]
    orders_by = {
        name: [SortKey(value, descending=True), *tie]
        for value, name in (("revenue", "revenue_quintile"), ("avg_rating", "rating_quintile"))
    }
    return with_tiles(enough, QUINTILES, orders_by)
