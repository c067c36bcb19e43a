"""Product category reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions import exact, mean, ratio
from mercatura.operators.fanout import COUNT, weighted, weighted_scores, with_review_weight


def product_categories(products: DataFrame, translation: DataFrame | None) -> DataFrame:
    """Products with ``category``: the English name if there is one, else the raw name."""
    raw = F.col("product_category_name")
    if translation is None:
        return products.select("product_id", "product_category_name", raw.alias("category"))
    names = translation.select("product_category_name", "product_category_name_english")
    # A product without a category has no translation: taken round the join, which would
    # gather all of them in one task.
    named = products.where(raw.isNotNull()).join(names, "product_category_name", "left")
    nameless = products.where(raw.isNull())
    return named.select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", raw).alias("category"),
    ).unionByName(nameless.select("product_id", "product_category_name", raw.alias("category")))


def category_totals(
    products: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    translation: DataFrame | None,
    one_review_per_order: bool = False,
) -> DataFrame:
    """Per category: products sold, orders, revenue, and sums for the means.

    Items meet the products straight from a shuffle (or a broadcast), so that AQE can split a
    hot product. They are folded to one row per order and category before they meet the
    reviews: an order holds no more rows than there are categories. The number of products
    needs no orders. It comes from the distinct product ids of the items, most of which fold
    on the map side.
    """
    named = product_categories(products, translation).select("product_id", "category")
    sold = (
        items.select("order_id", "product_id", exact(items, "price").alias("price"))
        .join(named, "product_id")
        .groupBy("order_id", "category")
        .agg(
            F.sum("price").alias("price"),
            F.count("price").cast(COUNT).alias("prices"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    reviewed = with_review_weight(sold, reviews, one_review_per_order=one_review_per_order)
    score_sum, scores = weighted_scores("rows")
    money = reviewed.groupBy("category").agg(
        F.count("order_id").alias("orders"),
        weighted("price").alias("price"),
        weighted("prices").alias("prices"),
        score_sum.alias("score_sum"),
        scores.alias("scores"),
    )
    on_sale = items.select("product_id").distinct()
    counted = (
        named.distinct()
        .join(on_sale, "product_id", "left_semi")
        .groupBy(F.col("category").alias("_category"))
        .agg(F.count_distinct("product_id").alias("products"))
    )
    return money.join(counted, F.col("category").eqNullSafe(F.col("_category"))).drop("_category")


def product_performance(
    products: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    translation: DataFrame | None,
    *,
    more_orders_than: int = 10,
    one_review_per_order: bool = False,
) -> DataFrame:
    """Per category: products, orders, revenue, mean price, mean rating."""
    totals = category_totals(products, items, reviews, translation, one_review_per_order)
    return product_report(totals, more_orders_than)


def product_report(totals: DataFrame, more_orders_than: int = 10) -> DataFrame:
    """Shape category totals into the product report."""
    return (
        totals.where(F.col("orders") > more_orders_than)
        .select(
            "category",
            F.col("products").alias("product_count"),
            F.col("orders").alias("order_count"),
            F.col("price").cast("double").alias("total_revenue"),
            mean("price", "prices").alias("avg_price"),
            mean("score_sum", "scores").alias("avg_rating"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_last())
    )


def category_analysis(
    products: DataFrame,
    items: DataFrame,
    reviews: DataFrame,
    translation: DataFrame | None,
    *,
    more_orders_than: int = 100,
    one_review_per_order: bool = False,
) -> DataFrame:
    """Per category: orders, products, revenue, mean rating, revenue per order.

    Without a translation table the raw category name is used.
    """
    totals = category_totals(products, items, reviews, translation, one_review_per_order)
    return category_report(totals, more_orders_than)


def category_report(totals: DataFrame, more_orders_than: int = 100) -> DataFrame:
    """Shape category totals into the category report."""
    return (
        totals.where(F.col("orders") > more_orders_than)
        .select(
            "category",
            F.col("orders").alias("total_orders"),
            F.col("products").alias("unique_products"),
            F.col("price").cast("double").alias("revenue"),
            mean("score_sum", "scores").alias("avg_rating"),
            ratio("price", "orders").alias("avg_order_value"),
        )
        .orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last())
    )


def top_categories(report: DataFrame, n: int = 10) -> DataFrame:
    """Name, revenue and rating of the first ``n`` categories by revenue."""
    return (
        report.orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last())
        .limit(n)
        .select("category", "revenue", "avg_rating")
    )
