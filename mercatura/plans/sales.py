"""Monthly sales reports over delivered orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercatura.functions import (
    MICROS_PER_DAY,
    WHOLE,
    elapsed,
    exact,
    mean_elapsed,
    month_of,
    ratio,
    since_epoch,
)
from mercatura.operators.folding import fold_for_join

PURCHASED = "order_purchase_timestamp"
DELIVERED_AT = "order_delivered_customer_date"


def ordered_items(
    orders: DataFrame,
    items: DataFrame,
    order_columns: Sequence[str],
    item_columns: Sequence[str],
    dates: Sequence[str] = (),
) -> DataFrame:
    """Items joined to their orders, with the named columns of each side.

    A column in ``dates`` may sit on either table; the order's wins. Both sides enter the
    join straight from a shuffle (or a broadcast, if small enough), which is what lets AQE
    split a hot ``order_id`` on whichever side it occurs.
    """
    on_order = [c for c in dates if c in orders.columns]
    on_item = [c for c in dates if c not in orders.columns]
    left = items.select("order_id", *item_columns, *on_item)
    right = orders.select("order_id", *order_columns, *on_order)
    return left.join(right, "order_id")


def delivered_items(
    orders: DataFrame, items: DataFrame, delivered: str = "delivered"
) -> DataFrame:
    """Items of delivered orders with what the monthly reports need. ``items`` may be a stream."""
    return ordered_items(
        orders.where(F.col("order_status") == delivered),
        items.withColumns(
            {"price": exact(items, "price"), "freight_value": exact(items, "freight_value")}
        ),
        ["customer_id", PURCHASED],
        ["price", "freight_value"],
        [DELIVERED_AT],
    )


def item_sums(items: DataFrame) -> DataFrame:
    """One row per order: number of items, price and freight, and delivery dates if items have any.

    Runs before the join, so that an order with very many items is one row in it.
    """
    sums = [
        F.count(F.lit(1)).cast(WHOLE).alias("items"),
        F.sum(exact(items, "price")).alias("price"),
        F.sum(exact(items, "freight_value")).alias("freight_value"),
    ]
    if DELIVERED_AT in items.columns:
        sums += [
            F.sum(since_epoch(DELIVERED_AT)).alias("delivered_seconds"),
            F.count(DELIVERED_AT).cast(WHOLE).alias("delivered_items"),
        ]
    return fold_for_join(items, "order_id", *sums)


def refold_items(parts: DataFrame) -> DataFrame:
    """Add up rows of ``item_sums`` that were made from parts of the items."""
    sums = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in parts.columns if c != "order_id"]
    return fold_for_join(parts, "order_id", *sums)


def order_sales(orders: DataFrame, items: DataFrame, delivered: str = "delivered") -> DataFrame:
    """Delivered orders that have items, with the sums over them."""
    kept = items.drop(DELIVERED_AT) if DELIVERED_AT in orders.columns else items
    return sales_of_folds(orders, item_sums(kept), delivered)


def sales_of_folds(orders: DataFrame, folds: DataFrame, delivered: str = "delivered") -> DataFrame:
    """``order_sales`` from rows of ``item_sums``, one for each order.

    ``seconds`` adds up the delivery time once per item, ``timed`` counts the items that have
    one. Dates on the order hold for each of its items; without any dates both are empty.
    """
    on_order = DELIVERED_AT in orders.columns
    on_item = not on_order and "delivered_items" in folds.columns
    bought = orders.where(F.col("order_status") == delivered).select(
        "order_id", "customer_id", PURCHASED, *([DELIVERED_AT] if on_order else [])
    )
    if on_order:
        taken = elapsed(PURCHASED, DELIVERED_AT)
        seconds = taken * F.col("items")
        timed = F.when(taken.isNotNull(), F.col("items"))
    elif on_item:
        start = since_epoch(PURCHASED)
        seconds = F.col("delivered_seconds") - F.col("delivered_items") * start
        timed = F.when(start.isNotNull(), F.col("delivered_items"))
    else:
        seconds, timed = (F.lit(None).cast(WHOLE) for _ in range(2))
    return (
        folds.join(bought, "order_id")
        .select(
            "order_id",
            "customer_id",
            month_of(PURCHASED).alias("month"),
            "price",
            "freight_value",
            seconds.alias("seconds"),
            timed.alias("timed"),
        )
    )


def fold_to_orders(facts: DataFrame) -> DataFrame:
    """The rows of ``order_sales`` from a table of delivered items."""
    return (
        facts.withColumns(
            {"month": month_of(PURCHASED), "seconds": elapsed(PURCHASED, DELIVERED_AT)}
        )
        .groupBy("order_id", "customer_id", "month")
        .agg(
            F.sum("price").alias("price"),
            F.sum("freight_value").alias("freight_value"),
            F.sum("seconds").alias("seconds"),
            F.count("seconds").cast(WHOLE).alias("timed"),
        )
    )


def monthly_totals(per_order: DataFrame) -> DataFrame:
    """Per month of purchase: distinct orders and customers, exact sums, delivery time.

    Only one row per order takes part, not one per item. Spark folds the distinct ids before
    it shuffles them, by month and id, so neither a hot order nor a hot customer gathers.
    """
    return per_order.groupBy("month").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.sum("price").cast("double").alias("revenue"),
        F.sum("freight_value").cast("double").alias("freight"),
        mean_elapsed(F.sum("seconds"), F.sum("timed"), MICROS_PER_DAY).alias("delivery_days"),
    )


def monthly_sales(orders: DataFrame, items: DataFrame, delivered: str = "delivered") -> DataFrame:
    return monthly_totals(order_sales(orders, items, delivered))


def sales_patterns(orders: DataFrame, items: DataFrame, delivered: str = "delivered") -> DataFrame:
    """Orders, revenue and customers per month, with value per order and per customer."""
    return sales_report(monthly_sales(orders, items, delivered))


def sales_report(monthly: DataFrame) -> DataFrame:
    """Shape monthly totals into the sales report."""
    return (
        monthly.select(
            "month",
            F.col("orders").alias("order_count"),
            "revenue",
            F.col("customers").alias("customer_count"),
            ratio("revenue", "orders").alias("avg_order_value"),
            ratio("revenue", "customers").alias("revenue_per_customer"),
        )
        .orderBy(F.col("month").asc_nulls_last())
    )


def with_growth(monthly: DataFrame) -> DataFrame:
    """Add the previous month's revenue and the growth over it in percent.

    "Previous" is the previous row, not the previous calendar month. The window is one task,
    over one row per month.
    """
    by_month = Window.orderBy(F.col("month").asc_nulls_last())
    previous = F.col("prev_month_revenue")
    return monthly.withColumn("prev_month_revenue", F.lag("revenue").over(by_month)).withColumn(
        "revenue_growth", ratio(F.col("revenue") - previous, previous) * 100.0
    )


def growth_report(monthly: DataFrame) -> DataFrame:
    """Shape monthly totals into the time report."""
    named = monthly.select(
        "month",
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        "revenue",
        F.col("freight").alias("freight_cost"),
        F.col("delivery_days").alias("avg_delivery_days"),
        ratio("revenue", "orders").alias("avg_order_value"),
    )
    return with_growth(named).orderBy(F.col("month").asc_nulls_last())


def check_delivery_dates(orders: DataFrame, items: DataFrame) -> None:
    if DELIVERED_AT not in orders.columns and DELIVERED_AT not in items.columns:
        raise ValueError(f"neither orders nor items have {DELIVERED_AT}")


def time_metrics(orders: DataFrame, items: DataFrame, delivered: str = "delivered") -> DataFrame:
    """Monthly orders, customers, revenue, freight, delivery time, order value and growth."""
    check_delivery_dates(orders, items)
    return growth_report(monthly_sales(orders, items, delivered))


def latest_months(report: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` rows of a monthly report, oldest first.

    A NULL month sorts last, so it is among them.
    """
    return (
        report.orderBy(F.col("month").desc_nulls_first())
        .limit(n)
        .orderBy(F.col("month").asc_nulls_last())
    )
