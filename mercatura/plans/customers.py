"""Customer behaviour per state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.functions import exact, mean, total
from mercatura.operators.fanout import COUNT
from mercatura.operators.folding import fold_for_join
from mercatura.plans.sales import PURCHASED

# An average of averages is taken over values fixed to nine places, so that it is exact too.
_PLACES = 9


def _per_customer(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    price = exact(items, "price")
    paid = fold_for_join(
        items, "order_id", F.sum(price).alias("_price"), F.count(price).alias("_prices")
    )
    bought = orders.select("order_id", "customer_id", PURCHASED)
    # One row per order and customer, on the partitioning of the join.
    per_order = (
        paid.join(bought, "order_id")
        .groupBy("order_id", "customer_id")
        .agg(
            F.sum("_price").alias("_price"),
            F.sum("_prices").alias("_prices"),
            F.min(PURCHASED).alias("_first"),
            F.max(PURCHASED).alias("_last"),
        )
    )
    spent = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("_price").alias("_price"),
        F.sum("_prices").alias("_prices"),
        F.min("_first").alias("first_order"),
        F.max("_last").alias("last_order"),
    )
    # Customers join last, one row against one row. Repeated customer rows multiply the spend.
    people = customers.groupBy("customer_id", "customer_state").agg(
        F.count(F.lit(1)).cast(COUNT).alias("_copies")
    )
    return people.join(spent, "customer_id").select(
        "customer_id",
        "customer_state",
        "order_count",
        (F.col("_price") * F.col("_copies")).alias("_spend"),
        mean("_price", "_prices").alias("avg_order_value"),
        "first_order",
        "last_order",
    )


def customer_metrics(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per customer: orders, spend, mean item price (``avg_order_value``), first and last order."""
    return _per_customer(customers, orders, items).select(
        "customer_id",
        "customer_state",
        "order_count",
        F.col("_spend").cast("double").alias("total_spend"),
        "avg_order_value",
        "first_order",
        "last_order",
    )


def customer_behavior(customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per state: customers with orders, and unweighted means over them."""
    value = F.round("avg_order_value", _PLACES).cast(f"decimal(24,{_PLACES})")
    return (
        _per_customer(customers, orders, items)
        .withColumn("_value", value)
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            mean(total("order_count"), F.count("order_count")).alias("avg_orders_per_customer"),
            mean(F.sum("_spend"), F.count("_spend")).alias("avg_customer_value"),
            mean(F.sum("_value"), F.count("_value")).alias("avg_order_value"),
        )
        .orderBy(F.col("customer_count").desc(), F.col("customer_state").asc_nulls_last())
    )
