"""The rows behind each chart. Drawing is left to whatever reads them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercatura.operators.describe import box_outliers, box_stats


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """Line: month, revenue."""
    return monthly.select("month", "revenue").orderBy(F.col("month").asc_nulls_last())


def customers_by_state(behavior: DataFrame) -> DataFrame:
    """Bars: state, customers, largest first."""
    return behavior.select("customer_state", "customer_count").orderBy(
        F.col("customer_count").desc(), F.col("customer_state").asc_nulls_last()
    )


def category_scatter(categories: DataFrame, n: int = 20) -> DataFrame:
    """Points: revenue, rating and orders of the first ``n`` categories by revenue."""
    return (
        categories.orderBy(F.col("revenue").desc_nulls_first(), F.col("category").asc_nulls_last())
        .limit(n)
        .select("category", "revenue", "avg_rating", "total_orders")
    )


def rating_box(sellers: DataFrame) -> DataFrame:
    """Boxes: seller rating per revenue quintile."""
    return box_stats(sellers, "revenue_quintile", "avg_rating")


def rating_outliers(sellers: DataFrame) -> DataFrame:
    """Single points beyond the whiskers of ``rating_box``."""
    return box_outliers(sellers, "revenue_quintile", "avg_rating", "seller_id")


def write_plot_data(plots: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Write each chart's rows to its own sub-folder, replacing what is there."""
    for name, rows in plots.items():
        writer = rows.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{folder.rstrip('/')}/{name}")
