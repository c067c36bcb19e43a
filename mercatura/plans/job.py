"""The whole run: load, profile, lay out, report, write plot data, print summaries."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.operators.cleaning import parse_dates
from mercatura.operators.describe import describe
from mercatura.operators.quality import (
    Reference,
    Watch,
    duplicate_count,
    validate,
    validate_references,
)
from mercatura.plans import plots
from mercatura.plans.customers import customer_behavior
from mercatura.plans.products import (
    category_report,
    category_totals,
    product_report,
    top_categories,
)
from mercatura.plans.sales import (
    check_delivery_dates,
    growth_report,
    latest_months,
    monthly_sales,
    sales_report,
)
from mercatura.plans.sellers import METRICS, seller_performance
from mercatura.schema import SCHEMAS, Tables
from mercatura.session import checkpointed, tune
from mercatura.sources.csv_files import clean_table, load_files, typed
from mercatura.sources.layout import BY_TIME, LOOKUP_KEYS, TIME_KEY, write_by_time, write_layout
from mercatura.sources.tables import bundle, qualified, replace_folder

log = logging.getLogger(__name__)

# The input tables and their usual file names.
DATA_FILES = {
    "customers": "customers_dataset.csv",
    "orders": "orders_dataset.csv",
    "order_items": "order_items_dataset.csv",
    "products": "products_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "order_reviews": "order_reviews_dataset.csv",
    "order_payments": "order_payments_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}

# The column or columns that should be unique, where the reports rely on them meaning one thing.
KEYS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
}


def data_paths(folder: str, files: Mapping[str, str] = DATA_FILES) -> dict[str, str]:
    return {name: f"{folder.rstrip('/')}/{file}" for name, file in files.items()}


def standard_rules(tables: Tables) -> dict[str, dict[str, Column]]:
    """Checks per table; see ``quality.validate``."""
    rules = {
        "orders": {
            "order has a customer": F.col("customer_id").isNotNull(),
            "order has a purchase time": F.col("order_purchase_timestamp").isNotNull(),
        },
        "order_items": {
            "price is not negative": F.col("price") >= 0,
            "freight is not negative": F.col("freight_value") >= 0,
        },
        "order_reviews": {"score is 1 to 5": F.col("review_score").between(1, 5)},
        "products": {"product has a category": F.coalesce("product_category_name", F.lit("")) != ""},
    }
    present = tables.present()
    return {name: checks for name, checks in rules.items() if name in present}


REFERENCES = [
    Reference(f"{key} is in {parent}", child, parent, key)
    for child, parent, key in (
        ("order_items", "orders", "order_id"),
        ("order_items", "products", "product_id"),
        ("order_items", "sellers", "seller_id"),
        ("orders", "customers", "customer_id"),
        ("order_reviews", "orders", "order_id"),
    )
]


def validation(tables: Tables, watched: Mapping[str, Watch] | None = None) -> DataFrame:
    """Pass rate of the standard rules and of the references between tables. What was watched when it
    was written is not read again for the rules."""
    present = tables.present()
    joined = validate_references(present, REFERENCES)
    for name, checks in standard_rules(tables).items():
        rates = watched[name].validation() if watched else validate(present[name], checks)
        joined = joined.unionByName(rates.withColumn("table_name", F.lit(name)))
    return joined.select("table_name", "rule", "checked_rows", "passed_rows", "pass_rate")


def _dates(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]


def quality_report(
    raw: Mapping[str, Watch], clean: Mapping[str, Watch], stored: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """NULLs as read and as stored, incomplete rows, date ranges, all from the passes that wrote the
    tables; and duplicate keys."""
    report = {f"null_reduction/{name}": seen.null_reduction(clean[name]) for name, seen in raw.items()}
    for name, df in stored.items():
        report[f"columns/{name}"] = clean[name].column_profile()
        if name in KEYS:
            report[f"duplicates/{name}"] = duplicate_count(df, KEYS[name])
        if _dates(df):
            report[f"date_ranges/{name}"] = clean[name].date_ranges()
    return report


@dataclass(frozen=True)
class Reports:
    sales: DataFrame
    time: DataFrame
    customers: DataFrame
    products: DataFrame
    categories: DataFrame
    sellers: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {
            "sales_patterns": self.sales,
            "time_metrics": self.time,
            "customer_behavior": self.customers,
            "product_performance": self.products,
            "category_analysis": self.categories,
            "seller_performance": self.sellers,
        }


def build_reports(
    tables: Tables,
    *,
    delivered: str = "delivered",
    share: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Reports:
    """All reports. ``share`` is applied to the monthly and the category totals, which two
    reports each are made of: pass ``checkpointed`` to compute them once."""
    t = tables
    check_delivery_dates(t.orders, t.order_items)
    monthly = share(monthly_sales(t.orders, t.order_items, delivered))
    by_category = share(
        category_totals(t.products, t.order_items, t.order_reviews, t.category_translation)
    )
    return Reports(
        sales=sales_report(monthly),
        time=growth_report(monthly),
        customers=customer_behavior(t.customers, t.orders, t.order_items),
        products=product_report(by_category),
        categories=category_report(by_category),
        sellers=seller_performance(t.sellers, t.order_items, t.orders, t.order_reviews),
    )


def run(
    spark: SparkSession,
    paths: Mapping[str, str],
    out_dir: str,
    *,
    delivered: str = "delivered",
    on_missing: str = "error",
    clean: bool = True,
    buckets: int | None = None,
    database: str | None = None,
    multi_line: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Run everything and write it under ``out_dir``; returns the written reports.

    Every CSV is parsed once and lands as parquet of text. Typing, cleaning and profiles read
    that, the reports what typing and cleaning made of it. With ``buckets`` the cleaned tables
    become catalog tables bucketed for the joins; otherwise they are parquet folders. A table in
    ``multi_line`` may hold quoted line breaks, at the price of one task per file.
    """
    tune(spark)
    out = out_dir.rstrip("/")
    raw, before = {}, {}
    for name, df in load_files(spark, paths, on_missing=on_missing, multi_line=multi_line).items():
        before[name] = Watch(df)
        replace_folder(before[name].on(df), f"{out}/raw/{name}")
        raw[name] = spark.read.schema(df.schema).parquet(f"{out}/raw/{name}")
    types = {name: typed(df, SCHEMAS.get(name)) for name, df in raw.items()}
    loaded = {name: clean_table(df) if clean else parse_dates(df) for name, df in types.items()}
    rules = standard_rules(bundle(loaded))
    watched = {
        name: Watch(df, dates=_dates(df), rules=rules.get(name)) for name, df in loaded.items()
    }
    if buckets is None:
        for name, df in loaded.items():
            replace_folder(watched[name].on(df), f"{out}/tables/{name}")
        stored = {
            name: spark.read.schema(df.schema).parquet(f"{out}/tables/{name}") for name, df in loaded.items()
        }
    else:
        write_layout(loaded, buckets, database, watch=lambda name, df: watched[name].on(df))
        stored = {name: spark.table(qualified(name, database)) for name in loaded}
        if TIME_KEY in _dates(stored["orders"]):
            write_by_time(
                stored["orders"], f"orders{BY_TIME}", database=database, lookups=LOOKUP_KEYS["orders"]
            )

    tables = bundle(stored)
    for name, df in quality_report(before, watched, stored).items():
        replace_folder(df, f"{out}/quality/{name}")
    replace_folder(validation(tables, watched), f"{out}/quality/validation")

    reports = build_reports(tables, delivered=delivered, share=checkpointed)
    written = {}
    for name, df in reports.named().items():
        replace_folder(df, f"{out}/reports/{name}")
        written[name] = spark.read.schema(df.schema).parquet(f"{out}/reports/{name}")

    sellers = written["seller_performance"]
    plots.write_plot_data(
        {
            "revenue_trend": plots.revenue_trend(written["time_metrics"]),
            "customers_by_state": plots.customers_by_state(written["customer_behavior"]),
            "category_scatter": plots.category_scatter(written["category_analysis"]),
            "rating_box": plots.rating_box(sellers),
            "rating_outliers": plots.rating_outliers(sellers),
        },
        f"{out}/plots",
    )
    summary = describe(sellers, METRICS)
    replace_folder(summary, f"{out}/reports/seller_summary")
    written["seller_summary"] = spark.read.schema(summary.schema).parquet(
        f"{out}/reports/seller_summary"
    )
    return written


def top_states(behavior: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` states by customers."""
    return behavior.orderBy(
        F.col("customer_count").desc(), F.col("customer_state").asc_nulls_last()
    ).limit(n)


def top_products(performance: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` categories of the product report."""
    return performance.orderBy(
        F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_last()
    ).limit(n)


def show_summaries(reports: Mapping[str, DataFrame]) -> None:
    """Print the head or tail of each report, as a run's last step."""
    latest_months(reports["sales_patterns"]).show(truncate=False)
    top_states(reports["customer_behavior"]).show(truncate=False)
    top_products(reports["product_performance"]).show(truncate=False)
    latest_months(reports["time_metrics"]).show(truncate=False)
    top_categories(reports["category_analysis"]).show(truncate=False)
    reports["seller_summary"].show(truncate=False)
