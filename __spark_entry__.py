"""

Each query runs a library function over the given tables; each SQL string says the same in
DuckDB, in the plain form (row-multiplying left joins, built-in NTILE and quantiles), so the
two sides share no method.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.functions import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    elapsed,
    micros,
    month_of,
    ratio,
)
from mercatura.operators import cleaning, quality
from mercatura.operators.describe import box_outliers, describe
from mercatura.operators.fanout import weighted_row, weighted_row_scores, with_review_weight
from mercatura.operators.ranking import ntile
from mercatura.operators.selection import SortKey, with_tiles
from mercatura.plans import job, plots
from mercatura.plans.customers import customer_behavior, customer_metrics
from mercatura.plans.job import top_products, top_states
from mercatura.plans.products import (
    category_analysis,
    product_categories,
    product_performance,
    top_categories,
)
from mercatura.plans.sales import (
    growth_report,
    latest_months,
    monthly_sales,
    monthly_totals,
    ordered_items,
    sales_patterns,
    time_metrics,
    with_growth,
)
from mercatura.plans.sellers import METRICS, seller_metrics, seller_performance
from mercatura.schema import SCHEMAS
from mercatura.session import scratch_path, tune
from mercatura.sources import star_sample
from mercatura.sources.csv_files import clean_table, read_clean, read_plain, write_csv
from mercatura.sources.layout import BY_TIME, between, write_by_time, write_layout
from mercatura.sources.star_sample import DELIVERED, StarSample
from mercatura.sources.tables import replace_table, table_or_none
from mercatura.streaming import (
    daily_sales,
    estimated_customers,
    latest_orders,
    order_sales_stream,
    stream_parquet,
)

# The corpus subpackage is optional; everything else works without it.
corpus = corpus_pipeline = None


def _is_there(name: str) -> bool:
    """Whether there is a module, not just a folder of its name. What fails inside it should raise."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


if _is_there("mercatura.llm") and _is_there("corpus_pipeline"):
    import corpus_pipeline
    from mercatura.llm import queries as corpus

SMOKE_DIR = "/root/testdata/sf0.001"

# Orders a seller needs in the second form of the seller report; splits the sample's sellers.
MANY_ORDERS = 590

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark: SparkSession, sf_dir: str) -> StarSample:
    return StarSample(tune(spark), sf_dir)


def _on_tables(build: Callable[[StarSample], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_tables(spark, sf_dir))


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


# Reports -----------------------------------------------------------------------------------


def _sales(t: StarSample) -> DataFrame:
    return sales_patterns(t.orders, t.order_items, DELIVERED)


def _time(t: StarSample) -> DataFrame:
    return time_metrics(t.orders, t.order_items, DELIVERED)


def _behavior(t: StarSample) -> DataFrame:
    return customer_behavior(t.customers, t.orders, t.order_items)


def _products(t: StarSample, **options) -> DataFrame:
    return product_performance(
        t.products, t.order_items, t.order_reviews, t.category_translation, **options
    )


def _categories(t: StarSample, **options) -> DataFrame:
    return category_analysis(
        t.products, t.order_items, t.order_reviews, t.category_translation, **options
    )


def _sellers(t: StarSample, **options) -> DataFrame:
    return seller_performance(t.sellers, t.order_items, t.orders, t.order_reviews, **options)


def _seller_revenue(t: StarSample) -> DataFrame:
    return seller_metrics(t.sellers, t.order_items, t.orders, t.order_reviews, products=False)


# Joins, aggregates, windows, scalars ---------------------------------------------------------


def _join_orders_items(t: StarSample) -> DataFrame:
    return ordered_items(
        t.orders, t.order_items, ["customer_id", "order_status"], ["order_item_id", "price"]
    )


def _left_join_reviews(t: StarSample) -> DataFrame:
    """What the row-multiplying left join holds per order and product."""
    folded = t.order_items.groupBy("order_id", "product_id").agg(
        F.sum("price").alias("price"), F.count(F.lit(1)).alias("rows")
    )
    # Each order and product is one row before the join and after it: nothing is left to add up.
    score_sum, scores = weighted_row_scores("rows")
    return with_review_weight(folded, t.order_reviews).select(
        "order_id",
        "product_id",
        weighted_row("rows").cast("long").alias("joined_rows"),
        weighted_row("price").cast("double").alias("joined_price"),
        score_sum.cast("long").alias("score_sum"),
        scores.cast("long").alias("scores"),
    )


def _count_distinct(t: StarSample) -> DataFrame:
    return t.order_items.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("product_id").alias("products"),
    )


def _window_lag(t: StarSample) -> DataFrame:
    monthly = monthly_sales(t.orders, t.order_items, DELIVERED).select("month", "revenue")
    return with_growth(monthly).select("month", "revenue", "prev_month_revenue")


def _window_ntile(value: str, name: str) -> Query:
    def build(t: StarSample) -> DataFrame:
        rows = _seller_revenue(t).select("seller_id", value)
        order = [F.col(value).desc_nulls_first(), F.col("seller_id").asc_nulls_last()]
        return ntile(rows, 5, order, name)

    return _on_tables(build)


def _window_tiles(value: str, name: str) -> Query:
    """The same tiles from the rows at which they begin."""

    def build(t: StarSample) -> DataFrame:
        rows = _seller_revenue(t).select("seller_id", value)
        keys = [SortKey(value, descending=True), SortKey("seller_id", nulls_first=False)]
        return with_tiles(rows, 5, {name: keys})

    return _on_tables(build)


def _elapsed(t: StarSample) -> DataFrame:
    joined = ordered_items(
        t.orders,
        t.order_items,
        ["order_purchase_timestamp"],
        ["order_item_id", "product_id"],
        ["order_delivered_carrier_date"],
    )
    taken = micros(elapsed("order_purchase_timestamp", "order_delivered_carrier_date")).cast("double")
    return joined.select(
        "order_id",
        "order_item_id",
        "product_id",
        (taken / F.lit(MICROS_PER_DAY)).alias("days"),
        (taken / F.lit(MICROS_PER_HOUR)).alias("hours"),
    )


def _safe_ratio(t: StarSample) -> DataFrame:
    """Freight is 0 for untaxed items, so some denominators are."""
    return t.order_items.select(
        "order_id", "order_item_id", ratio("price", "freight_value").alias("price_per_freight")
    )


# Cleaning and loading ------------------------------------------------------------------------


def _text_dates(t: StarSample) -> DataFrame:
    """Orders as a text file would hold them: blank dates, and one column that cannot parse."""
    bought = F.col("order_purchase_timestamp").cast("string")
    return t.orders.select(
        "order_id",
        F.when(F.col("order_status") == "P", F.lit("")).otherwise(bought).alias("Order_Date"),
        F.when(F.col("order_status") == "O", F.lit("unknown"))
        .otherwise(bought)
        .alias("approval_timestamp"),
    )


def _round_trip(read) -> Query:
    """Write the products as CSV to the shared folder and load that file."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _tables(spark, sf_dir)
        path = scratch_path(spark, "products-csv")
        write_csv(t.products.withColumn("label", F.lit('say "hi", twice')), path)
        return read(spark, path, None, infer=True)

    return run


def _ingest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items as a CSV with amounts of up to six places, loaded with their schema."""
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "items-csv")
    finer = F.col("freight_value").cast("decimal(16,6)") + (F.col("order_item_id") / 1_000_000).cast("decimal(16,6)")
    write_csv(t.order_items.withColumn("freight_value", finer), path)
    loaded = read_plain(spark, path, SCHEMAS["order_items"])
    return loaded.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", F.col("freight_value").cast("double")
    ).withColumn("price", F.col("price").cast("double"))


def _ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    path = scratch_path(spark, "orders-csv")
    write_csv(_text_dates(t), path)
    return read_clean(spark, path, None, infer=True)


def _null_reduction_dates(t: StarSample) -> DataFrame:
    """Blank dates are NULL again once they are dates."""
    text = cleaning.null_tokens(_text_dates(t))
    return quality.null_reduction(text, clean_table(text))


def _dedupe(t: StarSample) -> DataFrame:
    items = t.order_items.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"
    )
    kept = cleaning.dedupe(items, ["order_id", "order_item_id"], ["product_id", "seller_id"])
    return kept.withColumns(
        {c: F.col(c).cast("double") for c in ("price", "freight_value")}
    )


def _validation_rules(t: StarSample) -> DataFrame:
    items = quality.validate(
        t.order_items,
        {
            "freight is above zero": F.col("freight_value") > 0,
            "item is shipped": F.col("order_delivered_carrier_date").isNotNull(),
            "shipped from 1996": F.col("order_delivered_carrier_date")
            >= F.lit("1996-01-01").cast("timestamp_ntz"),
        },
    )
    referenced = quality.validate_reference(
        t.order_items, t.order_reviews, "order_id", "order has a review"
    )
    return items.unionByName(referenced)


def _watched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of the items from the job that writes them."""
    items = _tables(spark, sf_dir).order_items
    seen = quality.Watch(items)
    seen.on(items).write.parquet(scratch_path(spark, "watched"))
    return seen.column_profile().select("column_name", "null_percentage")


REFERENCES = [
    quality.Reference("product is known", "order_items", "products", "product_id"),
    quality.Reference("seller is known", "order_items", "sellers", "seller_id"),
    quality.Reference("order is known", "order_items", "orders", "order_id"),
    quality.Reference("order has a review", "order_items", "order_reviews", "order_id"),
    quality.Reference("customer is known", "orders", "customers", "customer_id"),
]


def _references(t: StarSample) -> DataFrame:
    names = {n for r in REFERENCES for n in (r.child, r.parent)}
    return quality.validate_references({name: getattr(t, name) for name in names}, REFERENCES)


# Streaming -------------------------------------------------------------------------------------


def _item_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = star_sample.read(spark, sf_dir, "lineitem").schema
    # As a pattern, the path may be a single file as well as a folder of part files.
    folder, name = star_sample.path_of(sf_dir, "lineitem").rsplit("/", 1)
    return star_sample.order_items(stream_parquet(spark, f"{folder}/{{{name}}}", schema))


def _stream_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time report over orders that a stream of items has added up."""
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-sales")
    per_order = order_sales_stream(
        _item_stream(spark, sf_dir), t.orders, f"{folder}/orders", f"{folder}/checkpoint", DELIVERED
    )
    return growth_report(monthly_totals(per_order))


def _stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-days")
    days = daily_sales(
        _item_stream(spark, sf_dir), t.orders, f"{folder}/days", f"{folder}/checkpoint", DELIVERED
    )
    return _day_report(days)


def _day_report(days: DataFrame) -> DataFrame:
    return days.select("day", F.col("revenue").cast("double").alias("revenue"), "items")


def _stream_late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items come before most of their orders do, and before those they know are delivered."""
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-late")
    known = t.orders.where(F.col("order_id") % 3 == 0).withColumn("order_status", F.lit("O"))

    def days(orders: DataFrame) -> DataFrame:
        stream = _item_stream(spark, sf_dir)
        return daily_sales(stream, orders, f"{folder}/items", f"{folder}/checkpoint", DELIVERED)

    days(known)
    return _day_report(days(t.orders))


def _stream_order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders come as a stream of versions, the last of them first."""
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-versions")
    last = t.orders.withColumn("version", F.lit(2))
    first = t.orders.withColumns({"version": F.lit(1), "order_status": F.lit(DELIVERED)})
    for number, version in enumerate((last, first)):
        version.write.parquet(f"{folder}/in/{number}")
        stream = stream_parquet(spark, f"{folder}/in/*", last.schema, files_per_batch=2)
        orders = latest_orders(stream, f"{folder}/orders", f"{folder}/orders-checkpoint", "version", 2)
    per_order = order_sales_stream(
        _item_stream(spark, sf_dir), orders, f"{folder}/items", f"{folder}/items-checkpoint", DELIVERED
    )
    return growth_report(monthly_totals(per_order))


def _stream_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many batches, whose folds are merged on the way."""
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-merged")
    t.order_items.repartition(10).write.parquet(f"{folder}/in")
    stream = stream_parquet(spark, f"{folder}/in", t.order_items.schema, files_per_batch=1)
    return _day_report(
        daily_sales(stream, t.orders, f"{folder}/items", f"{folder}/checkpoint", DELIVERED, fan_in=3)
    )


def _stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About how many customers bought on each day."""
    t = _tables(spark, sf_dir)
    folder = scratch_path(spark, "stream-customers")
    t.orders.repartition(4).write.parquet(f"{folder}/in")
    stream = stream_parquet(spark, f"{folder}/in", t.orders.schema, files_per_batch=1)
    days = estimated_customers(stream, f"{folder}/days", f"{folder}/checkpoint", fan_in=2)
    return days.withColumn("day", F.col("day").cast("timestamp_ntz"))


# Tables and the job ------------------------------------------------------------------------------


def _database(spark: SparkSession) -> str:
    """A database of its own for each run, in the session's warehouse."""
    name = f"mercatura_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def _catalog_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables are written, replaced and read back; one that is not there decides the branch."""
    t = _tables(spark, sf_dir)
    database = _database(spark)
    replace_table(t.products.limit(1), "products", database)
    for name in ("products", "order_items", "order_reviews"):
        replace_table(getattr(t, name), name, database)
    stored = {n: table_or_none(spark, n, database) for n in ("products", "order_items", "order_reviews")}
    translation = table_or_none(spark, "category_translation", database)
    return category_analysis(
        stored["products"], stored["order_items"], stored["order_reviews"], translation
    )


def _bucketed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales report over tables bucketed on the order."""
    t = _tables(spark, sf_dir)
    database = _database(spark)
    write_layout({"orders": t.orders, "order_items": t.order_items}, 8, database)
    orders, items = (spark.table(f"{database}.{n}") for n in ("orders", "order_items"))
    return sales_patterns(orders, items, DELIVERED)


# Parquet's row groups are small here, so that a sample has more than one.
ROW_GROUP_BYTES = 256 * 1024
A_MONTH = (datetime(1995, 3, 1), datetime(1995, 4, 1))
CUSTOMERS_ASKED = (1, 7, 100, 370)
PRODUCTS_ASKED = (2, 55, 199)
SELLERS_ASKED = (3, 8)


def _laid_out(spark: SparkSession, t: StarSample) -> str:
    """Orders and items with what finds their rows: buckets, Bloom filters and a copy by time."""
    database = _database(spark)
    write_layout(
        {"orders": t.orders, "order_items": t.order_items}, 8, database, row_group_bytes=ROW_GROUP_BYTES
    )
    write_by_time(t.orders, f"orders{BY_TIME}", database=database, row_group_bytes=ROW_GROUP_BYTES)
    return database


def _month_from_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales of one month, whose orders are found by their time."""
    database = _laid_out(spark, _tables(spark, sf_dir))
    orders = between(spark.table(f"{database}.orders{BY_TIME}"), *A_MONTH)
    return sales_patterns(orders, spark.table(f"{database}.order_items"), DELIVERED)


def _customers_from_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of a few customers, with their items."""
    database = _laid_out(spark, _tables(spark, sf_dir))
    asked = spark.table(f"{database}.orders").where(F.col("customer_id").isin(*CUSTOMERS_ASKED))
    joined = ordered_items(asked, spark.table(f"{database}.order_items"), ["customer_id"], ["price"])
    return joined.groupBy("customer_id", "order_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").cast("double").alias("spend")
    )


def _items_from_layout(key: str, asked: tuple[int, ...]) -> Query:
    """What was sold of a few products, or by a few sellers."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = _laid_out(spark, _tables(spark, sf_dir))
        found = spark.table(f"{database}.order_items").where(F.col(key).isin(*asked))
        return found.groupBy(key).agg(
            F.count(F.lit(1)).alias("items"), F.sum("price").cast("double").alias("revenue")
        )

    return run


def _job(report: str) -> Query:
    """The whole run over CSV files made of the tables; one of its reports."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = _tables(spark, sf_dir)
        folder = scratch_path(spark, "job")
        tables = ("customers", "orders", "order_items", "products", "sellers", "order_reviews",
                  "category_translation")
        paths = {name: f"{folder}/csv/{name}" for name in tables}
        for name, path in paths.items():
            write_csv(getattr(t, name), path)
        found = job.run(spark, paths, f"{folder}/out", delivered=DELIVERED)[report]
        return _rounded(found, 4, *METRICS) if report == "seller_summary" else found

    return run


def _seller_describe(t: StarSample) -> DataFrame:
    return _rounded(describe(_sellers(t), METRICS), 4, *METRICS)


def _rating_box(t: StarSample) -> DataFrame:
    box = plots.rating_box(_sellers(t))
    return _rounded(box, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


def _rating_outliers(t: StarSample) -> DataFrame:
    return plots.rating_outliers(_sellers(t))


def _spend_outliers(t: StarSample) -> DataFrame:
    spend = customer_metrics(t.customers, t.orders, t.order_items)
    return box_outliers(spend, "customer_state", "total_spend", "customer_id")


def entry(spark: SparkSession) -> DataFrame:
    """Monthly sales of the small sample."""
    return _sales(_tables(spark, SMOKE_DIR))


def _corpus_queries() -> dict[str, Query]:
    if corpus is None:
        return {}
    return {**corpus.queries(), "pipeline": corpus_pipeline.run}


def _corpus_sql() -> dict[str, str]:
    if corpus is None:
        return {}
    whole = corpus_pipeline.ORACLE_SQL
    return {**corpus.oracle_sql(), **({"pipeline": whole} if whole else {})}


def queries() -> dict[str, Query]:
    return {
        # Reports
        "sales_patterns": _on_tables(_sales),
        "time_metrics": _on_tables(_time),
        "customer_metrics": _on_tables(
            lambda t: customer_metrics(t.customers, t.orders, t.order_items)
        ),
        "customer_behavior": _on_tables(_behavior),
        "product_performance": _on_tables(_products),
        "category_analysis": _on_tables(_categories),
        "category_analysis_raw": _on_tables(
            lambda t: category_analysis(t.products, t.order_items, t.order_reviews, None)
        ),
        "category_analysis_one_review": _on_tables(
            lambda t: _categories(t, one_review_per_order=True)
        ),
        "seller_performance": _on_tables(_sellers),
        "seller_performance_many_orders": _on_tables(
            lambda t: _sellers(t, orders_at_least=MANY_ORDERS)
        ),
        # Joins
        "join_orders_items": _on_tables(_join_orders_items),
        "left_join_translation": _on_tables(
            lambda t: product_categories(t.products, t.category_translation)
        ),
        "left_join_reviews": _on_tables(_left_join_reviews),
        # Aggregates and windows
        "agg_count_distinct": _on_tables(_count_distinct),
        "window_lag": _on_tables(_window_lag),
        "window_ntile_revenue": _window_tiles("revenue", "revenue_quintile"),
        "window_ntile_rating": _window_tiles("avg_rating", "rating_quintile"),
        "window_ntile_revenue_distributed": _window_ntile("revenue", "revenue_quintile"),
        "window_ntile_rating_distributed": _window_ntile("avg_rating", "rating_quintile"),
        # Scalars
        "scalar_date_trunc": _on_tables(
            lambda t: t.orders.select(
                "order_id", month_of("order_purchase_timestamp").alias("month")
            )
        ),
        "scalar_elapsed": _on_tables(_elapsed),
        "scalar_safe_ratio": _on_tables(_safe_ratio),
        # Quality
        "null_profile_orders": _on_tables(lambda t: quality.null_profile(t.orders)),
        "null_profile_items": _on_tables(lambda t: quality.null_profile(t.order_items)),
        "incomplete_rows_orders": _on_tables(lambda t: quality.incomplete_row_profile(t.orders)),
        "incomplete_rows_items": _on_tables(
            lambda t: quality.incomplete_row_profile(t.order_items)
        ),
        "duplicates_single": _on_tables(
            lambda t: quality.duplicate_count(t.order_items, ["order_id"])
        ),
        "duplicates_composite": _on_tables(
            lambda t: quality.duplicate_count(t.order_items, ["order_id", "order_item_id"])
        ),
        "date_range_orders": _on_tables(
            lambda t: quality.date_range(t.orders, "order_purchase_timestamp")
        ),
        "date_range_items": _on_tables(
            lambda t: quality.date_range(t.order_items, "order_delivered_carrier_date")
        ),
        # Cleaning and loading
        "clean_text_fill": _on_tables(lambda t: cleaning.fill_text(t.products)),
        "clean_dates": _on_tables(lambda t: cleaning.parse_dates(_text_dates(t))),
        "ingest_plain": _round_trip(read_plain),
        "ingest_clean": _round_trip(read_clean),
        "ingest_clean_dates": _ingest_orders,
        "ingest_items": _ingest_items,
        "dedupe": _on_tables(_dedupe),
        "null_reduction": _on_tables(
            lambda t: quality.null_reduction(t.products, cleaning.fill_text(t.products))
        ),
        "null_reduction_dates": _on_tables(_null_reduction_dates),
        "validation_rules": _on_tables(_validation_rules),
        "validation_references": _on_tables(_references),
        "watched_null_profile": _watched_profile,
        # Heads, tails, summaries, plot rows
        "top_states": _on_tables(lambda t: top_states(_behavior(t))),
        "top_products": _on_tables(lambda t: top_products(_products(t))),
        "top_categories": _on_tables(lambda t: top_categories(_categories(t))),
        "latest_months": _on_tables(lambda t: latest_months(_time(t))),
        "seller_describe": _on_tables(_seller_describe),
        "plot_revenue_trend": _on_tables(lambda t: plots.revenue_trend(_time(t))),
        "plot_customers_by_state": _on_tables(lambda t: plots.customers_by_state(_behavior(t))),
        "plot_category_scatter": _on_tables(lambda t: plots.category_scatter(_categories(t))),
        "plot_rating_box": _on_tables(_rating_box),
        "plot_rating_outliers": _on_tables(_rating_outliers),
        "plot_spend_outliers": _on_tables(_spend_outliers),
        # Streaming
        "stream_sales": _stream_sales,
        "stream_daily_sales": _stream_daily,
        "stream_late_orders": _stream_late_orders,
        "stream_order_versions": _stream_order_versions,
        "stream_merged_days": _stream_merged,
        "stream_customer_estimates": _stream_customers,
        # Tables and the job
        "catalog_category_analysis": _catalog_categories,
        "layout_sales_patterns": _bucketed_sales,
        "layout_month_sales": _month_from_layout,
        "layout_customer_orders": _customers_from_layout,
        "layout_product_sales": _items_from_layout("product_id", PRODUCTS_ASKED),
        "layout_seller_sales": _items_from_layout("seller_id", SELLERS_ASKED),
        "job_time_metrics": _job("time_metrics"),
        "job_seller_summary": _job("seller_summary"),
        **_corpus_queries(),
    }


# The SQL side ------------------------------------------------------------------------------------

# Inputs of the reports as views on the given tables.
_VIEWS = """
f_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp
  FROM orders),
f_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_extendedprice * l_tax AS DECIMAL(14,4)) AS freight_value,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS shipped_at
  FROM lineitem),
f_customers AS (
  SELECT c_custkey AS customer_id, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
f_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_brand = 'Brand#13' THEN NULL
              ELSE concat(p_name, ' ', p_brand) END AS product_category_name
  FROM part),
f_translation AS (
  SELECT concat(p_name, ' ', p_brand) AS product_category_name,
         min(p_name) AS product_category_name_english
  FROM part WHERE p_type IN ('PROMO', 'SMALL') GROUP BY 1),
f_sellers AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
f_reviews AS (
  SELECT CAST(floor(event_id / 2) AS BIGINT) AS order_id,
         CAST(user_id % 5 + 1 AS INT) AS review_score
  FROM events)"""

_MICROS = "date_diff('microsecond', o.order_purchase_timestamp, i.shipped_at)"

_MONTHLY = f"""
monthly AS (
  SELECT CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS month,
         count(DISTINCT o.order_id) AS orders,
         count(DISTINCT o.customer_id) AS customers,
         CAST(sum(i.price) AS DOUBLE) AS revenue,
         CAST(sum(i.freight_value) AS DOUBLE) AS freight,
         CAST(sum(CAST({_MICROS} AS DECIMAL(20,0))) AS DOUBLE) / count({_MICROS})
           / 8.64e10 AS delivery_days
  FROM f_orders o JOIN f_items i ON o.order_id = i.order_id
  WHERE o.order_status = 'F'
  GROUP BY 1),
growth AS (
  SELECT *, lag(revenue) OVER (ORDER BY month ASC NULLS LAST) AS prev_month_revenue FROM monthly),
time_report AS (
  SELECT month, orders AS total_orders, customers AS unique_customers, revenue,
         freight AS freight_cost, delivery_days AS avg_delivery_days,
         revenue / nullif(orders, 0) AS avg_order_value, prev_month_revenue,
         (revenue - prev_month_revenue) / nullif(prev_month_revenue, 0) * 100 AS revenue_growth
  FROM growth)"""

_CUSTOMERS = """
per_customer AS (
  SELECT c.customer_id, c.customer_state, count(DISTINCT o.order_id) AS order_count,
         sum(i.price) AS spend, CAST(sum(i.price) AS DOUBLE) / count(i.price) AS avg_order_value,
         min(o.order_purchase_timestamp) AS first_order,
         max(o.order_purchase_timestamp) AS last_order
  FROM f_customers c JOIN f_orders o ON c.customer_id = o.customer_id
  JOIN f_items i ON o.order_id = i.order_id
  GROUP BY c.customer_id, c.customer_state),
behavior AS (
  SELECT customer_state, count(*) AS customer_count,
         CAST(sum(order_count) AS DOUBLE) / count(*) AS avg_orders_per_customer,
         CAST(sum(spend) AS DOUBLE) / count(spend) AS avg_customer_value,
         CAST(sum(CAST(round(avg_order_value, 9) AS DECIMAL(24,9))) AS DOUBLE)
           / count(avg_order_value) AS avg_order_value
  FROM per_customer GROUP BY customer_state)"""


def _categories_sql(
    category: str = "coalesce(t.product_category_name_english, p.product_category_name)",
    reviews: str = "f_reviews",
) -> str:
    return f"""
by_category AS (
  SELECT {category} AS category, count(DISTINCT p.product_id) AS products,
         count(DISTINCT i.order_id) AS orders, sum(i.price) AS price,
         CAST(sum(i.price) AS DOUBLE) / count(i.price) AS avg_price,
         CAST(sum(r.review_score) AS DOUBLE) / count(r.review_score) AS avg_rating
  FROM f_items i JOIN f_products p ON i.product_id = p.product_id
  LEFT JOIN f_translation t ON p.product_category_name = t.product_category_name
  LEFT JOIN {reviews} r ON i.order_id = r.order_id
  GROUP BY 1),
performance AS (
  SELECT category, products AS product_count, orders AS order_count,
         CAST(price AS DOUBLE) AS total_revenue, avg_price, avg_rating
  FROM by_category WHERE orders > 10),
categories AS (
  SELECT category, orders AS total_orders, products AS unique_products,
         CAST(price AS DOUBLE) AS revenue, avg_rating,
         CAST(price AS DOUBLE) / orders AS avg_order_value
  FROM by_category WHERE orders > 100)"""


def _sellers_sql(orders_at_least: int = 10) -> str:
    return f"""
seller_metrics AS (
  SELECT s.seller_id, s.seller_state, count(DISTINCT i.order_id) AS total_orders,
         count(DISTINCT i.product_id) AS unique_products,
         CAST(sum(i.price) AS DOUBLE) AS revenue,
         CAST(sum(r.review_score) AS DOUBLE) / count(r.review_score) AS avg_rating,
         CAST(sum(CAST({_MICROS} AS DECIMAL(20,0))) AS DOUBLE) / count({_MICROS})
           / 3.6e9 AS avg_shipping_time
  FROM f_sellers s JOIN f_items i ON s.seller_id = i.seller_id
  JOIN f_orders o ON i.order_id = o.order_id
  LEFT JOIN f_reviews r ON i.order_id = r.order_id
  GROUP BY s.seller_id, s.seller_state),
sellers AS (
  SELECT *, CAST(ntile(5) OVER (ORDER BY revenue DESC NULLS FIRST, seller_id) AS INT)
              AS revenue_quintile,
         CAST(ntile(5) OVER (ORDER BY avg_rating DESC NULLS FIRST, seller_id) AS INT)
              AS rating_quintile
  FROM seller_metrics WHERE total_orders >= {orders_at_least})"""


_BOX = """
quartiles AS (
  SELECT revenue_quintile, count(*) AS n, quantile_cont(avg_rating, 0.25) AS q1,
         quantile_cont(avg_rating, 0.5) AS median, quantile_cont(avg_rating, 0.75) AS q3
  FROM sellers WHERE avg_rating IS NOT NULL GROUP BY revenue_quintile),
points AS (
  SELECT s.seller_id, s.avg_rating, q.*,
         s.avg_rating BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM sellers s JOIN quartiles q ON s.revenue_quintile = q.revenue_quintile
  WHERE s.avg_rating IS NOT NULL)"""

# Orders with one review row each: the mean score of the order.
_ONE_REVIEW = """
one_review AS (
  SELECT order_id, CAST(CAST(sum(review_score) AS DECIMAL(24,6)) / count(review_score)
           AS DECIMAL(24,6)) AS review_score
  FROM f_reviews GROUP BY order_id)"""


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",".join((_VIEWS, *ctes)) + "\n" + select


def _null_counts(view: str, columns: list[str]) -> str:
    rows = [
        f"SELECT '{alias}' AS column_name, CAST(count(*) - count({c}) AS DOUBLE) * 100.0"
        f" / count(*) AS null_percentage FROM {view}"
        for alias, c in (column.split("=") if "=" in column else (column, column) for column in columns)
    ]
    return _sql("\nUNION ALL\n".join(rows))


def _incomplete(view: str, columns: list[str]) -> str:
    pairs = [column.split("=") if "=" in column else (column, column) for column in columns]
    whole = " AND ".join(f"{c} IS NOT NULL" for _, c in pairs)
    rows = [
        f"SELECT '{alias}' AS column_name, CAST(count(*) - count(CASE WHEN {whole} THEN 1 END)"
        f" AS DOUBLE) * 100.0 / count(*) AS null_percentage FROM {view}"
        for alias, _ in pairs
    ]
    return _sql("\nUNION ALL\n".join(rows))


_VIEW_OF = {
    "orders": "f_orders",
    "order_items": "f_items",
    "order_reviews": "f_reviews",
    "products": "f_products",
    "sellers": "f_sellers",
    "customers": "f_customers",
}
_ORDER_COLUMNS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
_ITEM_COLUMNS = [
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "order_delivered_carrier_date=shipped_at",
    "order_delivered_customer_date=shipped_at",
]


def _describe_sql() -> str:
    functions = {
        "count": "CAST(count({c}) AS DOUBLE)",
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "CAST(min({c}) AS DOUBLE)",
        "25%": "quantile_cont({c}, 0.25)",
        "50%": "quantile_cont({c}, 0.5)",
        "75%": "quantile_cont({c}, 0.75)",
        "max": "CAST(max({c}) AS DOUBLE)",
    }
    rows = []
    for name, function in functions.items():
        columns = ", ".join(
            f"round({function.format(c=f'CAST({m} AS DOUBLE)')}, 4) AS {m}" for m in METRICS
        )
        rows.append(f"SELECT '{name}' AS statistic, {columns} FROM sellers")
    return _sql("\nUNION ALL\n".join(rows), _sellers_sql())


def _rule_sql(rule: str, test: str, source: str = "f_items") -> str:
    return (
        f"SELECT '{rule}' AS rule, count(*) AS checked_rows,"
        f" count(CASE WHEN {test} THEN 1 END) AS passed_rows,"
        f" CAST(count(CASE WHEN {test} THEN 1 END) AS DOUBLE) * 100.0 / count(*) AS pass_rate"
        f" FROM {source}"
    )


def oracle_sql() -> dict[str, str]:
    time_report = _sql("SELECT * FROM time_report", _MONTHLY)
    ntile_revenue = _sql(
        """SELECT seller_id, revenue,
       CAST(ntile(5) OVER (ORDER BY revenue DESC NULLS FIRST, seller_id) AS INT)
         AS revenue_quintile
FROM seller_metrics""",
        _sellers_sql(),
    )
    ntile_rating = _sql(
        """SELECT seller_id, avg_rating,
       CAST(ntile(5) OVER (ORDER BY avg_rating DESC NULLS FIRST, seller_id) AS INT)
         AS rating_quintile
FROM seller_metrics""",
        _sellers_sql(),
    )
    sales = _sql(
        """SELECT month, orders AS order_count, revenue, customers AS customer_count,
       revenue / nullif(orders, 0) AS avg_order_value,
       revenue / nullif(customers, 0) AS revenue_per_customer
FROM monthly""",
        _MONTHLY,
    )
    day_report = _sql(
        """SELECT day, CAST(sum(price) AS DOUBLE) AS revenue, count(*) AS items
FROM (SELECT CAST(date_trunc('day', o.order_purchase_timestamp) AS TIMESTAMP) AS day, i.price
      FROM f_items i JOIN f_orders o ON i.order_id = o.order_id
      WHERE o.order_status = 'F') AS sold
GROUP BY day"""
    )
    label = """'say "hi", twice' AS label"""
    return {
        "sales_patterns": sales,
        "time_metrics": time_report,
        "customer_metrics": _sql(
            """SELECT customer_id, customer_state, order_count, CAST(spend AS DOUBLE) AS total_spend,
       avg_order_value, first_order, last_order
FROM per_customer""",
            _CUSTOMERS,
        ),
        "customer_behavior": _sql("SELECT * FROM behavior", _CUSTOMERS),
        "product_performance": _sql("SELECT * FROM performance", _categories_sql()),
        "category_analysis": _sql("SELECT * FROM categories", _categories_sql()),
        "category_analysis_raw": _sql(
            "SELECT * FROM categories", _categories_sql("p.product_category_name")
        ),
        "category_analysis_one_review": _sql(
            "SELECT * FROM categories", _ONE_REVIEW, _categories_sql(reviews="one_review")
        ),
        "seller_performance": _sql("SELECT * FROM sellers", _sellers_sql()),
        "seller_performance_many_orders": _sql("SELECT * FROM sellers", _sellers_sql(MANY_ORDERS)),
        "join_orders_items": _sql(
            """SELECT i.order_id, i.order_item_id, i.price, o.customer_id, o.order_status
FROM f_items i JOIN f_orders o ON i.order_id = o.order_id"""
        ),
        "left_join_translation": _sql(
            """SELECT p.product_id, p.product_category_name,
       coalesce(t.product_category_name_english, p.product_category_name) AS category
FROM f_products p LEFT JOIN f_translation t ON p.product_category_name = t.product_category_name"""
        ),
        "left_join_reviews": _sql(
            """SELECT i.order_id, i.product_id, count(*) AS joined_rows,
       CAST(sum(i.price) AS DOUBLE) AS joined_price,
       CAST(sum(r.review_score) AS BIGINT) AS score_sum, count(r.review_score) AS scores
FROM f_items i LEFT JOIN f_reviews r ON i.order_id = r.order_id
GROUP BY i.order_id, i.product_id"""
        ),
        "agg_count_distinct": _sql(
            """SELECT seller_id, count(DISTINCT order_id) AS orders,
       count(DISTINCT product_id) AS products
FROM f_items GROUP BY seller_id"""
        ),
        "window_lag": _sql("SELECT month, revenue, prev_month_revenue FROM growth", _MONTHLY),
        "window_ntile_revenue": ntile_revenue,
        "window_ntile_rating": ntile_rating,
        "window_ntile_revenue_distributed": ntile_revenue,
        "window_ntile_rating_distributed": ntile_rating,
        "scalar_date_trunc": _sql(
            """SELECT order_id, CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP)
         AS month
FROM f_orders"""
        ),
        "scalar_elapsed": _sql(
            f"""SELECT i.order_id, i.order_item_id, i.product_id,
       CAST({_MICROS} AS DOUBLE) / 8.64e10 AS days, CAST({_MICROS} AS DOUBLE) / 3.6e9 AS hours
FROM f_items i JOIN f_orders o ON i.order_id = o.order_id"""
        ),
        "scalar_safe_ratio": _sql(
            """SELECT order_id, order_item_id,
       CAST(price AS DOUBLE) / nullif(CAST(freight_value AS DOUBLE), 0) AS price_per_freight
FROM f_items"""
        ),
        "null_profile_orders": _null_counts("f_orders", _ORDER_COLUMNS),
        "null_profile_items": _null_counts("f_items", _ITEM_COLUMNS),
        "incomplete_rows_orders": _incomplete("f_orders", _ORDER_COLUMNS),
        "incomplete_rows_items": _incomplete("f_items", _ITEM_COLUMNS),
        "duplicates_single": _sql(
            "SELECT count(*) - count(DISTINCT order_id) AS duplicate_count FROM f_items"
        ),
        "duplicates_composite": _sql(
            """SELECT count(*) - count(DISTINCT (order_id, order_item_id)) AS duplicate_count
FROM f_items"""
        ),
        "date_range_orders": _sql(
            """SELECT min(order_purchase_timestamp) AS min_date,
       max(order_purchase_timestamp) AS max_date FROM f_orders"""
        ),
        "date_range_items": _sql(
            "SELECT min(shipped_at) AS min_date, max(shipped_at) AS max_date FROM f_items"
        ),
        "clean_text_fill": _sql(
            """SELECT product_id, coalesce(product_category_name, '') AS product_category_name
FROM f_products"""
        ),
        "clean_dates": _sql(
            """SELECT order_id,
       CASE WHEN order_status <> 'P' THEN order_purchase_timestamp END AS "Order_Date",
       CASE WHEN order_status = 'O' THEN 'unknown'
            ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS approval_timestamp
FROM f_orders"""
        ),
        "ingest_plain": _sql(
            f"SELECT product_id, product_category_name, {label} FROM f_products"
        ),
        "ingest_clean": _sql(
            f"""SELECT product_id, coalesce(product_category_name, '') AS product_category_name,
       {label} FROM f_products"""
        ),
        "ingest_clean_dates": _sql(
            """SELECT order_id,
       CASE WHEN order_status <> 'P' THEN order_purchase_timestamp END AS "Order_Date",
       CASE WHEN order_status = 'O' THEN 'unknown'
            ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS approval_timestamp
FROM f_orders"""
        ),
        "ingest_items": _sql(
            """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(order_item_id AS VARCHAR) AS order_item_id,
       CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
       CAST(price AS DOUBLE) AS price,
       CAST(CAST(freight_value AS DECIMAL(16,6)) + CAST(order_item_id / 1000000.0 AS DECIMAL(16,6))
            AS DOUBLE) AS freight_value
FROM f_items"""
        ),
        "null_reduction_dates": _sql(
            """SELECT 'order_id' AS column_name, 0.0 AS null_percentage_before, 0.0 AS null_percentage_after
UNION ALL
SELECT 'Order_Date', CAST(count(CASE WHEN order_status = 'P' THEN 1 END) AS DOUBLE) * 100.0 / count(*),
       CAST(count(CASE WHEN order_status = 'P' THEN 1 END) AS DOUBLE) * 100.0 / count(*)
FROM f_orders
UNION ALL
SELECT 'approval_timestamp', 0.0, 0.0"""
        ),
        "plot_spend_outliers": _sql(
            """SELECT customer_id, customer_state, total_spend
FROM (SELECT p.customer_id, p.customer_state, CAST(p.spend AS DOUBLE) AS total_spend, q1, q3
      FROM per_customer p JOIN fences f ON p.customer_state = f.customer_state
      WHERE p.spend IS NOT NULL) AS placed
WHERE NOT total_spend BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
            _CUSTOMERS,
            """
fences AS (
  SELECT customer_state, quantile_cont(CAST(spend AS DOUBLE), 0.25) AS q1,
         quantile_cont(CAST(spend AS DOUBLE), 0.75) AS q3
  FROM per_customer WHERE spend IS NOT NULL GROUP BY customer_state)""",
        ),
        "catalog_category_analysis": _sql(
            "SELECT * FROM categories", _categories_sql("p.product_category_name")
        ),
        "layout_sales_patterns": sales,
        "layout_month_sales": _sql(
            f"""SELECT month, orders AS order_count, revenue, customers AS customer_count,
       revenue / nullif(orders, 0) AS avg_order_value,
       revenue / nullif(customers, 0) AS revenue_per_customer
FROM monthly WHERE month = TIMESTAMP '{A_MONTH[0]}'""",
            _MONTHLY,
        ),
        "layout_customer_orders": _sql(
            f"""SELECT o.customer_id, o.order_id, count(*) AS items, CAST(sum(i.price) AS DOUBLE) AS spend
FROM f_orders o JOIN f_items i ON i.order_id = o.order_id
WHERE o.customer_id IN {CUSTOMERS_ASKED} GROUP BY o.customer_id, o.order_id"""
        ),
        "layout_product_sales": _sql(
            f"""SELECT product_id, count(*) AS items, CAST(sum(price) AS DOUBLE) AS revenue
FROM f_items WHERE product_id IN {PRODUCTS_ASKED} GROUP BY product_id"""
        ),
        "layout_seller_sales": _sql(
            f"""SELECT seller_id, count(*) AS items, CAST(sum(price) AS DOUBLE) AS revenue
FROM f_items WHERE seller_id IN {SELLERS_ASKED} GROUP BY seller_id"""
        ),
        "job_time_metrics": time_report,
        "dedupe": _sql(
            """SELECT order_id, order_item_id, product_id, seller_id,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
FROM (SELECT *, row_number() OVER (
        PARTITION BY order_id, order_item_id
        ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, price NULLS FIRST,
                 freight_value NULLS FIRST) AS place
      FROM f_items) AS numbered
WHERE place = 1"""
        ),
        "null_reduction": _sql(
            """SELECT 'product_id' AS column_name,
       CAST(count(*) - count(product_id) AS DOUBLE) * 100.0 / count(*) AS null_percentage_before,
       CAST(count(*) - count(product_id) AS DOUBLE) * 100.0 / count(*) AS null_percentage_after
FROM f_products
UNION ALL
SELECT 'product_category_name',
       CAST(count(*) - count(product_category_name) AS DOUBLE) * 100.0 / count(*),
       CAST(count(*) - count(coalesce(product_category_name, '')) AS DOUBLE) * 100.0 / count(*)
FROM f_products"""
        ),
        "watched_null_profile": _null_counts("f_items", _ITEM_COLUMNS),
        "job_seller_summary": _describe_sql(),
        "validation_references": _sql(
            "\nUNION ALL\n".join(
                f"""SELECT '{r.child}' AS table_name, '{r.rule}' AS rule, count(*) AS checked_rows,
       count(CASE WHEN {r.key} IN (SELECT {r.key} FROM {_VIEW_OF[r.parent]}) THEN 1 END) AS passed_rows,
       count(CASE WHEN {r.key} IN (SELECT {r.key} FROM {_VIEW_OF[r.parent]}) THEN 1 END) * 100.0 / count(*)
         AS pass_rate
FROM {_VIEW_OF[r.child]}"""
                for r in REFERENCES
            )
        ),
        "validation_rules": _sql(
            "\nUNION ALL\n".join(
                [
                    _rule_sql("freight is above zero", "freight_value > 0"),
                    _rule_sql("item is shipped", "shipped_at IS NOT NULL"),
                    _rule_sql("shipped from 1996", "shipped_at >= TIMESTAMP '1996-01-01'"),
                    _rule_sql(
                        "order has a review", "order_id IN (SELECT order_id FROM f_reviews)"
                    ),
                ]
            )
        ),
        "top_states": _sql(
            """SELECT * FROM behavior
ORDER BY customer_count DESC, customer_state ASC NULLS LAST LIMIT 5""",
            _CUSTOMERS,
        ),
        "top_products": _sql(
            """SELECT * FROM performance
ORDER BY total_revenue DESC NULLS FIRST, category ASC NULLS LAST LIMIT 5""",
            _categories_sql(),
        ),
        "top_categories": _sql(
            """SELECT category, revenue, avg_rating FROM categories
ORDER BY revenue DESC NULLS FIRST, category ASC NULLS LAST LIMIT 10""",
            _categories_sql(),
        ),
        "latest_months": _sql(
            "SELECT * FROM time_report ORDER BY month DESC NULLS FIRST LIMIT 5", _MONTHLY
        ),
        "seller_describe": _describe_sql(),
        "plot_revenue_trend": _sql("SELECT month, revenue FROM time_report", _MONTHLY),
        "plot_customers_by_state": _sql(
            "SELECT customer_state, customer_count FROM behavior", _CUSTOMERS
        ),
        "plot_category_scatter": _sql(
            """SELECT category, revenue, avg_rating, total_orders FROM categories
ORDER BY revenue DESC NULLS FIRST, category ASC NULLS LAST LIMIT 20""",
            _categories_sql(),
        ),
        "plot_rating_box": _sql(
            """SELECT revenue_quintile, n, round(q1, 6) AS q1, round(median, 6) AS median,
       round(q3, 6) AS q3,
       round(min(CASE WHEN inside THEN avg_rating END), 6) AS whisker_low,
       round(max(CASE WHEN inside THEN avg_rating END), 6) AS whisker_high,
       count(CASE WHEN NOT inside THEN 1 END) AS outliers
FROM points GROUP BY revenue_quintile, n, q1, median, q3""",
            _sellers_sql(),
            _BOX,
        ),
        "plot_rating_outliers": _sql(
            "SELECT seller_id, revenue_quintile, avg_rating FROM points WHERE NOT inside",
            _sellers_sql(),
            _BOX,
        ),
        "stream_sales": time_report,
        "stream_daily_sales": day_report,
        "stream_late_orders": day_report,
        "stream_order_versions": time_report,
        "stream_merged_days": day_report,
        # A sketch counts as few customers as buy on one day of the sample exactly.
        "stream_customer_estimates": _sql(
            """SELECT CAST(date_trunc('day', order_purchase_timestamp) AS TIMESTAMP) AS day, count(DISTINCT customer_id) AS customers,
       CAST(0.01625 AS DOUBLE) AS standard_error
FROM f_orders GROUP BY 1"""
        ),
        **_corpus_sql(),
    }
