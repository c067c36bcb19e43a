"""Reports against their plain SQL form, on random tables that break every key and hold NULLs."""

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import naive
import pytest
from conftest import final_plan, plan, rows, ts
from pyspark.sql import functions as F

from mercatura.plans.customers import customer_behavior, customer_metrics
from mercatura.plans.products import (
    category_analysis,
    product_categories,
    product_performance,
    top_categories,
)
from mercatura.plans.sales import (
    delivered_items,
    fold_to_orders,
    latest_months,
    monthly_sales,
    monthly_totals,
    sales_patterns,
    time_metrics,
    with_growth,
)
from mercatura.plans.sellers import seller_metrics, seller_performance

SCHEMAS = {
    "customers": "customer_id string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string,"
    " order_purchase_timestamp timestamp_ntz, order_delivered_carrier_date timestamp_ntz,"
    " order_delivered_customer_date timestamp_ntz",
    "order_items": "order_id string, product_id string, seller_id string,"
    " price decimal(12,2), freight_value decimal(14,4)",
    "products": "product_id string, product_category_name string",
    "sellers": "seller_id string, seller_state string",
    "order_reviews": "order_id string, review_score int",
    "category_translation": "product_category_name string, product_category_name_english string",
}


def random_tables(seed, n=400, hot=False):
    """Rows with repeated ids, dangling ids and NULLs; with ``hot``, a third shares one key."""
    r = random.Random(seed)

    def key(prefix, count, null=0.03):
        if hot and r.random() < 1 / 3:
            return f"{prefix}0"
        return None if r.random() < null else f"{prefix}{r.randrange(count)}"

    def when(null=0.1):
        if r.random() < null:
            return None
        return datetime(2017, 1, 1) + timedelta(seconds=r.randrange(20_000_000), microseconds=r.randrange(10**6))

    def amount():
        return None if r.random() < 0.05 else Decimal(r.randrange(0, 500_00)) / 100

    status = ("delivered", "delivered", "shipped", None)
    return {
        "customers": [(key("c", 40), r.choice(["SP", "RJ", "MG", None])) for _ in range(60)],
        "orders": [
            (key("o", 120), key("c", 50), r.choice(status), when(), when(), when())
            for _ in range(n // 2)
        ],
        "order_items": [
            (key("o", 130), key("p", 40), key("s", 12), amount(), amount()) for _ in range(n)
        ],
        "products": [(key("p", 45), r.choice(["a", "b", "c", "d", "", None])) for _ in range(60)],
        "sellers": [(key("s", 15), r.choice(["SP", "RJ", None])) for _ in range(20)],
        "order_reviews": [
            (key("o", 140), r.choice([1, 2, 3, 4, 5, None])) for _ in range(n // 3)
        ],
        "category_translation": [("a", "A"), ("b", "A"), ("c", None), ("zzz", "Z"), ("a", "AA")],
    }


def load(spark, data):
    frames = {}
    for name, schema in SCHEMAS.items():
        frames[name] = spark.createDataFrame(data.get(name, []), schema)
        frames[name].createOrReplaceTempView(name)
    return frames


def same(actual, expected):
    """Same rows; doubles may differ in the last place, where a ratio was expanded."""
    assert actual.columns == expected.columns

    def key(row):
        return [(v is None, f"{v:.9g}" if isinstance(v, float) else str(v)) for v in row]

    got, want = sorted(rows(actual), key=key), sorted(rows(expected), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == (pytest.approx(y, rel=1e-14) if isinstance(y, float) else y)


CASES = [(1, False), (2, False), (3, True)]


@pytest.fixture(params=CASES, ids=["one", "two", "hot"])
def tables(request, spark):
    seed, hot = request.param
    return load(spark, random_tables(seed, hot=hot))


@pytest.fixture(params=["10485760", "-1"], ids=["broadcast", "shuffle"])
def joins(request, conf):
    """Run with broadcasts, and with shuffles small enough to count as skewed."""
    conf(
        spark__sql__autoBroadcastJoinThreshold=request.param,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
    )


def test_months(spark, tables, joins):
    actual = monthly_sales(tables["orders"], tables["order_items"])
    same(actual, spark.sql(naive.MONTHS))


def test_months_from_item_rows(spark, tables, joins):
    facts = delivered_items(tables["orders"], tables["order_items"])
    same(monthly_totals(fold_to_orders(facts)), spark.sql(naive.MONTHS))


def test_months_with_the_date_on_the_items(spark, tables):
    orders, items = tables["orders"], tables["order_items"]
    delivered = items.withColumn(
        "order_delivered_customer_date",
        F.when(F.col("price") > 100, F.lit("2017-06-01 10:00:00.25").cast("timestamp_ntz")),
    )
    orders = orders.drop("order_delivered_customer_date")
    orders.createOrReplaceTempView("orders")
    delivered.createOrReplaceTempView("order_items")
    expected = spark.sql(naive.MONTHS.replace("o.order_delivered_customer", "i.order_delivered_customer"))
    same(monthly_sales(orders, delivered), expected)


def test_customers(spark, tables, joins):
    actual = customer_metrics(tables["customers"], tables["orders"], tables["order_items"])
    same(actual, spark.sql(naive.CUSTOMERS))


def test_states(spark, tables):
    actual = customer_behavior(tables["customers"], tables["orders"], tables["order_items"])
    spark.sql(naive.CUSTOMERS).createOrReplaceTempView("per_customer")
    expected = spark.sql(
        """SELECT customer_state, count(*) AS customer_count,
                  avg(order_count) AS avg_orders_per_customer,
                  avg(total_spend) AS avg_customer_value, avg(avg_order_value) AS avg_order_value
           FROM per_customer GROUP BY customer_state
           ORDER BY customer_count DESC, customer_state ASC NULLS LAST"""
    )
    got, want = rows(actual), rows(expected)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for a, b in zip(got, want):
        assert a[2:] == pytest.approx(b[2:], abs=1e-6)


@pytest.mark.parametrize("more_than", [0, 10])
def test_categories(spark, tables, joins, more_than):
    actual = product_performance(
        tables["products"],
        tables["order_items"],
        tables["order_reviews"],
        tables["category_translation"],
        more_orders_than=more_than,
    )
    same(actual, spark.sql(naive.CATEGORIES.format(more_than=more_than)))


def test_sellers(spark, tables, joins):
    actual = seller_metrics(
        tables["sellers"], tables["order_items"], tables["orders"], tables["order_reviews"]
    )
    same(actual, spark.sql(naive.SELLERS))


def test_seller_quintiles(spark, tables):
    actual = seller_performance(
        tables["sellers"],
        tables["order_items"],
        tables["orders"],
        tables["order_reviews"],
        orders_at_least=3,
    )
    spark.sql(naive.SELLERS).createOrReplaceTempView("metrics")
    tie = "seller_id ASC NULLS LAST, seller_state ASC NULLS LAST"
    expected = spark.sql(
        f"""SELECT *, ntile(5) OVER (ORDER BY revenue DESC NULLS FIRST, {tie}) AS revenue_quintile,
                   ntile(5) OVER (ORDER BY avg_rating DESC NULLS FIRST, {tie}) AS rating_quintile
            FROM metrics WHERE total_orders >= 3"""
    )
    same(actual, expected)


# Small hand-made cases --------------------------------------------------------------------------


def small(spark, **data):
    return load(spark, data)


def order(order_id, bought, customer="c", status="delivered", carrier=None, arrived=None):
    return (order_id, customer, status, bought and ts(bought), carrier and ts(carrier), arrived and ts(arrived))


def item(order_id, price, product="p", seller="s", freight="1"):
    return (order_id, product, seller, price and Decimal(price), freight and Decimal(freight))


def test_growth_looks_at_the_previous_row(spark):
    t = small(
        spark,
        orders=[order("1", "2017-01-05"), order("2", "2017-03-05"), order("3", "2017-04-05"),
                order("4", None), order("5", "2017-05-01", status="canceled")],
        order_items=[item("1", "0"), item("2", "5"), item("3", "6"), item("4", "7"), item("5", "9")],
    )
    report = rows(time_metrics(t["orders"], t["order_items"]))
    assert [(r[0] and r[0].month, r[3], r[7], r[8]) for r in report] == [
        (1, 0.0, None, None),
        (3, 5.0, 0.0, None),
        (4, 6.0, 5.0, 20.0),
        (None, 7.0, 6.0, pytest.approx(100 / 6)),
    ]


def test_latest_months_come_oldest_first(spark):
    months = spark.createDataFrame(
        [(ts(f"2017-{m:02d}-01"), float(m)) for m in range(1, 9)] + [(None, 0.0)],
        "month timestamp_ntz, revenue double",
    )
    assert [r[1] for r in rows(latest_months(months, 3))] == [7.0, 8.0, 0.0]
    assert rows(with_growth(months.limit(0))) == []


def test_one_order_under_two_customers_counts_once(spark):
    t = small(
        spark,
        orders=[order("1", "2017-01-05", "a"), order("1", "2017-01-06", "b"), order("1", "2017-02-01", "b")],
        order_items=[item("1", "10"), item("1", "20")],
    )
    report = rows(sales_patterns(t["orders"], t["order_items"]))
    assert [r[1:4] for r in report] == [(1, 60.0, 2), (1, 30.0, 1)]


def test_sales_need_no_delivery_date(spark):
    t = small(spark, orders=[order("1", "2017-01-05")], order_items=[item("1", "10")])
    orders = t["orders"].drop("order_delivered_customer_date", "order_delivered_carrier_date")
    assert rows(sales_patterns(orders, t["order_items"]))[0][1:4] == (1, 10.0, 1)
    with pytest.raises(ValueError, match="order_delivered_customer_date"):
        time_metrics(orders, t["order_items"])


def test_delivery_days_are_per_item(spark):
    t = small(
        spark,
        orders=[
            order("1", "2020-01-01T00:00:00.25", arrived="2020-01-02"),
            order("2", "2020-01-01", arrived="2020-01-04"),
            order("3", "2020-01-01"),
        ],
        order_items=[item("1", "1"), item("2", "1"), item("2", "1"), item("3", "1")],
    )
    first = 0.9999971064814814
    (report,) = rows(time_metrics(t["orders"], t["order_items"]))
    assert report[5] == pytest.approx((first + 3 + 3) / 3, rel=1e-15)


def test_reviews_weight_the_items(spark):
    t = small(
        spark,
        order_items=[item("1", "10"), item("2", "20"), item("3", "40")],
        products=[("p", "toys")],
        order_reviews=[("1", 5), ("1", 1), ("2", None)],
    )
    args = (t["products"], t["order_items"], t["order_reviews"], None)
    report = product_performance(*args, more_orders_than=0)
    # Order 1 counts twice, order 2 once with no score, order 3 once without a review.
    assert rows(report) == [("toys", 1, 3, 80.0, 20.0, 3.0)]
    once = product_performance(*args, more_orders_than=0, one_review_per_order=True)
    assert rows(once) == [("toys", 1, 3, 70.0, 70 / 3, 3.0)]


def test_category_names(spark):
    t = small(
        spark,
        order_items=[item("1", "1", p) for p in "abcd"],
        products=[("a", "x"), ("b", "y"), ("c", ""), ("d", None)],
        category_translation=[("x", "X"), ("y", None)],
    )
    args = (t["products"], t["order_items"], t["order_reviews"])
    english = category_analysis(*args, t["category_translation"], more_orders_than=0)
    assert {r[0] for r in rows(english)} == {"X", "y", "", None}
    raw = category_analysis(*args, None, more_orders_than=0)
    assert {r[0] for r in rows(raw)} == {"x", "y", "", None}
    assert raw.columns == english.columns
    # NULL sorts last among equals, and the ranking has all of them.
    assert [r[0] for r in rows(top_categories(raw, 10))] == ["", "x", "y", None]


def test_thresholds_exclude_and_include(spark):
    t = small(
        spark,
        orders=[order(str(i), "2017-01-01") for i in range(12)],
        order_items=[item(str(i), "1", "p", "ten" if i < 10 else "two") for i in range(12)],
        products=[("p", "c")],
        sellers=[("ten", "SP"), ("two", "SP")],
    )
    sellers = seller_performance(t["sellers"], t["order_items"], t["orders"], t["order_reviews"])
    assert [r[0] for r in rows(sellers)] == ["ten"]  # 10 is enough
    args = (t["products"], t["order_items"], t["order_reviews"], None)
    assert rows(product_performance(*args, more_orders_than=12)) == []  # 12 is not more than 12
    assert len(rows(product_performance(*args, more_orders_than=11))) == 1


def test_sellers_without_reviews_are_in_the_first_rating_quintile(spark):
    t = small(
        spark,
        orders=[order(str(i), "2017-01-01", carrier="2017-01-02") for i in range(5)],
        order_items=[item(str(i), str(i + 1), "p", f"s{i}") for i in range(5)],
        sellers=[(f"s{i}", "SP") for i in range(5)],
        order_reviews=[(str(i), i + 1) for i in range(4)],
    )
    report = seller_performance(
        t["sellers"], t["order_items"], t["orders"], t["order_reviews"],
        orders_at_least=1,
    )
    by_rating = {r["seller_id"]: r["rating_quintile"] for r in report.collect()}
    assert by_rating == {"s4": 1, "s3": 2, "s2": 3, "s1": 4, "s0": 5}
    assert {r["avg_shipping_time"] for r in report.collect()} == {24.0}


def test_empty_tables(spark):
    t = small(spark)
    assert rows(sales_patterns(t["orders"], t["order_items"])) == []
    assert rows(time_metrics(t["orders"], t["order_items"])) == []
    assert rows(customer_behavior(t["customers"], t["orders"], t["order_items"])) == []
    args = (t["products"], t["order_items"], t["order_reviews"], t["category_translation"])
    assert rows(category_analysis(*args)) == []
    assert rows(seller_performance(t["sellers"], t["order_items"], t["orders"], t["order_reviews"])) == []


def test_double_prices(spark):
    t = small(spark, orders=[order("1", "2017-01-05")], order_items=[item("1", "0.1"), item("1", "0.2")])
    items = t["order_items"].withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value")})
    assert rows(sales_patterns(t["orders"], items))[0][2] == 0.3


# Plans ---------------------------------------------------------------------------------------------


@pytest.fixture
def stored(spark, tmp_path):
    folder = str(tmp_path)
    load(spark, random_tables(3, n=3000, hot=True))
    for name in SCHEMAS:
        spark.table(name).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in SCHEMAS}


def test_status_filter_and_columns_reach_the_scan(stored):
    text = plan(sales_patterns(stored["orders"], stored["order_items"]))
    assert "EqualTo(order_status,delivered)" in text
    assert "ReadSchema: struct<order_id:string,price:decimal(12,2)>" in text
    assert "order_delivered" not in text


def test_months_fold_items_before_the_join(stored, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(monthly_sales(stored["orders"], stored["order_items"]))
    # The items once as rows, folded on the map side, then once more as orders; the orders once.
    assert text.count("Exchange hashpartitioning(order_id") == 3
    assert text.count("SortMergeJoin") == 1 and "Window" not in text


@pytest.mark.parametrize("report", [monthly_sales, None], ids=["months", "customers"])
def test_hot_order_is_split(spark, stored, joins, conf, report):
    """A third of the orders table under one id, while items hold that id very often too."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    copies = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "o0").otherwise(F.concat(F.lit("x"), F.col("id"))).alias("order_id"),
        F.concat(F.lit("c"), F.col("id") % 40).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit("2017-01-01").cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
    )
    items = copies.select("order_id").unionByName(stored["order_items"].select("order_id")).withColumns(
        {"price": F.lit(1).cast("decimal(12,2)"), "freight_value": F.lit(1).cast("decimal(14,4)")}
    )
    if report is None:
        result = customer_metrics(stored["customers"], copies, items)
    else:
        result = report(copies, items)
    text = final_plan(result)
    assert "skew=true" in text
    hot = items.where("order_id = 'o0'").count()
    if report is not None:
        (month,) = rows(result)
        assert month[1] == 13334 and month[2] == 40
        # 6667 rows of the hot order, each with all its items, and one item for each other order.
        assert month[3] == 6667 * hot + 13333


def test_sellers_fold_on_the_partitioning_of_the_join(stored, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(
        seller_metrics(
            stored["sellers"], stored["order_items"], stored["orders"], stored["order_reviews"]
        )
    )
    # Items, orders and reviews, each once.
    assert text.count("Exchange hashpartitioning(order_id") == 3
    assert len(re.findall(r"FileScan parquet [^\n]*seller_id[^\n]*product_id|FileScan parquet [^\n]*product_id[^\n]*seller_id", text)) == 1
    assert "hashpartitioning(order_id#" in text and "Expand" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_seller_metrics_without_products(spark, tables):
    args = tables["sellers"], tables["order_items"], tables["orders"], tables["order_reviews"]
    whole, part = seller_metrics(*args), seller_metrics(*args, products=False)
    assert "unique_products" not in part.columns
    same(part, whole.drop("unique_products"))


def test_products_without_category_go_round_the_join(spark, conf):
    """Four fifths of the products have no category, and the translation is an aggregate."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="8")
    products = spark.range(20000).select(
        F.col("id").cast("string").alias("product_id"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("c"), F.col("id") % 97)).alias("product_category_name"),
    )
    names = spark.range(500).select(F.concat(F.lit("c"), F.col("id") % 100).alias("product_category_name"), F.lit("x").alias("n"))
    translation = names.groupBy("product_category_name").agg(F.min("n").alias("product_category_name_english"))
    named = product_categories(products, translation)
    tasks = named.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).first()
    assert tasks[1] == 20000 and tasks[0] <= 20000 / 8 * 2
    assert named.where("category IS NULL").count() == 16000
    assert named.where("category = 'x'").count() == 4000


def test_hot_product_is_split(stored, joins, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    report = product_performance(
        stored["products"], stored["order_items"], stored["order_reviews"], None, more_orders_than=0
    )
    assert "skew=true" in final_plan(report)


def test_left_join_reviews_adds_up_once(spark):
    """Values are those of the plain left join, and nothing is grouped again after the join."""
    from types import SimpleNamespace

    from __spark_entry__ import _left_join_reviews

    items = spark.createDataFrame(
        [(1, 7, "2.50"), (1, 7, "3.00"), (1, 8, None), (2, 7, "1.00"), (None, 7, "4.00"), (None, 7, "5.00"), (3, None, "6.00")],
        "order_id long, product_id long, price string",
    ).withColumn("price", F.col("price").cast("decimal(12,2)"))
    reviews = spark.createDataFrame(
        [(1, 5), (1, None), (1, 2), (2, None), (None, 4), (9, 1)], "order_id long, review_score int"
    )
    got = _left_join_reviews(SimpleNamespace(order_items=items, order_reviews=reviews))
    want = (
        items.join(reviews, "order_id", "left")
        .groupBy("order_id", "product_id")
        .agg(
            F.count(F.lit(1)),
            F.sum("price").cast("double"),
            F.sum("review_score"),
            F.count("review_score"),
        )
    )
    found = sorted(map(str, rows(got)))
    # An order with reviews but without a score has no sum, as in SQL.
    assert found == sorted(map(str, rows(want)))
    above = plan(got).split("Join")[0]
    assert "Aggregate" not in above
