"""Streams of items and orders in any order of arrival, and what their folds leave on disk."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from mercatura.plans.sales import monthly_sales, monthly_totals
from mercatura.streaming import (
    FoldStore,
    daily_sales,
    estimated_customers,
    fold_items,
    latest_orders,
    order_sales_stream,
    stream_parquet,
    waiting_items,
)
from mercatura.streaming import store as stores

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,"
    " version int"
)
ITEMS = (
    "order_id string, price decimal(10,2), freight_value decimal(10,2),"
    " order_delivered_customer_date timestamp_ntz"
)


def shop(spark, n=60, seed=1):
    """Versions of orders and their items, a third of them of one order."""
    rng = random.Random(seed)
    start = datetime(2018, 1, 1)
    orders, items = [], []
    for i in range(n):
        bought = start + timedelta(days=rng.randrange(90), seconds=rng.randrange(80000))
        path = rng.choice([["delivered"], ["shipped", "delivered"], ["delivered", "canceled"], ["shipped"]])
        orders += [(f"o{i}", f"c{i % 7}", status, bought, v) for v, status in enumerate(path)]
        for _ in range(rng.choice([0, 1, 3]) if i else n):
            arrived = rng.choice([None, bought + timedelta(hours=rng.randrange(1, 99))])
            items.append((f"o{i}", Decimal(rng.randrange(9999)) / 100, Decimal("1.25"), arrived))
    return spark.createDataFrame(orders, ORDERS), spark.createDataFrame(items, ITEMS)


def current(versions):
    last = versions.groupBy("order_id").agg(F.max_by(F.struct("*"), "version").alias("o"))
    return last.select("o.*")


def day_sums(orders, items):
    day = F.col("order_purchase_timestamp").cast("date").cast("timestamp_ntz").alias("day")
    sold = items.join(orders.where("order_status = 'delivered'"), "order_id")
    return sold.groupBy(day).agg(F.sum("price"), F.sum("freight_value"), F.count(F.lit(1)))


def append(df, path, files):
    df.repartition(files).write.mode("append").parquet(path)


def same(left, right):
    assert sorted(map(repr, rows(left))) == sorted(map(repr, rows(right)))


@pytest.mark.parametrize("seed", [1, 2])
def test_items_wait_for_their_orders(spark, tmp_path, seed):
    versions, items = shop(spark, seed=seed)
    orders = current(versions)
    source = str(tmp_path / "in")

    def run(known):
        stream = stream_parquet(spark, source, items.schema, files_per_batch=1)
        days = daily_sales(stream, known, str(tmp_path / "items"), str(tmp_path / "checkpoint"))
        per_order = order_sales_stream(stream, known, str(tmp_path / "items2"), str(tmp_path / "checkpoint2"))
        return days, per_order

    # Items first, for some orders none that is known, for others one that is not delivered yet.
    append(items.where(F.hash("price") % 2 == 0), source, 3)
    early = versions.where("version = 0").where(F.hash("order_id") % 2 == 0)
    for known, part in ((early, items.where(F.hash("price") % 2 == 0)), (orders, None)):
        if part is None:
            append(items.where(F.hash("price") % 2 != 0), source, 2)
            part = items
        days, per_order = run(known)
        same(days, day_sums(known, part))
        same(monthly_totals(per_order), monthly_sales(known, part))


@pytest.mark.parametrize("version", ["version", None])
def test_versions_of_orders_may_come_as_a_stream(spark, tmp_path, version):
    versions, items = shop(spark)
    source = str(tmp_path / "in")

    def run():
        stream = stream_parquet(spark, source, versions.schema, files_per_batch=1)
        return latest_orders(stream, str(tmp_path / "orders"), str(tmp_path / "checkpoint"), version, 2)

    # With a version, the order of arrival is all the same.
    for v in (1, 0) if version else (0, 1):
        append(versions.where(F.col("version") == v), source, 3)
        found = run()
    assert found.columns == versions.columns
    same(found, current(versions))
    same(run(), current(versions))
    folds = fold_items(stream_parquet(spark, write(items, tmp_path), items.schema), str(tmp_path / "i"), str(tmp_path / "ic"))
    assert waiting_items(folds, found.where("order_id <> 'o0'")).select("order_id").collect() == [("o0",)]


def write(df, tmp_path):
    df.write.mode("overwrite").parquet(str(tmp_path / "items-in"))
    return str(tmp_path / "items-in")


def counts(spark, numbers):
    return spark.createDataFrame([(f"k{i % 5}", i) for i in numbers], "k string, n long")


def added(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def store_at(spark, tmp_path, fan_in=3):
    return FoldStore(spark, str(tmp_path / "store"), counts(spark, [1]).schema, added, fan_in)


def expected(batches):
    out = Counter()
    for b in range(batches):
        for i in range(b, b + 7):
            out[f"k{i % 5}"] += i
    return sorted(out.items())


def put(spark, store, batch):
    store.put(batch, added(counts(spark, range(batch, batch + 7))))


def test_blocks_stay_few(spark, tmp_path):
    store = store_at(spark, tmp_path)
    assert rows(store.read()) == []
    for batch in range(30):
        put(spark, store, batch)
        if batch in (0, 2, 8, 9, 26, 29):
            assert sorted(rows(store.read())) == expected(batch + 1)
    # 27 batches are one block, 3 are another; what is kept of merged ones is one merge each.
    assert store.blocks() == [(3, 0), (1, 9)]
    kept = [p for p in (tmp_path / "store").glob("level=*/block=*")]
    assert len(kept) <= 3 * 2 * 4


class Stopped(Exception):
    pass


@pytest.mark.parametrize("writes", range(1, 4))
def test_a_merge_that_is_cut_off_counts_nothing_twice(spark, tmp_path, monkeypatch, writes):
    """Batch 8 writes three times: itself, the third block of level 1, the first of level 2."""
    store = store_at(spark, tmp_path)
    for batch in range(8):
        put(spark, store, batch)
    real, done = stores.FoldStore._write, []

    def cut_off(self, df, level, block):
        done.append(level)
        if len(done) == writes:
            # Files without a marker are what a stopped write leaves.
            df.write.mode("overwrite").parquet(self._path(level, block))
            raise Stopped
        real(self, df, level, block)

    monkeypatch.setattr(stores.FoldStore, "_write", cut_off)
    with pytest.raises(Stopped):
        put(spark, store, 8)
    assert sorted(rows(store.read())) == expected(8 if writes == 1 else 9)
    monkeypatch.setattr(stores.FoldStore, "_write", real)
    for _ in range(2):
        put(spark, store, 8)
        assert sorted(rows(store.read())) == expected(9)
        assert store.blocks() == [(2, 0)]
    put(spark, store, 9)
    assert sorted(rows(store.read())) == expected(10)


def test_a_batch_repeated_by_the_stream_counts_once(spark, tmp_path):
    versions, items = shop(spark)
    source, folder, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    append(items, source, 9)

    def run():
        stream = stream_parquet(spark, source, items.schema, files_per_batch=1)
        return daily_sales(stream, current(versions), folder, checkpoint, fan_in=3)

    want = day_sums(current(versions), items)
    same(run(), want)
    # The last commit is lost after its batch was merged with all others.
    commits = sorted((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    same(run(), want)


def test_estimates_are_within_their_error(spark, tmp_path):
    orders = spark.range(40_000).select(
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") % 9000).alias("customer_id"),
        F.expr("timestamp_ntz'2018-01-01' + make_interval(0, 0, 0, int(id % 2))").alias("order_purchase_timestamp"),
    )
    source = str(tmp_path / "in")
    append(orders, source, 5)
    stream = stream_parquet(spark, source, orders.schema, files_per_batch=1)
    got = estimated_customers(stream, str(tmp_path / "days"), str(tmp_path / "checkpoint"), fan_in=2).collect()
    assert len(got) == 2
    for r in got:
        assert abs(r["customers"] / 4500 - 1) < 4 * r["standard_error"] < 0.07
