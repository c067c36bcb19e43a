"""CSV reading, tables, layout, JDBC options, streams, the whole job, and the driver contract."""

import time
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import plan, rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura import session
from mercatura.functions import elapsed, month_of, since_epoch
from mercatura.llm import lines
from mercatura.plans import job
from mercatura.plans.products import category_analysis
from mercatura.plans.sales import delivered_items, fold_to_orders, monthly_sales, monthly_totals
from mercatura.schema import SCHEMAS
from mercatura.sources import layout, tables
from mercatura.sources.csv_files import (
    EmptyCsvError,
    read_clean,
    read_or_skip,
    read_plain,
    read_text_csv,
    write_csv,
)
from mercatura.sources.jdbc import JdbcTable
from mercatura.streaming import (
    append_available,
    daily_sales,
    months_from_days,
    order_sales_stream,
    stream_parquet,
)

ITEM_COLUMNS = "order_id string, price decimal(12,2), freight_value decimal(14,4), order_delivered_customer_date timestamp_ntz"


# CSV ---------------------------------------------------------------------------------------------


def test_bom_line_ends_and_quotes(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_bytes(
        "﻿k,v\r\n01409,\"a\r\nb\"\r\n2,\"say \"\"hi\"\"\"\r\n3,NA\r\n4,n/a\r\n5,\r\n6,\"\"\r\n".encode()
    )
    df = read_plain(spark, str(file), multi_line=True)
    assert df.columns == ["k", "v"]
    got = rows(df)
    assert [r[0] for r in got] == ["01409", "2", "3", "4", "5", "6"]
    assert got[0][1].replace("\r", "") == "a\nb"
    assert [r[1] for r in got[1:]] == ['say "hi"', None, None, None, None]


def test_plain_and_clean(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text(
        "order_id,customer_id,order_purchase_timestamp,order_delivered_customer_date,n\n"
        "a,1,2017-10-02 10:56:33,,7\nb,,2017-10-03,never,\n"
    )
    plain = read_plain(spark, str(file), SCHEMAS["orders"], infer=True)
    assert rows(plain) == [
        ("a", "1", "2017-10-02 10:56:33", None, 7),
        ("b", None, "2017-10-03", "never", None),
    ]
    clean = read_clean(spark, str(file), SCHEMAS["orders"], infer=True)
    assert rows(clean) == [
        ("a", "1", ts("2017-10-02T10:56:33"), "", 7),
        ("b", "", ts("2017-10-03"), "never", None),
    ]


def test_typed_columns(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("order_id,product_id,seller_id,price,freight_value,extra\n007,p,s,58.90,13.29,1\n8,p,s,NA,,x\n")
    df = read_plain(spark, str(file), SCHEMAS["order_items"])
    assert rows(df) == [
        ("007", "p", "s", Decimal("58.90"), Decimal("13.2900"), "1"),
        ("8", "p", "s", None, None, "x"),
    ]
    assert df.schema["price"].dataType == T.DecimalType(12, 2)


def test_translation_file_layout(spark, tmp_path):
    file = tmp_path / "t.csv"
    lines = ["product_category_name,product_category_name_english"]
    lines += [f"nome_{i},name_{i}" for i in range(71)]
    file.write_bytes(("﻿" + "\r\n".join(lines) + "\r\n").encode())
    df = read_clean(spark, str(file), SCHEMAS["category_translation"])
    assert df.columns == lines[0].split(",") and df.count() == 71
    assert rows(df)[70] == ("nome_70", "name_70")


def test_ragged_rows_raise(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_text_csv(spark, str(file)).collect()


def test_files_of_a_folder_have_the_same_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,product_id\no1,p1\n")
    (tmp_path / "b.csv").write_text("order_id,product_id\no2,p2\n")
    assert sorted(rows(read_text_csv(spark, str(tmp_path)))) == [("o1", "p1"), ("o2", "p2")]
    (tmp_path / "c.csv").write_text("product_id,order_id\np3,o3\n")
    with pytest.raises(Exception, match="(?i)header|enforceSchema"):
        read_text_csv(spark, str(tmp_path)).collect()


def test_missing_and_empty_files(spark, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    for path, error in ((str(empty), EmptyCsvError), (str(tmp_path / "none.csv"), Exception)):
        assert read_or_skip(read_plain, spark, path, "skip") is None
        with pytest.raises(error):
            read_or_skip(read_plain, spark, path)
    with pytest.raises(ValueError):
        read_or_skip(read_plain, spark, str(empty), "ignore")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a,b", 'x"y', Decimal("1.50"), ts("2020-01-01T00:00:00.25")), ("c", None, None, None)],
        "k string, s string, price decimal(12,2), order_date timestamp_ntz",
    )
    write_csv(df, str(tmp_path / "out"))
    schema = T.StructType([T.StructField("price", T.DecimalType(12, 2))])
    back = parse = read_clean(spark, str(tmp_path / "out"), schema)
    assert sorted(rows(back)) == [
        ("a,b", 'x"y', Decimal("1.50"), ts("2020-01-01T00:00:00.25")),
        ("c", "", None, None),
    ]
    assert parse.schema["order_date"].dataType == T.TimestampNTZType()


# Tables, layout, JDBC ----------------------------------------------------------------------------------


def test_replace_and_look_up_tables(spark):
    tables.replace_table(spark.range(3), "t_replace")
    tables.replace_table(spark.range(2).withColumn("x", F.lit(1)), "t_replace")
    assert tables.table_or_none(spark, "t_replace").count() == 2
    assert tables.table_or_none(spark, "t_absent") is None


def test_bundle_needs_all_but_the_optional_tables(spark):
    frames = {name: spark.createDataFrame([], s) for name, s in SCHEMAS.items()}
    whole = tables.bundle({**frames, "category_translation": None})
    assert whole.category_translation is None and "orders" in whole.present()
    with pytest.raises(ValueError, match="sellers"):
        tables.bundle({**frames, "sellers": None})


def test_catalog_and_folders_hold_the_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS catalogued")
    required = SCHEMAS.keys() - tables.OPTIONAL_TABLES
    for name in required:
        df = spark.createDataFrame([], SCHEMAS[name])
        tables.replace_table(df, name, "catalogued")
        tables.replace_folder(df, f"{tmp_path}/{name}")
    for found in (tables.catalog_tables(spark, "catalogued"), tables.folder_tables(spark, str(tmp_path))):
        assert found.present().keys() == required
        # Without a translation table the category report falls back to the raw names.
        report = category_analysis(
            found.products, found.order_items, found.order_reviews, found.category_translation
        )
        assert rows(report) == []
    tables.replace_table(
        spark.createDataFrame([], SCHEMAS["category_translation"]), "category_translation", "catalogued"
    )
    assert tables.catalog_tables(spark, "catalogued").category_translation is not None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.folder_tables(spark, f"{tmp_path}/nowhere")


def sample_orders(spark, n=1000):
    orders = spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit("delivered").alias("order_status"),
        (F.col("id") % 50).cast("string").alias("customer_id"),
        F.expr("timestamp_ntz'2017-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int))").alias(
            "order_purchase_timestamp"
        ),
    )
    items = spark.range(2 * n).select(
        (F.col("id") % n).cast("string").alias("order_id"),
        F.lit(2).cast("decimal(12,2)").alias("price"),
        F.lit(1).cast("decimal(14,4)").alias("freight_value"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_customer_date"),
    )
    return orders, items


def test_bucketed_tables_join_without_a_shuffle(spark, conf):
    orders, items = sample_orders(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS laid_out")
    done = layout.write_layout(
        {"orders": orders, "order_items": items, "customers": spark.range(2)}, 4, "laid_out"
    )
    assert done == {"orders": True, "order_items": True, "customers": False}
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    report = monthly_sales(spark.table("laid_out.orders"), spark.table("laid_out.order_items"))
    assert "Exchange hashpartitioning(order_id" not in plan(report)
    assert rows(report.agg(F.sum("revenue"))) == [(4000.0,)]


def test_skewed_tables_are_not_bucketed_unasked(spark):
    orders, items = sample_orders(spark)
    hot = items.withColumn("order_id", F.lit("1"))
    assert layout.bucket_skew(hot, "order_id", 8) == 8.0
    assert layout.bucket_skew(hot.limit(0), "order_id", 8) == 0.0
    spark.sql("CREATE DATABASE IF NOT EXISTS skewed")
    with pytest.raises(ValueError, match="too skewed"):
        layout.write_layout({"orders": orders, "order_items": hot}, 8, "skewed")
    assert tables.table_or_none(spark, "orders", "skewed") is None
    done = layout.write_layout({"orders": orders, "order_items": hot}, 8, "skewed", max_skew=9)
    assert done == {"orders": True, "order_items": True}
    assert spark.table("skewed.order_items").count() == 2000


def rows_scanned(df):
    """Rows that the scans of ``df`` hand on: those of the row groups that are not skipped."""
    df.collect()

    def walk(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        own = node.metrics().get("numOutputRows") if "Scan" in node.nodeName() else None
        below = [walk(node.children().apply(i)) for i in range(node.children().size())]
        return (own.get().value() if own is not None and own.isDefined() else 0) + sum(below)

    return walk(df._jdf.queryExecution().executedPlan())


def many_orders(spark, n=60_000):
    """A third of them were bought at one moment."""
    at = F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 1_500_000_000).otherwise(1_483_228_800 + F.col("id") * 500))
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") * 7919 % 50_000).alias("customer_id"),
        F.when(F.col("id") % 1000 != 0, at).cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )


def test_a_span_of_time_reads_few_row_groups(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    spark.sql("CREATE DATABASE IF NOT EXISTS timed")
    orders = many_orders(spark)
    layout.write_by_time(orders, "orders_by_time", database="timed", row_group_bytes=30_000)
    stored = spark.table("timed.orders_by_time")
    for start, end in (("2017-03-01", "2017-04-01"), ("2017-03-05T10:00:00", "2017-03-05T12:00:00"),
                       ("2017-07-14T02:40:00", "2017-07-14T02:40:01"), ("2030-01-01", "2030-02-01")):
        start, end = ts(start), ts(end)
        at = F.col("order_purchase_timestamp")
        want = orders.where((at >= F.lit(str(start)).cast("timestamp_ntz")) & (at < F.lit(str(end)).cast("timestamp_ntz")))
        got = layout.between(stored, start, end)
        assert got.columns == orders.columns
        assert sorted(rows(got)) == sorted(rows(want))
        assert "order_purchase_timestamp_day" in plan(got).split("PushedFilters")[1]
        assert rows_scanned(got) <= want.count() + 60_000 / 4
    assert rows_scanned(stored) == 60_000
    sizes = [r[0] for r in stored.groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(sizes) > 2 and max(sizes) <= 2 * 60_000 / len(sizes)


def test_a_lookup_reads_few_row_groups(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS looked_up")
    orders = many_orders(spark)
    items = spark.range(60_000).select(
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") * 104_729 % 59_999).alias("product_id"),
        (F.col("id") * 1_299_709 % 40_009).cast("string").alias("seller_id"),
    )
    layout.write_layout({"orders": orders, "order_items": items}, 4, "looked_up", row_group_bytes=30_000)
    for name, df, key, value in (("orders", orders, "customer_id", 4242), ("order_items", items, "product_id", 77),
                                 ("order_items", items, "seller_id", "1234")):
        stored = spark.table(f"looked_up.{name}")
        got = stored.where(F.col(key) == value)
        want = df.where(F.col(key) == value)
        assert got.count() == want.count() > 0
        assert rows_scanned(got) < 60_000 / 3 and rows_scanned(stored) == 60_000
        assert rows_scanned(stored.where(F.col(key).isin(value, value + value))) < 60_000 / 2
    assert layout.lookup_options([]) == {}


def test_small_row_groups_leave_a_writer_little_to_keep(spark, monkeypatch):
    monkeypatch.setattr(layout, "FILE_ROWS", 5_000, raising=False)
    options = layout.lookup_options(["customer_id"], 30_000)
    assert int(options["parquet.bloom.filter.max.bytes"]) <= 30_000 / 4
    assert "maxRecordsPerFile" not in layout.lookup_options(["customer_id"])
    spark.sql("CREATE DATABASE IF NOT EXISTS kept_small")
    orders = many_orders(spark)
    layout.write_layout({"orders": orders}, 4, "kept_small", row_group_bytes=30_000)
    layout.write_by_time(orders, "orders_by_time", database="kept_small", row_group_bytes=30_000)
    for name in ("orders", "orders_by_time"):
        stored = spark.table(f"kept_small.{name}").select(*orders.columns)
        assert sorted(map(str, rows(stored))) == sorted(map(str, rows(orders)))
        sizes = [r[0] for r in stored.groupBy(F.input_file_name()).count().select("count").collect()]
        assert max(sizes) <= 5_000


def test_jdbc_options():
    table = JdbcTable("jdbc:postgresql://db/shop", "orders", user="u", password="p")
    assert table.read_options() == {
        "url": "jdbc:postgresql://db/shop", "dbtable": "orders", "driver": "org.postgresql.Driver",
        "user": "u", "password": "p", "fetchsize": "10000",
    }
    assert "'p'" not in repr(table)
    split = JdbcTable("jdbc:x", "t", partition_column="id", lower_bound=0, upper_bound=9, partitions=3)
    assert split.read_options()["numPartitions"] == "3" and split.read_options()["upperBound"] == "9"
    assert split.write_options()["batchsize"] == "10000"
    with pytest.raises(ValueError, match="lowerBound"):
        JdbcTable("jdbc:x", "t", partition_column="id").read_options()
    with pytest.raises(ValueError):
        JdbcTable("postgresql://x", "t").write_options()


def test_totals_are_computed_once_in_a_run(spark, tmp_path):
    from mercatura.plans.sales import growth_report, sales_report  # noqa: F401

    orders, items = sample_orders(spark)
    asked = []
    frames = {name: spark.createDataFrame([], s) for name, s in SCHEMAS.items()}
    whole = tables.bundle({**frames, "orders": orders, "order_items": items.withColumns(
        {"product_id": F.lit("x"), "seller_id": F.lit("x"),
         "order_delivered_carrier_date": F.lit(None).cast("timestamp_ntz")})})
    reports = job.build_reports(whole, share=lambda df: asked.append(df) or session.checkpointed(df))
    assert len(asked) == 2
    for report in (reports.sales, reports.time):
        assert "Scan" in plan(report) and "Range" not in plan(report)
    assert rows(reports.sales.agg(F.sum("revenue"))) == [(4000.0,)]


def test_scratch_is_dropped(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.drop_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.drop_scratch(spark, "/somewhere/else")


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == base
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_a_cluster_without_a_checkpoint_folder_uses_the_warehouse(spark, monkeypatch):
    class Context:
        master = "local-cluster[3,4,1024]"
        applicationId = "other"
        defaultParallelism = 2
        _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
        given = None

        def getCheckpointDir(self):
            return self.given

        def setCheckpointDir(self, path):
            self.given = path

    class Session:
        sparkContext, range, read = Context(), spark.range, spark.read

        class conf:
            @staticmethod
            def get(key, default=None):
                return None if key == "spark.checkpoint.dir" else spark.conf.get(key, default)

    base = session.shared_dir(Session())
    assert base == f"{spark.conf.get('spark.sql.warehouse.dir')}/_mercatura" == Session.sparkContext.given
    Session.sparkContext.given = None
    monkeypatch.setattr(session, "_is_shared", lambda spark, base: False)
    with pytest.raises(ValueError, match="every executor"):
        session.shared_dir(Session())


def test_a_shared_folder_needs_no_scheme_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "_is_local", lambda spark: False)
    base = spark.conf.get("spark.checkpoint.dir")
    assert "://" not in base
    assert session.shared_dir(spark) == base
    assert not list(Path(base).glob("probe-*"))
    assert session.checkpointed(spark.range(3)).count() == 3
    monkeypatch.setattr(session, "_is_shared", lambda spark, base: False)
    with pytest.raises(ValueError, match="own disk"):
        session.shared_dir(spark)


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for folder in manager.localDirsString() for f in Path(folder).rglob("shuffle_*") if f.is_file()}


@pytest.mark.parametrize("store", ["checkpoint", "shelf"])
def test_what_a_stored_table_shuffled_goes_at_once(spark, store):
    before = _shuffle_files(spark)
    option = spark.conf.get(session._CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    shelf = lines._Shelf(spark)
    done = session.checkpointed(df) if store == "checkpoint" else shelf.put(df)
    # Held by the frames above, nothing else would delete them.
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(session._CLEANUP, None) == option
    assert sorted(rows(done)) == sorted(rows(df)) == sorted(rows(df))
    shelf.clear()


# Streams ---------------------------------------------------------------------------------------------------


def test_stream_in_steps_equals_batch(spark, tmp_path):
    orders, items = sample_orders(spark)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    first = items.where(F.col("order_id").cast("int") < 400)
    rest = items.where(F.col("order_id").cast("int") >= 400)

    def run():
        stream = stream_parquet(spark, source, items.schema, files_per_batch=2)
        return append_available(
            delivered_items(orders, stream), f"{folder}/facts", f"{folder}/checkpoint"
        )

    first.repartition(3).write.parquet(source)
    run()
    rest.repartition(3).write.mode("append").parquet(source)
    run()
    facts = run()  # nothing new
    assert facts.count() == 2000
    got = monthly_totals(fold_to_orders(facts))
    assert sorted(rows(got)) == sorted(rows(monthly_sales(orders, items)))


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
@pytest.mark.parametrize("files", [None, 1])
def test_days_are_complete_however_the_items_come(spark, tmp_path, conf, zone, files):
    conf(spark__sql__session__timeZone=zone)
    orders, items = sample_orders(spark)
    source, folder = str(tmp_path / "in"), str(tmp_path / "days")
    items.repartition(5).write.parquet(source)

    def run():
        stream = stream_parquet(spark, source, items.schema, files_per_batch=files)
        return daily_sales(stream, orders, folder, str(tmp_path / "checkpoint"))

    days = run()
    assert days.count() == 300
    assert days.agg(F.min("day"), F.max("day")).first() == (ts("2017-01-01"), ts("2017-10-27"))
    january = rows(months_from_days(days).orderBy("month"))[0]
    assert january == (ts("2017-01-01"), 31 * 8 * 2.0, 31 * 8 * 1.0, 31 * 8)
    assert rows(days.agg(F.sum("items"))) == [(2000,)]
    # A batch repeated after a failure: its commit is lost, its folder is there.
    for commit in (tmp_path / "checkpoint" / "commits").iterdir():
        if not commit.name.startswith("."):
            last = commit
            last.unlink()
            (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    assert rows(run().agg(F.sum("items"))) == [(2000,)]


def test_streamed_orders_are_those_of_the_batch(spark, tmp_path):
    orders, items = sample_orders(spark)
    source = str(tmp_path / "in")
    items.repartition(4).write.parquet(source)
    stream = stream_parquet(spark, source, items.schema, files_per_batch=1)
    per_order = order_sales_stream(stream, orders, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert per_order.count() == 1000
    assert sorted(rows(monthly_totals(per_order))) == sorted(rows(monthly_sales(orders, items)))


def test_a_stream_without_items_gives_nothing(spark, tmp_path):
    orders, items = sample_orders(spark)
    (tmp_path / "in").mkdir()
    stream = stream_parquet(spark, str(tmp_path / "in"), items.schema)
    assert rows(daily_sales(stream, orders, str(tmp_path / "out"), str(tmp_path / "checkpoint"))) == []


# The whole run ------------------------------------------------------------------------------------------------


def write_shop(folder: Path):
    """A small shop as CSV files, with what real files hold: blanks, quotes, unknown columns."""
    folder.mkdir()
    n = 60

    def put(name, header, lines):
        (folder / job.DATA_FILES[name]).write_text("\n".join([header, *lines]) + "\n")

    put("customers", "customer_id,customer_state,customer_city",
        [f"c{i},{'SP' if i % 3 else 'RJ'},x" for i in range(20)])
    put("orders",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_carrier_date,order_delivered_customer_date",
        [f"o{i},c{i % 20},{'delivered' if i % 10 else 'shipped'},2018-0{1 + i % 6}-05 10:00:00,"
         + (f"2018-0{1 + i % 6}-06 10:00:00,2018-0{1 + i % 6}-09 10:00:00" if i % 10 else ",")
         for i in range(n)])
    put("order_items", "order_id,product_id,seller_id,price,freight_value",
        [f"o{i},p{i % 7},s{i % 2},{10 + i}.50,2.25" for i in range(n)])
    put("products", "product_id,product_category_name,product_weight_g",
        [f"p{i},{'brinquedos' if i < 5 else ''},{i}" for i in range(7)])
    put("sellers", "seller_id,seller_state", ["s0,SP", "s1,RJ"])
    put("order_reviews", "order_id,review_score,review_comment",
        [f'o{i},{1 + i % 5},"line one\nline ""two"""' for i in range(0, n, 2)])
    put("order_payments", "order_id,payment_value", [f"o{i},1.0" for i in range(n)])
    put("category_translation", "product_category_name,product_category_name_english",
        ["brinquedos,toys"])


@pytest.mark.parametrize("buckets", [None, 2])
def test_job(spark, tmp_path, buckets, capsys):
    write_shop(tmp_path / "data")
    out = str(tmp_path / "out")
    database = None
    if buckets:
        database = "shop"
        spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    reports = job.run(
        spark,
        job.data_paths(str(tmp_path / "data")),
        out,
        buckets=buckets,
        database=database,
        multi_line=["order_reviews"],
    )
    months = rows(reports["time_metrics"].orderBy("month"))
    assert len(months) == 6 and months[0][5] == 4.0
    assert sum(r[1] for r in rows(reports["sales_patterns"])) == 54
    # Order 10i has no blank in the raw files but a missing date; the text fill names no category.
    assert {r[0] for r in rows(reports["product_performance"])} == {"toys", ""}
    assert rows(reports["category_analysis"]) == []
    sellers = rows(reports["seller_performance"])
    assert [r[0] for r in sorted(sellers)] == ["s0", "s1"] and sellers[0][6] == 24.0
    summary = {r[0]: r[1:] for r in rows(reports["seller_summary"])}
    assert summary["count"][0] == 2.0 and summary["mean"][0] == 30.0
    read = spark.read.parquet
    assert rows(read(f"{out}/quality/duplicates/orders")) == [(0,)]
    reduction = {r[0]: r[1:] for r in rows(read(f"{out}/quality/null_reduction/products"))}
    assert reduction["product_category_name"] == (pytest.approx(200 / 7), 0.0)
    nulls = {r[0]: r[1:] for r in rows(read(f"{out}/quality/columns/orders"))}
    assert nulls["order_delivered_customer_date"] == (10.0, 10.0)
    assert nulls["order_status"] == (0.0, 10.0)
    dates = {r[0]: r[1:] for r in rows(read(f"{out}/quality/date_ranges/orders"))}
    assert dates["order_purchase_timestamp"] == (ts("2018-01-05T10:00:00"), ts("2018-06-05T10:00:00"))
    rates = {r[1]: r[4] for r in rows(read(f"{out}/quality/validation"))}
    assert rates["order_id is in orders"] == 100.0
    assert rates["product has a category"] == pytest.approx(500 / 7)
    assert read(f"{out}/plots/revenue_trend").count() == 6
    if buckets:
        may = layout.between(spark.table("shop.orders_by_time"), ts("2018-05-01"), ts("2018-06-01"))
        assert may.count() == 10
    job.show_summaries(reports)
    assert "toys" not in capsys.readouterr().err


def test_job_skips_missing_optional_files(spark, tmp_path):
    write_shop(tmp_path / "data")
    paths = job.data_paths(str(tmp_path / "data"))
    paths["category_translation"] = str(tmp_path / "nowhere.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        job.run(spark, paths, str(tmp_path / "out1"), multi_line=["order_reviews"])
    reports = job.run(
        spark, paths, str(tmp_path / "out2"), on_missing="skip", multi_line=["order_reviews"]
    )
    assert {r[0] for r in rows(reports["product_performance"])} == {"brinquedos", ""}


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from mercatura import __main__ as command

    write_shop(tmp_path / "data")
    (tmp_path / "data" / "sellers_dataset.csv").rename(tmp_path / "data" / "shops.csv")
    monkeypatch.setattr(command, "session", lambda: spark)
    command.main([str(tmp_path / "data"), str(tmp_path / "out"), "--file", "sellers=shops.csv",
                  "--multi-line", "order_reviews"])
    assert "toys" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        command.main([str(tmp_path / "data"), str(tmp_path / "out"), "--file", "nonsense"])


def test_durations_do_not_depend_on_the_session_zone(spark, conf):
    # Midnight of 2017-10-15 does not exist on the clocks of São Paulo.
    days = spark.sql("SELECT timestamp_ntz'2017-10-15 00:30:00' AS a, timestamp_ntz'2017-10-15 02:00:00.000001' AS b")
    for zone in ("UTC", "America/Sao_Paulo"):
        conf(spark__sql__session__timeZone=zone)
        (got,) = rows(days.select(elapsed("a", "b"), since_epoch("a"), month_of("a")))
        assert got == (Decimal("5400.000001"), Decimal("1508027400.000000"), ts("2017-10-01"))


# The driver contract ----------------------------------------------------------------------------------------------


def test_contract(spark):
    import __spark_entry__ as contract

    own = {q for q in contract.queries() if not q.startswith("op") and q != "pipeline"}
    assert own <= set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns[0] == "month" and result.count() > 0


def test_streamed_tables_may_be_files_or_folders(spark, tmp_path):
    import __spark_entry__ as contract

    sample = Path(contract.SMOKE_DIR)
    for name in ("lineitem", "orders"):
        parts = spark.read.parquet(f"{sample}/{name}.parquet").repartition(3)
        parts.write.parquet(f"{tmp_path}/{name}.parquet")
    for query in ("stream_sales", "stream_daily_sales"):
        run = contract.queries()[query]
        from_file, from_folder = rows(run(spark, str(sample))), rows(run(spark, str(tmp_path)))
        assert from_file and sorted(from_file) == sorted(from_folder)
