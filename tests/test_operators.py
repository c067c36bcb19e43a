"""Ranking, quantiles, profiles and cleaning on hand-made and generated rows."""

import math
from decimal import Decimal

import pandas as pd
import pytest
from conftest import final_plan, plan, rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercatura.operators import cleaning, quality, selection
from mercatura.operators.describe import box_outliers, box_stats, describe
from mercatura.operators.fanout import review_stats
from mercatura.operators.quantiles import exact_quantiles
from mercatura.operators.ranking import global_rank, ntile, tile_of

slow = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


# Ranking ---------------------------------------------------------------------------------------


def by_value():
    return [F.col("v").desc_nulls_first(), F.col("id").asc()]


def test_ntile_puts_nulls_first(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 4)], "id int, v int")
    got = {r["v"]: r["t"] for r in ntile(df, 2, by_value(), "t").collect()}
    assert got == {None: 1, 4: 1, 2: 2, 1: 2}


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003, 20000])
def test_distributed_ntile_is_ntile(spark, n):
    # Every third value is the same, some are NULL.
    value = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, (F.col("id") * 7919) % 101)
    df = spark.range(n).select("id", value.alias("v"))
    expected = df.withColumn("t", F.ntile(5).over(Window.orderBy(*by_value())))
    assert sorted(rows(ntile(df, 5, by_value(), "t")), key=str) == sorted(rows(expected), key=str)


@slow
@given(
    values=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=30),
    tiles=st.integers(1, 7),
)
def test_distributed_ntile_is_ntile_for_any_values(spark, values, tiles):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    expected = df.withColumn("t", F.ntile(tiles).over(Window.orderBy(*by_value())))
    assert sorted(rows(ntile(df, tiles, by_value(), "t")), key=str) == sorted(rows(expected), key=str)


def test_tile_formula(spark):
    tiled = spark.range(13).select(tile_of(F.col("id"), F.lit(13), 5).alias("t"))
    assert [r[0] for r in rows(tiled)] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5]


def test_ties_are_spread_over_partitions(spark):
    # One value on every row: the unique last key still splits it.
    df = spark.range(20000).select("id", F.lit(1).alias("v"))
    ranked = global_rank(df, [F.col("v").asc(), F.col("id").asc()])
    assert ranked.select("rank").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first() == (0, 19999, 20000)
    assert ranked.where(F.col("rank") != F.col("id")).count() == 0
    spread = ranked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert spread < 10000


def test_no_rank_gathers_all_rows(spark):
    df = spark.range(10).select("id", F.col("id").alias("v"))
    assert "ntile" not in plan(ntile(df, 5, by_value(), "t"))


def test_tiles_from_their_first_rows(spark, monkeypatch):
    """Parts are narrowed by small samples here, however many rows are equal in the first key."""
    monkeypatch.setattr(selection, "FEW", 100)
    monkeypatch.setattr(selection, "SAMPLED", 60)
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 3 == 0, 7.5).otherwise(F.hash("id") % 400 / 4).alias("v"),
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("s"), F.hash("id") % 9)).alias("s"),
        F.timestamp_seconds(F.hash("id") % 20).cast("timestamp_ntz").alias("t"),
    )
    orders = {
        "a": [selection.SortKey("v", descending=True), selection.SortKey("id")],
        "b": [selection.SortKey("v", nulls_first=False), selection.SortKey("s", descending=True), selection.SortKey("id", True)],
        "c": [selection.SortKey("s", descending=True, nulls_first=False), selection.SortKey("t"), selection.SortKey("id")],
    }
    got = selection.with_tiles(df, 7, orders)
    want = df.withColumns(
        {name: F.ntile(7).over(Window.orderBy(*[k.order() for k in keys])) for name, keys in orders.items()}
    )
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)
    # More equal rows than are sorted at once have no order.
    with pytest.raises(ValueError, match="equal"):
        selection.with_tiles(df, 3, {"x": [selection.SortKey("t")]})


@pytest.mark.parametrize("n", [0, 1, 3, 7])
def test_tiles_of_few_rows(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 2).alias("v"))
    got = selection.with_tiles(df, 5, {"t": [selection.SortKey("v"), selection.SortKey("id")]})
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy("v", "id")))
    assert sorted(rows(got)) == sorted(rows(want))


# Quantiles and summaries ---------------------------------------------------------------------------


def test_exact_quantiles(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 10.0), ("a", None), ("b", 7.0), ("c", None)],
        "g string, v double",
    )
    got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, "g", "v", [0.25, 0.5, 0.75, 0, 1]).collect()}
    assert got == {"a": (4, [1.75, 2.5, 4.75, 1.0, 10.0]), "b": (1, [7.0] * 5)}


@slow
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-50, 50)), min_size=1, max_size=40))
def test_exact_quantiles_are_those_of_pandas(spark, values):
    df = spark.createDataFrame([(g, float(v)) for g, v in values], "g string, v double")
    points = [0.1, 0.25, 0.5, 0.9]
    frame = pd.DataFrame(values, columns=["g", "v"])
    for r in exact_quantiles(df, "g", "v", points).collect():
        expected = frame[frame.g == r["g"]].v.quantile(points).tolist()
        assert r["quantiles"] == pytest.approx(expected)


def test_quantiles_of_equal_values_are_not_gathered(spark):
    # A third of the rows are equal; they are folded before the sort.
    df = spark.range(30000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v")
    )
    points = [0.0, 0.2, 1 / 3, 0.5, 1.0]
    (got,) = exact_quantiles(df, "g", "v", points).collect()
    expected = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in points]))).first()[0]
    assert got["n"] == 30000 and got["quantiles"] == pytest.approx(expected)


def test_describe_is_that_of_pandas(spark):
    frame = pd.DataFrame({"k": list("abcdef"), "x": [1, 2, 3, 10, None, 4], "y": [5, 5, 5, 5, 5, 7]})
    df = spark.createDataFrame(
        [(k, None if math.isnan(x) else float(x), int(y)) for k, x, y in frame.itertuples(index=False)],
        "k string, x double, y int",
    )
    got = describe(df, ["x", "y"]).toPandas().set_index("statistic")
    expected = frame.describe()
    assert list(got.index) == list(expected.index)
    for column in ("x", "y"):
        assert got[column].tolist() == pytest.approx(expected[column].tolist())


def test_describe_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    got = {r["statistic"]: (r["x"], r["y"]) for r in describe(df, ["x", "y"]).collect()}
    assert got["count"] == (0.0, 1.0) and got["50%"] == (None, 1.0) and got["std"] == (None, None)


def test_box(spark):
    points = [("s%d" % i, 1, float(v)) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 30])]
    df = spark.createDataFrame(points + [("n", 1, None), ("z", 2, 4.0)], "id string, q int, v double")
    box = {r["q"]: r for r in box_stats(df, "q", "v").collect()}
    assert tuple(box[1]) == (1, 8, 2.75, 4.5, 6.25, 1.0, 7.0, 1)
    assert tuple(box[2]) == (2, 1, 4.0, 4.0, 4.0, 4.0, 4.0, 0)
    assert rows(box_outliers(df, "q", "v", "id")) == [("s7", 1, 30.0)]


# Profiles --------------------------------------------------------------------------------------------


@pytest.fixture
def profiled(spark):
    return spark.createDataFrame(
        [(1, "a", None), (2, None, 1.0), (3, "", 2.0), (4, "b", None)], "k int, s string, x double"
    )


def test_null_profile(spark, profiled):
    assert dict(rows(quality.null_profile(profiled))) == {"k": 0.0, "s": 25.0, "x": 50.0}
    assert rows(quality.null_profile(profiled.limit(0))) == []
    assert plan(quality.null_profile(profiled)).count("Exchange") == 1


def test_incomplete_rows_repeat_for_each_column(profiled):
    assert dict(rows(quality.incomplete_row_profile(profiled))) == {"k": 75.0, "s": 75.0, "x": 75.0}
    assert rows(quality.incomplete_row_profile(profiled.limit(0))) == []


def test_column_profile_is_both(profiled):
    both = {r[0]: r[1:] for r in rows(quality.column_profile(profiled))}
    assert both == {"k": (0.0, 75.0), "s": (25.0, 75.0), "x": (50.0, 75.0)}
    assert rows(quality.column_profile(profiled.limit(0))) == []


@slow
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.text(max_size=2))), min_size=1, max_size=20))
def test_null_profile_is_that_of_pandas(spark, values):
    df = spark.createDataFrame(values, "a int, b string")
    frame = pd.DataFrame({"a": pd.array([v[0] for v in values], "Int64"), "b": [v[1] for v in values]})
    assert dict(rows(quality.null_profile(df))) == pytest.approx((frame.isna().mean() * 100).to_dict())


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c``d` string")
    assert dict(rows(quality.null_profile(df))) == {"a.b": 0.0, "c`d": 100.0}
    assert dict(rows(quality.null_profile(cleaning.fill_text(df.withColumnsRenamed({"c`d": "c"}))))) == {"a.b": 0.0, "c": 0.0}


def test_what_is_watched_while_it_is_written_is_what_a_pass_finds(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", None, ts("2018-01-01")), (2, None, 1.0, None), (3, "", 2.0, ts("2017-05-05T01:02:03"))],
        "k int, `s.x` string, x double, at timestamp_ntz",
    ).repartition(3)
    rules = {"x is large": F.col("x") > 1.5, "k is known": F.col("k").isNotNull()}
    for table in (df, df.limit(0)):
        seen, later = quality.Watch(table, dates=["at"], rules=rules), quality.Watch(table.fillna(""))
        seen.on(table).write.mode("overwrite").parquet(str(tmp_path / "out"))
        later.on(table.fillna("")).write.mode("overwrite").parquet(str(tmp_path / "later"))
        for got, want in (
            (seen.column_profile(), quality.column_profile(table)),
            (seen.date_ranges(), quality.date_ranges(table, ["at"])),
            (seen.validation(), quality.validate(table, rules)),
            (seen.null_reduction(later), quality.null_reduction(table, table.fillna(""))),
        ):
            assert sorted(rows(got)) == sorted(rows(want)) and got.dtypes == want.dtypes


def test_all_references_read_each_table_once(spark):
    tables = {
        "items": spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "z")], "o int, p string"),
        "orders": spark.createDataFrame([(1, 7), (1, 8), (3, None), (None, 9)], "o int, c long"),
        "products": spark.createDataFrame([("a",), ("b",), (None,)], "p string"),
        "customers": spark.createDataFrame([], "c long"),
    }
    references = [
        quality.Reference("r1", "items", "orders", "o"),
        quality.Reference("r2", "items", "products", "p"),
        quality.Reference("r3", "orders", "customers", "c"),
    ]
    got = quality.validate_references(tables, references)
    assert sorted(rows(got)) == [("items", "r1", 4, 2, 50.0), ("items", "r2", 4, 2, 50.0), ("orders", "r3", 4, 0, 0.0)]
    none = {name: df.limit(0) for name, df in tables.items()}
    assert rows(quality.validate_references(none, references)) == []


def test_duplicates(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 1), (1, None), (1, None), (None, None), (None, None)], "a int, b int"
    )
    assert rows(quality.duplicate_count(df, ["a", "b"])) == [(3,)]
    assert rows(quality.duplicate_count(df, ["a"])) == [(5,)]
    assert rows(quality.duplicate_count(df.limit(0), ["a"])) == [(0,)]
    with pytest.raises(ValueError):
        quality.duplicate_count(df, [])


def test_unknown_columns_raise(spark, profiled):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        quality.duplicate_count(profiled, ["nope"])
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        quality.date_range(profiled, "nope")


def test_date_range(spark):
    df = spark.createDataFrame([(ts("2017-02-01"),), (None,), (ts("2016-12-31"),)], "d timestamp_ntz")
    assert rows(quality.date_range(df, "d")) == [(ts("2016-12-31"), ts("2017-02-01"))]
    assert rows(quality.date_range(df.limit(0), "d")) == [(None, None)]
    two = df.withColumn("e", F.lit(None).cast("timestamp_ntz"))
    assert rows(quality.date_ranges(two, ["d", "e"])) == [
        ("d", ts("2016-12-31"), ts("2017-02-01")), ("e", None, None),
    ]


def test_null_reduction(profiled):
    got = {r[0]: r[1:] for r in rows(quality.null_reduction(profiled, cleaning.fill_text(profiled)))}
    assert got == {"k": (0.0, 0.0), "s": (25.0, 0.0), "x": (50.0, 50.0)}


def test_null_reduction_is_measured(spark):
    from mercatura.sources.csv_files import clean_table

    text = spark.createDataFrame([("a", "2017-01-01"), (None, None)], "k string, order_date string")
    got = {r[0]: r[1:] for r in rows(quality.null_reduction(text, clean_table(text)))}
    # The blank date is filled, then NULL again.
    assert got == {"k": (50.0, 0.0), "order_date": (50.0, 50.0)}
    gone = rows(quality.null_reduction(text, text.drop("k")).where("column_name = 'k'"))
    assert gone == [("k", 50.0, None)]


def test_rules(profiled):
    got = rows(quality.validate(profiled, {"x above 1": F.col("x") > 1, "k": F.col("k") < 4}))
    assert got == [("x above 1", 4, 1, 25.0), ("k", 4, 3, 75.0)]
    assert rows(quality.validate(profiled.limit(0), {"k": F.col("k") < 4})) == []


def test_references(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(quality.validate_reference(child, parent, "k", "known")) == [("known", 4, 2, 50.0)]
    assert rows(quality.validate_reference(child.limit(0), parent, "k", "known")) == []


def test_review_stats(spark):
    reviews = spark.createDataFrame([("a", 5), ("a", None), ("b", None)], "order_id string, review_score int")
    assert sorted(rows(review_stats(reviews))) == [("a", 2, Decimal(5), 1), ("b", 1, None, 0)]


# Cleaning ----------------------------------------------------------------------------------------------


def test_fill_text(profiled):
    filled = cleaning.fill_text(profiled)
    assert rows(filled) == [(1, "a", None), (2, "", 1.0), (3, "", 2.0), (4, "b", None)]
    assert rows(cleaning.fill_text(filled)) == rows(filled)


def test_date_columns_are_chosen_by_name(spark):
    df = spark.createDataFrame([], "Order_DATE string, updated int, ship_TimeStamp string, x string")
    assert cleaning.date_columns(df) == ["Order_DATE", "updated", "ship_TimeStamp"]


def test_dates_parse_wholly_or_not_at_all(spark):
    df = spark.createDataFrame(
        [("2017-10-02 10:56:33", "2017-01-01", "02/10/2017"), ("", "soon", None), (None, "", "")],
        "a_date string, b_date string, c_date string",
    )
    got = cleaning.parse_dates(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["timestamp_ntz", "string", "string"]
    assert rows(got) == [
        (ts("2017-10-02T10:56:33"), "2017-01-01", "02/10/2017"),
        (None, "soon", None),
        (None, "", ""),
    ]
    other = cleaning.parse_dates(df, ["c_date"], formats=["dd/MM/yyyy"])
    assert [r[2] for r in rows(other)] == [ts("2017-10-02"), None, None]


def test_all_date_columns_are_checked_in_one_pass(spark, monkeypatch):
    df = spark.createDataFrame([("2017-01-01", "x")], "a_date string, b_date string")
    passes = []
    whole = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: passes.append(1) or whole(self, *a))
    cleaning.parse_dates(df)
    assert len(passes) == 1


def test_bad_values_can_raise(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert cleaning.cast_if_clean(df, {"n": T.IntegerType()}).schema["n"].dataType == T.StringType()
    with pytest.raises(ValueError, match="'n': 1"):
        cleaning.cast_if_clean(df, {"n": T.IntegerType()}, on_bad="error")
    with pytest.raises(ValueError):
        cleaning.cast_if_clean(df, {}, on_bad="drop")


def test_decimals_keep_their_digits(spark):
    from pyspark.sql import types as T

    price = {"price": T.DecimalType(12, 2)}
    fine = spark.createDataFrame([("12.345",), ("0.004",), ("1.00005",), ("7",), ("1.50",), ("",)], "price string")
    got = cleaning.cast_if_clean(fine, price)
    assert got.schema["price"].dataType == T.DecimalType(15, 5)
    assert [r[0] for r in rows(got)] == [
        Decimal(x) for x in ("12.34500", "0.00400", "1.00005", "7.00000", "1.50000")
    ] + [None]
    plain = spark.createDataFrame([("12.30000",), ("1",)], "price string")
    assert cleaning.cast_if_clean(plain, price).schema["price"].dataType == T.DecimalType(12, 2)
    for value in ("0.0000001", "1e-3", "99999999999999"):
        odd = spark.createDataFrame([(value,), ("1.00",)], "price string")
        assert cleaning.cast_if_clean(odd, price).schema["price"].dataType == T.StringType()


def test_doubles_are_summed_exactly_or_raise(spark):
    from mercatura.functions import exact

    small = spark.range(1000).select(F.lit(0.00004).alias("v"))
    assert rows(small.agg(F.sum(exact(small, "v")))) == [(Decimal("0.040000"),)]
    for value in (0.0000001, 1e13, float("nan")):
        df = spark.createDataFrame([(value,)], "v double")
        with pytest.raises(Exception, match="v does not fit"):
            df.agg(F.sum(exact(df, "v"))).collect()
    assert rows(spark.createDataFrame([(None,)], "v double").select(exact(spark.createDataFrame([], "v double"), "v"))) == [(None,)]


def test_numbers_are_inferred(spark):
    df = spark.createDataFrame(
        [("1", "1", "01409", "1.5", "1e3", "x", None, "1d", "99999999999999999999"),
         (None, "2.5", "2", ".5", "-2.", "1", None, "2", "1")],
        "a string, b string, c string, d string, e string, f string, g string, h string, i string",
    )
    got = cleaning.infer_numbers(df)
    types = [f.dataType.simpleString() for f in got.schema]
    assert types == ["bigint", "double", "string", "double", "double", "string", "string", "string", "double"]
    assert rows(got.select("a", "b", "d", "e")) == [(1, 1.0, 1.5, 1000.0), (None, 2.5, 0.5, -2.0)]


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), (" NA",), ("",), ("NAN",), ("nan",)], "s string")
    assert [r[0] for r in rows(cleaning.null_tokens(df))] == [None, None, " NA", None, "NAN", None]
    assert [r[0] for r in rows(cleaning.null_tokens(df, ["NAN"]))][4] is None


def test_dedupe_keeps_the_smallest(spark):
    df = spark.createDataFrame(
        [(1, "b", 1.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0), (2, "z", 0.0), (None, "q", 1.0), (None, "q", 1.0)],
        "k int, s string, x double",
    )
    assert sorted(rows(cleaning.dedupe(df, ["k"], ["s"])), key=str) == [
        (1, "a", 3.0), (2, None, 1.0), (None, "q", 1.0),
    ]
    assert sorted(rows(cleaning.dedupe(df, ["k"], ["x"])), key=str) == [
        (1, "b", 1.0), (2, "z", 0.0), (None, "q", 1.0),
    ]
    assert cleaning.dedupe(df, ["k", "s", "x"]).count() == 6
    assert "partial_min" in plan(cleaning.dedupe(df, ["k"])) and "Window" not in plan(cleaning.dedupe(df, ["k"]))
