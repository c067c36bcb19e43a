"""Exact quantiles with linear interpolation, per group, without a sort of the values."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Estimates are off by one in so many rows at most; the search takes in four times as much.
ACCURACY = 10_000
_MARGIN = 4 / ACCURACY
# So few values are all between: the margin is less than a row or two.
_FEW = ACCURACY


def grouped_quantiles(
    df: DataFrame, group: str, values: Sequence[str], probabilities: Sequence[float], *also: Column
) -> DataFrame:
    """One row per group, with ``n_<i>`` and ``quantiles_<i>`` for value ``i`` and what else is asked for.

    Three passes, whatever the number of values: the first estimates, with a sketch, two values that
    each quantile lies between; the second counts exactly how many are below them; the third takes
    the values between, folds equal ones to counts and picks those at the positions. Only they are
    sorted, about one in a thousand. NULL values are left out; a group without any has NULL quantiles.

    ``df`` is read three times, when this is called. The groups must be few, as a few numbers of each
    pass through the driver; the values may be any number, and any share of them may be equal.
    """
    spark, points = df.sparkSession, [float(p) for p in probabilities]
    columns = [f"_v{i}" for i in range(len(values))]
    rows = df.withColumns({c: F.col(v).cast("double") for c, v in zip(columns, values, strict=True)})
    edges = [e for p in points for e in (max(0.0, p - _MARGIN), min(1.0, p + _MARGIN))]
    estimates = [F.percentile_approx(c, edges, ACCURACY).alias(f"_e{i}") for i, c in enumerate(columns)]
    counts = [F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    first = rows.groupBy(F.col(group).alias("_group")).agg(*counts, *also, *estimates)
    about = first.collect()

    # Number k of a quantile: of value k // len(points). NaN is the greatest of all numbers here.
    wanted = range(len(columns) * len(points))
    lows, highs = [], []
    for r in about:
        ends = [
            (float("-inf"), float("nan")) if r[f"n_{i}"] < _FEW else r[f"_e{i}"][2 * j : 2 * j + 2]
            for i in range(len(columns))
            for j in range(len(points))
        ]
        lows.append([float(low) for low, _ in ends])
        highs.append([float(high) for _, high in ends])
    kind = first.schema["_group"]
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([kind, T.StructField("_low", doubles), T.StructField("_high", doubles)])
    # One row per group.
    bounds = F.broadcast(spark.createDataFrame([(r["_group"], a, b) for r, a, b in zip(about, lows, highs, strict=True)], schema))
    placed = rows.select(F.col(group).alias("_of"), *columns).join(bounds, F.col("_of").eqNullSafe(F.col("_group")))

    def value(k: int) -> Column:
        return F.col(columns[k // len(points)])

    below = F.array(*[F.count_if(value(k) < F.col("_low")[k]) for k in wanted])
    under = {r[0]: r[1] for r in placed.groupBy("_group").agg(below).collect()}

    # The ranks next to each quantile, counted from the lower estimate.
    near_by, between = [], []
    for r in about:
        for k in wanted:
            n = r[f"n_{k // len(points)}"]
            at = points[k % len(points)] * (n - 1)
            if n:
                near_by.append((r["_group"], k, floor(at) - under[r["_group"]][k], ceil(at) - under[r["_group"]][k], at - floor(at)))
    for k in wanted:
        inside = (value(k) >= F.col("_low")[k]) & (value(k) <= F.col("_high")[k])
        between.append(F.when(inside, F.struct(F.lit(k).alias("k"), value(k).alias("value"))))
    found = placed.select("_group", F.inline(F.array_compact(F.array(*between))))
    folded = found.groupBy("_group", "k", "value").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_group", "k").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    summed = folded.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    numbers = [T.StructField(c, T.LongType()) for c in ("_k", "_floor", "_ceil")]
    ranks = T.StructType([T.StructField("_of", kind.dataType), *numbers, T.StructField("_part", T.DoubleType())])
    asked = F.broadcast(spark.createDataFrame(near_by, ranks))
    joined = summed.join(asked, F.col("_group").eqNullSafe(F.col("_of")) & (F.col("k") == F.col("_k")))

    def at(rank: str) -> Column:
        holds = (F.col(rank) >= F.col("_before")) & (F.col(rank) < F.col("_before") + F.col("_rows"))
        return F.max(F.when(holds, F.col("value")))

    picked = joined.groupBy("_group", "k", "_part").agg(at("_floor"), at("_ceil")).collect()
    quantile: dict[tuple, float] = {}
    for of, k, part, low, high in picked:
        if low is None or high is None:
            raise ArithmeticError("an estimate was off by more than it may be")
        quantile[of, k] = low if low == high else low + (high - low) * part

    def of(r: Row, i: int) -> list[float] | None:
        own = range(i * len(points), (i + 1) * len(points))
        return [quantile[r["_group"], k] for k in own] if r[f"n_{i}"] else None

    kept = [f for f in first.schema.fields if not f.name.startswith("_e")]
    arrays = [T.StructField(f"quantiles_{i}", doubles) for i in range(len(columns))]
    lines = [(*[r[f.name] for f in kept], *[of(r, i) for i in range(len(columns))]) for r in about]
    return spark.createDataFrame(lines, T.StructType([*kept, *arrays])).withColumnRenamed("_group", group)


def exact_quantiles(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float]
) -> DataFrame:
    """One row per group with a value: ``group``, ``n`` and ``quantiles``, an array in the order asked for."""
    found = grouped_quantiles(df.select(group, value), group, [value], probabilities)
    return found.where("n_0 > 0").select(group, F.col("n_0").alias("n"), F.col("quantiles_0").alias("quantiles"))
