"""Summary statistics and the numbers behind a box plot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.operators.quantiles import exact_quantiles, grouped_quantiles
from mercatura.session import checkpointed

STATISTICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics as rows (``statistic``), described columns as columns.

    Standard deviation is the sample one; quartiles are exact, interpolated linearly. The values
    are stored once; the moments come from the first pass over them that the quartiles take. An empty
    table gives no rows.
    """
    named = {c: f"_c{i}" for i, c in enumerate(columns)}
    values = checkpointed(
        df.select(F.lit(0).alias("_all"), *[F.col(c).cast("double").alias(n) for c, n in named.items()])
    )
    moments = [
        m.alias(f"{name}{n}")
        for n in named.values()
        for name, m in (("mean", F.avg(n)), ("std", F.stddev_samp(n)), ("min", F.min(n)), ("max", F.max(n)))
    ]
    found = grouped_quantiles(values, "_all", list(named.values()), QUARTILES, *moments)

    def cells(i: int, n: str) -> list[Column]:
        quartiles = [F.col(f"quantiles_{i}")[j] for j in range(len(QUARTILES))]
        return [F.col(f"n_{i}").cast("double"), *[F.col(m + n) for m in ("mean", "std", "min")], *quartiles, F.col("max" + n)]

    table = [cells(i, n) for i, n in enumerate(named.values())]
    lines = [
        F.struct(F.lit(s).alias("statistic"), *[own[at].alias(n) for own, n in zip(table, named.values(), strict=True)])
        for at, s in enumerate(STATISTICS)
    ]
    turned = found.select(F.inline(F.array(*lines)))
    return turned.withColumnsRenamed({n: c for c, n in named.items()})


def _with_fences(df: DataFrame, group: str, value: str, keep: Sequence[str]) -> DataFrame:
    """Rows with a value, each with its group's quartiles and the fences 1.5 IQR beyond them."""
    known = checkpointed(df.where(F.col(value).isNotNull()).select(*keep, group, value))
    placed = known.join(exact_quantiles(known, group, value, QUARTILES), group)
    q1, median, q3 = (F.col("quantiles")[i] for i in range(len(QUARTILES)))
    reach = (q3 - q1) * 1.5
    return placed.select(
        *keep,
        group,
        value,
        "n",
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        F.col(value).between(q1 - reach, q3 + reach).alias("inside"),
    )


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers (last points inside 1.5 IQR) and outlier count per group.

    NULL values are dropped. The groups must be few, as in a chart.
    """
    placed = _with_fences(df, group, value, [])
    inside = F.col("inside")
    return placed.groupBy(group, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(df: DataFrame, group: str, value: str, key: str) -> DataFrame:
    """The rows a box plot draws as single points."""
    placed = _with_fences(df, group, value, [key])
    return placed.where(~F.col("inside")).select(key, group, value)
