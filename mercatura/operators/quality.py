"""Profiles and checks. Each one reads its table once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.functions import percent


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _as_rows(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct; an empty input gives no rows."""
    return one_row.where(F.col("_rows") > 0).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame) -> DataFrame:
    """Percentage of NULLs in each column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(_quoted(c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    return _as_rows(
        counts,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                percent(F.col("_rows") - F.col(f"_{i}"), F.col("_rows")).alias("null_percentage"),
            )
            for i, c in enumerate(df.columns)
        ],
    )


def incomplete_row_profile(df: DataFrame) -> DataFrame:
    """Percentage of rows with at least one NULL, repeated for every column."""
    complete = reduce(Column.__and__, [_quoted(c).isNotNull() for c in df.columns])
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), F.count(F.when(complete, 1)).alias("_complete")
    )
    share = percent(F.col("_rows") - F.col("_complete"), F.col("_rows"))
    return _as_rows(
        counts,
        [
            F.struct(F.lit(c).alias("column_name"), share.alias("null_percentage"))
            for c in df.columns
        ],
    )


def _profile_counts(columns: Sequence[str]) -> list[Column]:
    complete = reduce(Column.__and__, [_quoted(c).isNotNull() for c in columns])
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count(F.when(complete, 1)).alias("_complete"),
        *[F.count(_quoted(c)).alias(f"_{i}") for i, c in enumerate(columns)],
    ]


def _profile(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = F.col("_rows")
    return _as_rows(
        counts,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                percent(rows - F.col(f"_{i}"), rows).alias("null_percentage"),
                percent(rows - F.col("_complete"), rows).alias("incomplete_row_percentage"),
            )
            for i, c in enumerate(columns)
        ],
    )


def column_profile(df: DataFrame) -> DataFrame:
    """``null_profile`` and ``incomplete_row_profile`` side by side, in one pass."""
    return _profile(df.agg(*_profile_counts(df.columns)), df.columns)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, as the one-row column ``duplicate_count``.

    Several keys count as one row value, so a combination that holds NULLs counts like any
    other. A single key is a plain value: its NULLs are not counted as distinct.
    """
    if not keys:
        raise ValueError("at least one key column is needed")
    key = _quoted(keys[0]) if len(keys) == 1 else F.struct(*[_quoted(k) for k in keys])
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_count"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column, as one row."""
    return df.agg(
        F.min(_quoted(column)).alias("min_date"), F.max(_quoted(column)).alias("max_date")
    )


def _range_ends(columns: Sequence[str]) -> list[Column]:
    return [
        *[F.min(_quoted(c)).alias(f"_min_{i}") for i, c in enumerate(columns)],
        *[F.max(_quoted(c)).alias(f"_max_{i}") for i, c in enumerate(columns)],
    ]


def _ranges(ends: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _as_rows(
        ends,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_min_{i}").alias("min_date"),
                F.col(f"_max_{i}").alias("max_date"),
            )
            for i, c in enumerate(columns)
        ],
    )


def date_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``date_range`` of several columns of one type, as rows, in one pass."""
    return _ranges(df.agg(F.count(F.lit(1)).alias("_rows"), *_range_ends(columns)), columns)


def null_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Null percentage of each column of ``before`` there and in ``after``, the table that
    cleaning made of it. A column that is gone has NULL after. One pass over each table."""
    return _reduction(null_profile(before), null_profile(after))


def _reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    now = before.select("column_name", F.col("null_percentage").alias("null_percentage_before"))
    then = after.select("column_name", F.col("null_percentage").alias("null_percentage_after"))
    # One row per column on both sides.
    return now.join(then, "column_name", "left")


def _rule_counts(rules: Mapping[str, Column]) -> list[Column]:
    return [F.count_if(F.coalesce(r, F.lit(False))).alias(f"_rule_{i}") for i, r in enumerate(rules.values())]


def _rates(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    return _as_rows(
        counts,
        [
            F.struct(
                F.lit(name).alias("rule"),
                F.col("_rows").alias("checked_rows"),
                F.col(f"_rule_{i}").alias("passed_rows"),
                percent(F.col(f"_rule_{i}"), F.col("_rows")).alias("pass_rate"),
            )
            for i, name in enumerate(names)
        ],
    )


def validate(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Pass rate of each rule. A rule that comes out NULL has not been met."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *_rule_counts(rules))
    return _rates(counts, list(rules))


@dataclass(frozen=True)
class Reference:
    """The rule that a key of ``child`` exists in ``parent``."""

    rule: str
    child: str
    parent: str
    key: str


def validate_references(tables: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    """``table_name`` of the child, and the share of its rows whose key exists in the parent.

    Each table is read once as a child and once as a parent, whatever the number of references. Child
    rows are counted per reference and key before the join, so a hot key is one row in it.
    """

    def keys(name: str, numbered: Sequence[tuple[int, str, T.DataType]]) -> DataFrame:
        parts = [
            F.struct(F.lit(i).alias("_no"), _quoted(key).cast(kind).cast("string").alias("_key"))
            for i, key, kind in numbered
        ]
        return tables[name].select(F.inline(F.array(*parts)))

    kinds = [tables[r.child].schema[r.key].dataType for r in references]
    sides = []
    for side in ("child", "parent"):
        named: dict[str, list] = {}
        for i, r in enumerate(references):
            named.setdefault(getattr(r, side), []).append((i, r.key, kinds[i]))
        sides.append(reduce(DataFrame.unionByName, [keys(name, own) for name, own in named.items()]))
    children, parents = sides
    per_key = children.groupBy("_no", "_key").agg(F.count(F.lit(1)).alias("_n"))
    known = parents.where(F.col("_key").isNotNull()).distinct().withColumn("_known", F.lit(True))
    counted = (
        per_key.join(known, ["_no", "_key"], "left")
        .groupBy("_no")
        .agg(F.sum("_n").alias("checked_rows"), F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0)).alias("passed_rows"))
    )
    named = [F.struct(F.lit(r.child).alias("table_name"), F.lit(r.rule).alias("rule")) for r in references]
    return counted.select(
        F.array(*named)[F.col("_no")].alias("_named"),
        "checked_rows",
        "passed_rows",
        percent(F.col("passed_rows"), F.col("checked_rows")).alias("pass_rate"),
    ).select("_named.*", "checked_rows", "passed_rows", "pass_rate")


def validate_reference(child: DataFrame, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Share of child rows whose key exists in the parent."""
    tables = {"child": child, "parent": parent}
    return validate_references(tables, [Reference(rule, "child", "parent", key)]).drop("table_name")


# Counts of a pass that goes on anyway ---------------------------------------------------------------


class Watch:
    """Profiles of a table that come from the job that writes it.

    ``on(df)`` is the frame to write; the other methods wait for its write. Nothing may deal the rows out
    anew between the two: a lost task of a shuffle would be counted again with its repetition.
    """

    def __init__(
        self, df: DataFrame, *, dates: Sequence[str] = (), rules: Mapping[str, Column] | None = None
    ) -> None:
        self._columns, self._dates, self._rules = list(df.columns), list(dates), dict(rules or {})
        counts = [*_profile_counts(self._columns), *_range_ends(self._dates), *_rule_counts(self._rules)]
        self._schema, self._spark = df.agg(*counts).schema, df.sparkSession
        # Dates reach the driver as text.
        self._counts = [
            c if isinstance(f.dataType, T.LongType) else c.cast("string").alias(f.name)
            for c, f in zip(counts, self._schema.fields, strict=True)
        ]
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *self._counts)

    def _found(self) -> DataFrame:
        seen, fields = self._seen.get, self._schema.fields
        told = T.StructType(
            [T.StructField(f.name, f.dataType if isinstance(f.dataType, T.LongType) else T.StringType()) for f in fields]
        )
        one = self._spark.createDataFrame([tuple(seen[f.name] for f in fields)], told)
        return one.select(*[F.col(f.name).cast(f.dataType) for f in fields])

    def column_profile(self) -> DataFrame:
        return _profile(self._found(), self._columns)

    def date_ranges(self) -> DataFrame:
        return _ranges(self._found(), self._dates)

    def validation(self) -> DataFrame:
        return _rates(self._found(), list(self._rules))

    def null_reduction(self, after: Watch) -> DataFrame:
        """From this table to the one that cleaning made of it."""
        return _reduction(self.column_profile(), after.column_profile())
