"""Cleaning steps: text fill, date parsing, typing of text columns, duplicate removal."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.functions.exact import PLACES
from mercatura.schema import NA_TOKENS

log = logging.getLogger(__name__)

# A column is taken for a date if its name holds one of these.
DATE_NAME_PARTS = ("date", "timestamp")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Replace missing-value tokens in text columns by NULL. Exact match, no trimming."""
    return df.withColumns(
        {c: F.when(~_quoted(c).isin(list(tokens)), _quoted(c)) for c in text_columns(df)}
    )


def fill_text(df: DataFrame, value: str = "") -> DataFrame:
    """Replace NULL in every text column."""
    return df.fillna(value, subset=text_columns(df))


def date_columns(df: DataFrame) -> list[str]:
    """Columns whose name marks them as dates."""
    return [c for c in df.columns if any(part in c.lower() for part in DATE_NAME_PARTS)]


def _places(name: str) -> Column:
    """Digits after the point that are not trailing zeros."""
    return F.length(F.regexp_extract(_quoted(name), r"^\s*[+-]?\d*\.(\d*?)0*\s*$", 1))


def _with_places(dtype: T.DecimalType, places: int) -> T.DecimalType:
    more = max(places - dtype.scale, 0)
    return T.DecimalType(dtype.precision + more, dtype.scale + more)


def _widest(dtype: T.DataType) -> T.DataType:
    return _with_places(dtype, PLACES) if isinstance(dtype, T.DecimalType) else dtype


def _parsed(name: str, dtype: T.DataType, formats: Sequence[str]) -> Column:
    if isinstance(dtype, T.DecimalType):
        # The cast would round: more places than there are make a value that does not parse.
        plain = _quoted(name).rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$")
        return F.when(plain & (_places(name) <= dtype.scale), _quoted(name).try_cast(dtype))
    tries = [_quoted(name).try_cast(dtype)]
    if isinstance(dtype, T.TimestampNTZType):
        tries += [F.try_to_timestamp(_quoted(name), F.lit(f)).cast(dtype) for f in formats]
    return F.coalesce(*tries)


def cast_if_clean(
    df: DataFrame,
    targets: Mapping[str, T.DataType],
    *,
    formats: Sequence[str] = (),
    on_bad: str = "keep",
) -> DataFrame:
    """Cast text columns, each one wholly or not at all.

    Blank text becomes NULL. One pass counts the values that do not parse, for all columns
    together; a column with any is kept as text (``on_bad="keep"``) or raises ("error"). A
    decimal column whose values have more places than its type gets as many as they need, up to
    ``PLACES``; a value with even more does not parse.
    """
    if on_bad not in ("keep", "error"):
        raise ValueError("on_bad must be 'keep' or 'error'")
    text = set(text_columns(df))
    todo = {c: t for c, t in targets.items() if c in text and not isinstance(t, T.StringType)}
    if not todo:
        return df
    parsed = {c: _parsed(c, _widest(t), formats) for c, t in todo.items()}
    decimals = [c for c, t in todo.items() if isinstance(t, T.DecimalType)]
    found = df.agg(
        *[
            F.count_if((F.trim(_quoted(c)) != "") & p.isNull()).alias(f"bad_{i}")
            for i, (c, p) in enumerate(parsed.items())
        ],
        *[F.max(_places(c)).alias(f"places_{i}") for i, c in enumerate(decimals)],
    ).first()
    failed = {c: found[f"bad_{i}"] for i, c in enumerate(parsed) if found[f"bad_{i}"]}
    for i, c in enumerate(decimals):
        if c not in failed:
            parsed[c] = parsed[c].cast(_with_places(todo[c], found[f"places_{i}"] or 0))
    if failed and on_bad == "error":
        raise ValueError(f"values that do not parse, per column: {failed}")
    for column, count in failed.items():
        log.warning("column %s stays text: %d values do not parse", column, count)
    return df.withColumns({c: p for c, p in parsed.items() if c not in failed})


def parse_dates(
    df: DataFrame, columns: Sequence[str] | None = None, formats: Sequence[str] = ()
) -> DataFrame:
    """Turn text date columns into timestamps, picked by name unless given."""
    names = date_columns(df) if columns is None else list(columns)
    return cast_if_clean(df, {c: T.TimestampNTZType() for c in names}, formats=formats)


def infer_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type text columns as long or double where every value allows it, in one pass.

    A value with a leading zero ("01409") is taken for a code and keeps its column text.
    """
    names = text_columns(df) if columns is None else list(columns)
    if not names:
        return df
    checks = []
    for i, c in enumerate(names):
        present = F.trim(_quoted(c)) != ""
        code = _quoted(c).rlike(r"^\s*[+-]?0\d")
        whole = _quoted(c).rlike(r"^\s*[+-]?\d+\s*$") & _quoted(c).try_cast("bigint").isNotNull()
        number = _quoted(c).rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
        checks += [
            F.count_if(present).alias(f"present_{i}"),
            F.count_if(present & (code | ~whole)).alias(f"not_whole_{i}"),
            F.count_if(present & (code | ~number)).alias(f"not_number_{i}"),
        ]
    found = df.agg(*checks).first()
    casts = {}
    for i, c in enumerate(names):
        if not found[f"present_{i}"]:
            continue
        if not found[f"not_whole_{i}"]:
            casts[c] = _quoted(c).try_cast("bigint")
        elif not found[f"not_number_{i}"]:
            casts[c] = _quoted(c).try_cast("double")
    return df.withColumns(casts) if casts else df


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the smallest by ``prefer``, then by the remaining columns.

    The keeper is a minimum, so copies are dropped before the shuffle and a key with very
    many copies is never gathered in one task. NULL sorts first; NULL keys form a group.
    """
    first = [c for c in prefer if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    ranked = first + rest
    if not ranked:
        return df.dropDuplicates(list(keys))
    kept = df.groupBy(*[_quoted(k) for k in keys]).agg(
        F.min(F.struct(*[_quoted(c) for c in ranked])).alias("_kept")
    )
    return kept.select(
        *[
            _quoted(c) if c in keys else F.col("_kept")[c].alias(c)
            for c in df.columns
        ]
    )
