"""CSV input: quoting, missing-value tokens, typing, and the cleaning load."""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.operators.cleaning import (
    cast_if_clean,
    date_columns,
    fill_text,
    infer_numbers,
    null_tokens,
    parse_dates,
    text_columns,
)
from mercatura.schema import NA_TOKENS

log = logging.getLogger(__name__)


class EmptyCsvError(ValueError):
    """The file holds no header."""


def read_text_csv(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Read a CSV with a header; every column is text.

    Doubled quotes are one quote. A quoted line break needs ``multi_line``, which makes each
    file one task; leave it off for files without free text so that they split. A row of the
    wrong length raises when it is read, and so does a file of a folder whose header differs.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if not df.columns:
        raise EmptyCsvError(f"no header in {path}")
    return df


def read_plain(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    multi_line: bool = False,
    na_tokens: Sequence[str] = NA_TOKENS,
    infer: bool = False,
) -> DataFrame:
    """CSV with missing-value tokens as NULL and the schema's columns typed.

    Date columns stay text here, whatever the schema says; ``read_clean`` parses them.
    Columns outside the schema stay text unless ``infer`` is set.
    """
    text = read_text(spark, path, multi_line=multi_line, na_tokens=na_tokens)
    return typed(text, schema, infer=infer)


def read_text(
    spark: SparkSession,
    path: str,
    *,
    multi_line: bool = False,
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """CSV with missing-value tokens as NULL, all columns text."""
    return null_tokens(read_text_csv(spark, path, multi_line=multi_line), na_tokens)


def typed(text: DataFrame, schema: T.StructType | None = None, *, infer: bool = False) -> DataFrame:
    """Text columns typed as ``read_plain`` says. Reads the table once to see what parses."""
    df = text
    known = {} if schema is None else {f.name: f.dataType for f in schema.fields}
    dates = set(date_columns(df))
    df = cast_if_clean(df, {c: t for c, t in known.items() if c in df.columns and c not in dates})
    if infer:
        df = infer_numbers(df, [c for c in text_columns(df) if c not in known and c not in dates])
    return df


def read_clean(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    multi_line: bool = False,
    na_tokens: Sequence[str] = NA_TOKENS,
    infer: bool = False,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """``read_plain``, then text NULLs filled with ``''``, then date columns parsed."""
    plain = read_plain(
        spark,
        path,
        schema,
        multi_line=multi_line,
        na_tokens=na_tokens,
        infer=infer,
    )
    return clean_table(plain, date_formats)


def clean_table(df: DataFrame, date_formats: Sequence[str] = ()) -> DataFrame:
    """Fill text NULLs with ``''``, then parse the date columns; blank dates end up NULL."""
    return parse_dates(fill_text(df), formats=date_formats)


def read_or_skip(read, spark: SparkSession, path: str, on_missing: str = "error", **options):
    """Call a reader; with ``on_missing="skip"`` a missing or empty file is logged and gives None."""
    if on_missing not in ("skip", "error"):
        raise ValueError("on_missing must be 'skip' or 'error'")
    try:
        return read(spark, path, **options)
    except EmptyCsvError:
        if on_missing == "error":
            raise
        log.error("empty CSV file: %s", path)
    except AnalysisException as error:
        if on_missing == "error" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.error("file not found: %s", path)
    return None


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header and doubled quotes, so that ``read_text_csv`` reads it back."""
    plain = df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (T.TimestampNTZType, T.DecimalType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    plain.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def load_files(
    spark: SparkSession,
    files: Mapping[str, str],
    *,
    on_missing: str = "error",
    multi_line: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Read a map of table name to path as text. Skipped files are absent from the result.

    Only the tables named in ``multi_line`` may hold quoted line breaks.
    """
    loaded = {}
    for name, path in files.items():
        df = read_or_skip(read_text, spark, path, on_missing, multi_line=name in multi_line)
        if df is not None:
            loaded[name] = df
    return loaded
