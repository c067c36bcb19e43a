"""Catalog tables and parquet folders as inputs and outputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from mercatura.schema import Tables

OPTIONAL_TABLES = frozenset({"category_translation", "order_payments"})


def qualified(name: str, database: str | None) -> str:
    return name if database is None else f"{database}.{name}"


def replace_table(df: DataFrame, name: str, database: str | None = None) -> None:
    """Write a catalog table, replacing it if it is there."""
    df.write.mode("overwrite").format("parquet").saveAsTable(qualified(name, database))


def table_or_none(spark: SparkSession, name: str, database: str | None = None) -> DataFrame | None:
    """The table, or None if the catalog does not know it."""
    full = qualified(name, database)
    return spark.table(full) if spark.catalog.tableExists(full) else None


def catalog_tables(spark: SparkSession, database: str | None = None) -> Tables:
    """All input tables from one database. Only the optional ones may be absent."""
    found = {f.name: table_or_none(spark, f.name, database) for f in fields(Tables)}
    return bundle(found)


def bundle(found: Mapping[str, DataFrame | None]) -> Tables:
    present = {name: df for name, df in found.items() if df is not None}
    names = {f.name for f in fields(Tables)}
    missing = names - OPTIONAL_TABLES - present.keys()
    if missing:
        raise ValueError(f"missing tables: {', '.join(sorted(missing))}")
    return Tables(**{name: df for name, df in present.items() if name in names})


def replace_folder(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


def folder_tables(spark: SparkSession, folder: str) -> Tables:
    """Tables stored as ``<folder>/<name>`` in parquet."""
    from mercatura.sources.csv_files import read_or_skip

    def read(session: SparkSession, path: str) -> DataFrame:
        return session.read.parquet(path)

    found = {
        f.name: read_or_skip(
            read,
            spark,
            f"{folder.rstrip('/')}/{f.name}",
            "skip" if f.name in OPTIONAL_TABLES else "error",
        )
        for f in fields(Tables)
    }
    return bundle(found)
