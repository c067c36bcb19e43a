"""Fixtures of the corpus tests; the session is that of the other tests."""

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark):
    """A table from rows, whatever they are."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def store(spark, tmp_path):
    """Write tables as a data folder; those not given are taken from the smallest sample."""

    def write(**tables):
        for name in ("documents", "pages", "benchmark", "labels"):
            df = tables.get(name)
            if df is None:
                df = spark.read.parquet(f"{SMALL}/{name}.parquet")
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
