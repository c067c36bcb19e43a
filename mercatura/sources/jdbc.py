"""JDBC input and output. Only options are built here; the driver jar is the user's."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """A table behind JDBC. With ``partition_column`` the read is split between tasks."""

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    partition_column: str | None = None
    lower_bound: str | int | None = None
    upper_bound: str | int | None = None
    partitions: int | None = None
    batch_rows: int = 10_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def _common(self) -> dict[str, str]:
        if not self.url.startswith("jdbc:"):
            raise ValueError("a JDBC URL starts with 'jdbc:'")
        options = {"url": self.url, "dbtable": self.table, "driver": self.driver}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return {**options, **self.extra}

    def read_options(self) -> dict[str, str]:
        options = self._common() | {"fetchsize": str(self.batch_rows)}
        bounds = {
            "partitionColumn": self.partition_column,
            "lowerBound": self.lower_bound,
            "upperBound": self.upper_bound,
            "numPartitions": self.partitions,
        }
        if self.partition_column is not None:
            missing = [name for name, value in bounds.items() if value is None]
            if missing:
                raise ValueError(f"a split read also needs {', '.join(missing)}")
            options |= {name: str(value) for name, value in bounds.items()}
        return options

    def write_options(self) -> dict[str, str]:
        options = self._common() | {"batchsize": str(self.batch_rows)}
        if self.partitions is not None:
            options["numPartitions"] = str(self.partitions)
        return options


def read_jdbc(spark: SparkSession, source: JdbcTable) -> DataFrame:
    return spark.read.format("jdbc").options(**source.read_options()).load()


def write_jdbc(df: DataFrame, target: JdbcTable) -> None:
    df.write.format("jdbc").mode("overwrite").options(**target.write_options()).save()
