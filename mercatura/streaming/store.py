"""Folds of stream batches, merged in levels.

Each batch writes its fold to a folder of its own, ``level=0/block=<batch>``. When ``FAN_IN`` blocks of a level
are full, they are merged into one block of the next: block ``n`` of level ``k`` covers the batches from
``n * FAN_IN ** k``. So a store holds a few blocks for each level, and a row is written once for each.

A block counts once its marker is there, which is written last. A reader takes the highest blocks that
have one, and of lower levels only what those do not cover. So a merge that is cut off counts for nothing,
a merge that is repeated finds its marker, and a batch that is repeated replaces its own folder or is
covered already. Merged blocks go one merge later, when readers that still had them are done.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FAN_IN = 8
MARKER = "_FOLDED"

Fold = Callable[[DataFrame], DataFrame]


class FoldStore:
    """``merge`` adds up rows of several folds; its result has their ``schema``."""

    def __init__(
        self, spark: SparkSession, folder: str, schema: T.StructType, merge: Fold, fan_in: int = FAN_IN
    ) -> None:
        if fan_in < 2:
            raise ValueError("a merge takes two blocks at least")
        self._spark, self._folder, self._schema = spark, folder.rstrip("/"), schema
        self._merge, self._fan_in = merge, fan_in
        jvm = spark.sparkContext._jvm
        self._path_of = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path_of(self._folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, level: int, block: int) -> str:
        return f"{self._folder}/level={level}/block={block}"

    def _is_whole(self, level: int, block: int) -> bool:
        return self._fs.exists(self._path_of(f"{self._path(level, block)}/{MARKER}"))

    def _names(self, path: str, prefix: str) -> list[int]:
        at = self._path_of(path)
        if not self._fs.exists(at):
            return []
        names = (status.getPath().getName() for status in self._fs.listStatus(at))
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def blocks(self) -> list[tuple[int, int]]:
        """The blocks to read: whole ones that none above covers, as (level, block)."""
        found: list[tuple[int, int]] = []
        for level in reversed(self._names(self._folder, "level=")):
            for block in self._names(f"{self._folder}/level={level}", "block="):
                covered = any(block // self._fan_in ** (above - level) == n for above, n in found if above > level)
                if not covered and self._is_whole(level, block):
                    found.append((level, block))
        return found

    def _read(self, blocks: list[tuple[int, int]]) -> DataFrame:
        if not blocks:
            return self._spark.createDataFrame([], self._schema)
        paths = [self._path(level, block) for level, block in blocks]
        return self._spark.read.schema(self._schema).parquet(*paths).select(*self._schema.names)

    def _write(self, df: DataFrame, level: int, block: int) -> None:
        path = self._path(level, block)
        # The marker goes first: what is being replaced counts for nothing.
        self._fs.delete(self._path_of(f"{path}/{MARKER}"), False)
        df.write.mode("overwrite").parquet(path)
        self._fs.create(self._path_of(f"{path}/{MARKER}"), True).close()

    def put(self, batch: int, folded: DataFrame) -> None:
        """Store a batch's fold, once however often it is put, and merge what is full."""
        # A batch that a merge covers has been counted there.
        if not any(block == batch // self._fan_in**level for level, block in self.blocks() if level):
            self._write(folded, 0, batch)
        level, block = 0, batch
        while (block + 1) % self._fan_in == 0:
            level, block = level + 1, block // self._fan_in
            if not self._is_whole(level, block):
                parts = range(block * self._fan_in, (block + 1) * self._fan_in)
                whole = [(level - 1, part) for part in parts if self._is_whole(level - 1, part)]
                self._write(self._merge(self._read(whole)), level, block)
            for part in range((block - 1) * self._fan_in, block * self._fan_in):
                self._fs.delete(self._path_of(self._path(level - 1, part)), True)

    def read(self) -> DataFrame:
        """The folds of all batches added up."""
        return self._merge(self._read(self.blocks()))
