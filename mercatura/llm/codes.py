"""Compressing vectors to codes: each of a vector's equal parts becomes the number of the nearest entry of
that part's codebook.

Components become integers (a scale, then rounded down), so that all sums and distances are exact and no
result depends on the order of additions. Codebooks are refined in rounds: every part goes to its nearest
entry, ties to the lower number, and an entry becomes the componentwise mean of its parts, rounded down.

The nearest entry is found by Orchard's search. Every entry keeps a list of all entries by their distance
from it. A search walks the list of the best entry so far; when it finds a better one, it jumps to that
one's list; entries it has seen are marked and not measured again; and it stops where the list is farther
away than twice the best distance, as the triangle inequality leaves nothing better beyond. All parts of
a batch search side by side.

Codebooks are small, whatever the number of vectors, and go to every task; vectors never move. A task
sends back its sums for each entry.

Edge cases: a row whose vector is NULL or holds a NULL or a number that is not finite is dropped;
repeated rows count as often as they are there; rows with equal keys are ordered by their vectors, NULL
keys last, where the first entries are chosen; fewer rows than entries make fewer entries; an empty table
gives no rows and empty codebooks. Vectors of different lengths, or of a length that parts do not
divide, raise, and so do components so large that squares would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.session import checkpointed

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
RESULTS = ("code", "error")


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry]`` and the lists of Orchard's search."""

    entries: np.ndarray
    scale: int
    order: np.ndarray
    gaps: np.ndarray

    @staticmethod
    def of(entries: np.ndarray, scale: int = SCALE) -> Codebooks:
        parts, size, _ = entries.shape
        gaps = np.zeros((parts, size, size), np.int64)
        for gap, own in zip(gaps, entries, strict=True):
            gap[:] = ((own[:, None, :] - own[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(gaps, axis=2, kind="stable")
        return Codebooks(entries, scale, order, np.take_along_axis(gaps, order, axis=2))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each part of integer vectors, and its squared distance."""
        parts, size, width = self.entries.shape
        n = len(vectors) * parts
        if not n:
            return (np.zeros((len(vectors), parts), np.int64),) * 2
        wanted = vectors.reshape(n, width)
        book = np.tile(np.arange(parts) * size, len(vectors))
        entries = self.entries.reshape(parts * size, width)
        order, gaps = self.order.ravel(), self.gaps.ravel()
        best = np.zeros(n, np.int64)
        least = ((wanted - entries[book]) ** 2).sum(axis=1)
        seen = np.zeros((n, size), bool)
        seen[:, 0] = True
        at = np.zeros(n, np.int64)
        going = np.arange(n)
        while len(going):
            place = (book[going] + best[going]) * size + at[going]
            # Distances are squared, so twice is four times.
            within = gaps[place] <= 4 * least[going]
            going, found = going[within], order[place[within]]
            fresh = np.flatnonzero(~seen[going, found])
            new, entry = going[fresh], found[fresh]
            seen[new, entry] = True
            distance = ((wanted[new] - entries[book[new] + entry]) ** 2).sum(axis=1)
            better = (distance < least[new]) | (distance == least[new]) & (entry < best[new])
            at[going] += 1
            jump = new[better]
            best[jump], least[jump], at[jump] = entry[better], distance[better], 0
            going = going[at[going] < size]
        return best.reshape(-1, parts), least.reshape(-1, parts)


def _is_whole(vector: str) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))


def kept(df: DataFrame, vector: str) -> DataFrame:
    """The rows that have a vector of finite numbers."""
    return df.withColumn(vector, F.col(vector).cast("array<double>")).where(_is_whole(vector))


def _integers(column: pa.Array, scale: int) -> np.ndarray:
    """One row for each vector; all are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).astype(np.int64).reshape(len(column), -1)


def _check(sizes: tuple, parts: int, scale: int) -> int:
    """The width of a part."""
    least, most, largest = sizes
    if least != most or most % parts:
        raise ValueError(f"vectors of {least} to {most} components do not make {parts} equal parts")
    width = most // parts
    limit = int((2**60 / max(1, width)) ** 0.5 / 4)
    if largest is not None and largest * scale > limit:
        raise ValueError(f"a component of {largest} is too large for exact squares (limit {limit / scale})")
    return width


def fit(
    df: DataFrame,
    key: str,
    vector: str,
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks:
    """Codebooks that begin as the parts of the vectors with the smallest keys."""
    rows = kept(df, vector).select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    sizes = rows.agg(
        F.min(F.size("vector")), F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))
    ).first()
    if sizes[0] is None:
        return Codebooks.of(np.zeros((0, 0, 0), np.int64), scale)
    width = _check(tuple(sizes), parts, scale)
    whole = F.transform("vector", lambda x: F.floor(x * scale))
    # As many rows as a codebook has entries.
    first = rows.select("key", whole.alias("vector")).orderBy(F.asc_nulls_last("key"), "vector").limit(entries).collect()
    start = np.array([r["vector"] for r in first], np.int64).reshape(len(first), parts, width)
    books = Codebooks.of(start.transpose(1, 0, 2).copy(), scale)
    for _ in range(rounds):
        books = Codebooks.of(_means(rows, books), scale)
    return books


def _means(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """The entries of a new round."""
    parts, size, width = books.entries.shape
    slots = parts * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((slots, width), np.int64), np.zeros(slots, np.int64)
        for batch in batches:
            vectors = _integers(batch.column(0), books.scale)
            slot = (books.nearest(vectors)[0] + np.arange(parts) * size).ravel()
            np.add.at(sums, slot, vectors.reshape(len(slot), width))
            counts += np.bincount(slot, minlength=slots)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                ["slot", "n", "sums"],
            )

    folded = rows.select("vector").mapInArrow(run, "slot long, n long, sums array<long>")
    total = folded.groupBy("slot").agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    )
    entries = books.entries.reshape(slots, width).copy()
    # One row for each entry of all codebooks.
    for slot, n, *sums in total.collect():
        entries[slot] = [s // n for s in sums]
    return entries.reshape(books.entries.shape)


def encode(df: DataFrame, vector: str, books: Codebooks) -> DataFrame:
    """Rows with a whole vector, with ``code`` (an entry's number for each part) and ``error`` (the
    squared distances, summed up). Columns of these names are replaced, all others stay."""
    others = [c for c in df.columns if c not in RESULTS]
    packed = kept(df.select(F.struct(*others).alias("_row"), F.col(vector).alias("_vector")), "_vector")
    schema = T.StructType(
        [
            packed.schema["_row"],
            T.StructField("code", T.ArrayType(T.IntegerType())),
            T.StructField("error", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = books.nearest(_integers(batch.column(1), books.scale))
            ends = pa.array(np.arange(len(code) + 1) * code.shape[1], pa.int32())
            codes = pa.ListArray.from_arrays(ends, pa.array(code.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, pa.array(error.sum(axis=1))], schema.names)

    return packed.mapInArrow(run, schema).select("_row.*", *RESULTS)


def decode(df: DataFrame, books: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """Add the vector that a code stands for."""
    flat = books.entries.reshape(-1, books.entries.shape[2]) / books.scale
    size = books.entries.shape[1]
    table = F.array(*[F.array(*map(F.lit, entry)) for entry in flat.tolist()])
    parts = F.transform(code, lambda entry, part: F.get(table, part * size + entry))
    return df.withColumn(vector, F.flatten(parts))


def with_group_sum(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of equal ``group``, NULLs together."""
    rows = checkpointed(df)
    # Stored, so that a group with most of the rows can be split in the join.
    sums = checkpointed(rows.groupBy(F.col(group).alias("_group")).agg(F.sum(value).alias(name)))
    return rows.join(sums, rows[group].eqNullSafe(sums["_group"])).drop("_group")
