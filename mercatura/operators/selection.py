"""The rows at given positions of an order, and tiles from them, without sorting the table.

NTILE needs no rank for each row, only the rows at which tiles begin; a row's tile is the number of
those that do not come after it. The rows are found by narrowing: a sample gives two rows around
each position, one pass counts how many come before them, and the search goes on between them until few
enough are left to be sorted. Several orders and positions share a pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercatura.session import checkpointed

# Rows that are sorted at once, and rows of a sample, which has to be smaller.
FEW = 5_000
SAMPLED = 2_000


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool = False
    nulls_first: bool = True

    def order(self) -> Column:
        c = F.col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


Row = tuple[Any, ...]


def _literal(df: DataFrame, column: str, value: Any) -> Column:
    """The value in the column's own type; what is no plain number or text goes by its text."""
    plain = value if isinstance(value, (bool, int, float, str)) else str(value)
    return F.lit(plain).cast(df.schema[column].dataType)


def comes_before(df: DataFrame, keys: Sequence[SortKey], row: Row) -> Column:
    """Whether a row of ``df`` comes before the given one, whose values are those of ``keys``."""
    ways, equal = [], F.lit(True)
    for key, value in zip(keys, row, strict=True):
        c = F.col(key.column)
        if value is None:
            ahead = F.lit(False) if key.nulls_first else c.isNotNull()
            same = c.isNull()
        else:
            other = _literal(df, key.column, value)
            ahead = F.coalesce(c > other if key.descending else c < other, F.lit(key.nulls_first))
            same = c.eqNullSafe(other)
        ways.append(equal & ahead)
        equal = equal & same
    return reduce(lambda a, b: a | b, ways)


def _sorted_rows(df: DataFrame, keys: Sequence[SortKey]) -> list[Row]:
    """Few rows, in Spark's order: text goes by its bytes, and NaN is above all numbers."""
    out = [tuple(r) for r in df.select(*[k.column for k in keys]).collect()]

    def plain(value: Any) -> Any:
        if isinstance(value, float):
            return (value != value, 0.0 if value != value else value)
        return value.encode() if isinstance(value, str) else value

    # Sorting is stable: the last key goes first.
    for i, key in reversed(list(enumerate(keys))):
        known = sorted((r for r in out if r[i] is not None), key=lambda r: plain(r[i]), reverse=key.descending)
        missing = [r for r in out if r[i] is None]
        out = missing + known if key.nulls_first else known + missing
    return out


def _around(position: int, size: int, sample: list[Row]) -> tuple[Row | None, Row | None]:
    """Two rows of a sorted sample that very likely have the position between them."""
    n = len(sample)
    middle, reach = position / size * n, 2 * sqrt(n) + 1
    low, high = int(middle - reach), ceil(middle + reach)
    return (sample[low] if low >= 0 else None, sample[high] if high < n else None)


def rows_at(df: DataFrame, keys: Sequence[SortKey], positions: Sequence[int], size: int) -> list[Row]:
    """The values of ``keys`` at 0-based positions of the order, of ``size`` rows in all.

    ``df`` is read several times and has to be the same each time. The keys together have to tell
    rows apart: more than ``FEW`` rows that are equal in all of them cannot be narrowed down and raise.
    """
    names = [k.column for k in keys]
    # Position, rows before the part that holds it, its number of rows, and its ends.
    open_ = {p: (0, size, None, None) for p in positions}
    found: dict[int, Row] = {}
    while open_:
        sizes_before = {p: part[1] for p, part in open_.items()}
        parts: dict[tuple, list[int]] = {}
        for p, (_, _, low, high) in open_.items():
            parts.setdefault((low, high), []).append(p)
        ends: dict[int, tuple] = {}
        for (low, high), inside in parts.items():
            here = df
            if low is not None:
                here = here.where(~comes_before(df, keys, low))
            if high is not None:
                here = here.where(comes_before(df, keys, high))
            before, rows, _, _ = open_[inside[0]]
            if rows <= FEW:
                values = _sorted_rows(here, keys)
                for p in inside:
                    found[p] = values[p - before]
                    del open_[p]
                continue
            # The least hashes are as good as drawn by lot, and are drawn again by a task that is repeated.
            drawn = here.select(*names).orderBy(F.xxhash64(*names), *names).limit(SAMPLED)
            sample = _sorted_rows(drawn, keys)
            for p in inside:
                ends[p] = tuple(e or o for e, o in zip(_around(p - before, rows, sample), (low, high), strict=True))
        marks = list(dict.fromkeys(e for pair in ends.values() for e in pair if e is not None))
        if not marks:
            continue
        counted = df.agg(*[F.count_if(comes_before(df, keys, m)) for m in marks]).first()
        above = dict(zip(marks, counted, strict=True))
        for p, pair in ends.items():
            before, rows, *old = open_[p]
            low, high = pair
            first = 0 if low is None else above[low]
            last = size if high is None else above[high]
            if first > p:
                # The sample was unlucky: the position lies below its lower row.
                low, high, last, first = old[0], low, first, before
            elif last <= p:
                low, high, first, last = high, old[1], last, before + rows
            open_[p] = (first, last - first, low, high)
        if all(open_[p][1] >= sizes_before[p] for p in ends):
            raise ValueError(f"too many rows are equal in {names}")
    return [found[p] for p in positions]


def tile_starts(size: int, tiles: int) -> list[int]:
    """The positions at which tiles 2, 3, ... of NTILE begin: the first tiles get a row more each."""
    each, larger = divmod(size, tiles)
    starts = [t * each + min(t, larger) for t in range(1, tiles)]
    return [s for s in starts if s < size]


def with_tiles(df: DataFrame, tiles: int, orders: Mapping[str, Sequence[SortKey]]) -> DataFrame:
    """Add an NTILE for each name and order. ``df`` is stored once."""
    rows = checkpointed(df)
    size = rows.count()
    starts = tile_starts(size, tiles)
    added = {}
    for name, keys in orders.items():
        tile: Column = F.lit(1)
        for row in rows_at(rows, keys, starts, size):
            tile = tile + (~comes_before(rows, keys, row)).cast("int")
        added[name] = tile.cast("int")
    return rows.withColumns(added)
