"""Running sums within groups of any size.

Rows are dealt out by ranges of group and order, so that a group with most of all rows is spread over
many tasks. Each task sums up its own rows as they pass. What the tasks before have of the group that a
task begins with is one row for each task; it is added afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.session import checkpointed

_PART, _ROW = "_part", "_row"


def _sums_of(names: Sequence[str]) -> list[str]:
    return [f"_sum_{name}" for name in names]


def with_running_sums(df: DataFrame, group: str, order: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add ``_sum_<name>``: the sum of ``name`` over the group's rows up to and with this one.

    ``group`` and the summed columns are longs without NULL; rows that are equal in ``group`` and
    ``order`` stay in one task, so their number has to be bounded. ``df`` is read twice (Spark
    looks for the limits of the ranges first). No column may begin with ``_sum_``.
    """
    sums = _sums_of(names)
    longs = [T.StructField(c, T.LongType()) for c in (*sums, _PART, _ROW)]
    schema = T.StructType([*df.schema.fields, *longs])
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, last, held = TaskContext.get().partitionId(), 0, None, [0] * len(names)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            of = batch.column(group).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            sizes = np.diff(np.append(begins, n))
            arrays = [batch.column(c) for c in columns]
            for i, name in enumerate(names):
                x = batch.column(name).to_numpy(zero_copy_only=False)
                total = np.cumsum(x, dtype=np.int64)
                before = total[begins] - x[begins]
                if of[0] == last:
                    before[0] -= held[i]
                total -= np.repeat(before, sizes)
                held[i] = int(total[-1])
                arrays.append(pa.array(total))
            last = of[-1]
            arrays += [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(rows, rows + n, dtype=np.int64))]
            rows += n
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    placed = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    done = checkpointed(placed.mapInArrow(run, schema))
    ends = done.groupBy(_PART).agg(F.max_by(F.struct(group, *sums), _ROW).alias("last"))
    held: list[tuple] = []
    now, carried = None, [0] * len(names)
    # One row for each task.
    for part, last in sorted((r[0], r[1]) for r in ends.collect()):
        if any(carried):
            held.append((part, now, *carried))
        if last[0] != now:
            now, carried = last[0], [0] * len(names)
        carried = [a + b for a, b in zip(carried, last[1:], strict=True)]
    fields = [T.StructField(c, T.LongType()) for c in (_PART, group, *(f"_held{s}" for s in sums))]
    before = df.sparkSession.createDataFrame(held, T.StructType(fields))
    joined = done.join(F.broadcast(before), [_PART, group], "left")
    added = [(F.col(s) + F.coalesce(f"_held{s}", F.lit(0))).alias(s) for s in sums]
    return joined.select(*columns, *added)
