"""Benchmark decontamination as a prefix-filtered containment join.

A benchmark item stands for its windows: every run of 13 words, or all of an item of fewer. A
text holds a window only if it holds all its shingles, so the shingle of the window that is the
rarest in the corpus is a prefix of sufficient length: windows meet texts on that one token.
Where they meet, the window's place in the text is known; it must not reach beyond either end of
the text, and then its words are compared one by one.

Texts are read once. Shingles that cannot be any window's are dropped there by a bitmap of fixed
size, so only few rows are shuffled; those let through by chance fall out in the join.

Edge cases: NULL or word-free texts have no words and no hits; items without words have no
windows; items with a NULL id still hit words but are not counted; equal items count by their
ids; extra columns pass through.
Columns with names that are used inside, which begin with an underscore, are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm import words as W
from mercatura.session import checkpointed

WINDOW = 13
SHINGLE = 5
# A text is contaminated if at least one word in so many is hit.
WORDS_PER_HIT = 20
# Bits of the bitmap (as a power of two) and rows it is put together from.
FILTER_BITS = 26
_PARTS = 64


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def windows(items: DataFrame, key: str, text: str, size: int = WINDOW) -> DataFrame:
    """A row for each shingle of each window: ``item, window, n, offset, shingle_size, shingle``."""
    schema = (
        f"item {items.schema[key].dataType.simpleString()}, window string, n int, offset int,"
        " shingle_size int, shingle long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = W.words(batch.column(1))
            rows: list[tuple] = []
            for t in range(len(found)):
                a, b = found.first[t], found.first[t + 1]
                n = min(int(b - a), size)
                if not n:
                    continue
                one = W.Words(
                    found.lower, found.start[a:b], found.end[a:b], np.array([0, b - a]), found.hashes[a:b]
                )
                width = min(SHINGLE, n)
                shingles = _signed(one.shingles(width)[0])
                for start in range(int(b - a) - n + 1):
                    window = one.text(start, start + n)
                    for offset in range(n - width + 1):
                        rows.append((t, window, n, offset, width, int(shingles[start + offset])))
            if rows:
                at, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)),
                        *(
                            pa.array(c, kind)
                            for c, kind in zip(
                                columns,
                                [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()],
                                strict=True,
                            )
                        ),
                    ],
                    ["item", "window", "n", "offset", "shingle_size", "shingle"],
                )

    return items.select(key, text).mapInArrow(run, schema)


def bitmap(shingles: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """Which top bits any shingle has. Its size is fixed, whatever the number of shingles."""
    part = (1 << bits) // _PARTS // 8

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            top = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)
            np.bitwise_or.at(flags, (top >> np.uint64(3)).astype(np.int64), _bit(top))
        cut = flags.reshape(_PARTS, part)
        used = np.flatnonzero(cut.any(axis=1))
        for i in used:
            yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "flags": [cut[i].tobytes()]})

    def either(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(part, np.uint8)
        for flags in rows["flags"]:
            total |= np.frombuffer(flags, np.uint8)
        return pd.DataFrame({"part": [key[0]], "flags": [total.tobytes()]})

    schema = "part int, flags binary"
    merged = shingles.select("shingle").mapInArrow(partial, schema).groupBy("part").applyInPandas(either, schema)
    out = np.zeros((_PARTS, part), np.uint8)
    for row in merged.collect():  # at most _PARTS rows, 2**bits bits in all
        out[row["part"]] = np.frombuffer(row["flags"], np.uint8)
    return out.tobytes()


def _bit(top: np.ndarray) -> np.ndarray:
    return (np.uint8(1) << (top & np.uint64(7)).astype(np.uint8)).astype(np.uint8)


def _scan(df: DataFrame, text: str, sizes: list[int], flags: bytes, bits: int, window: int) -> DataFrame:
    """Each row of ``df`` without the text, with ``_row``, ``n_words`` and ``_runs``: the words
    around the shingles that pass the bitmap, and where those are."""
    kept = [c for c in df.columns if c != text]
    run_type = T.ArrayType(
        T.StructType(
            [
                T.StructField("start", T.IntegerType()),
                T.StructField("words", T.StringType()),
                T.StructField("at", T.ArrayType(T.IntegerType())),
                T.StructField("shingle", T.ArrayType(T.LongType())),
            ]
        )
    )
    schema = T.StructType(
        [
            *(f for f in df.schema.fields if f.name in kept),
            T.StructField("_row", T.LongType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("_runs", run_type),
        ]
    )
    shared = df.sparkSession.sparkContext.broadcast(flags)
    arrow_runs = pa.list_(
        pa.struct(
            [
                ("start", pa.int32()),
                ("words", pa.string()),
                ("at", pa.list_(pa.int32())),
                ("shingle", pa.list_(pa.int64())),
            ]
        )
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for a, b in W.chunks(whole.column(text)):
                batch = whole.slice(a, b - a)
                found = W.words(batch.column(text))
                runs: list[list] = [[] for _ in range(len(found))]
                hits = []
                for size in sizes:
                    shingles, at = found.shingles(size)
                    top = shingles >> np.uint64(64 - bits)
                    passed = bitmap[(top >> np.uint64(3)).astype(np.int64)] & _bit(top) != 0
                    hits.append((at[passed], shingles[passed], np.full(passed.sum(), size)))
                at = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, np.int64)
                if len(at):
                    order = np.argsort(at, kind="stable")
                    at = at[order]
                    values = _signed(np.concatenate([h[1] for h in hits])[order])
                    owner = np.searchsorted(found.first, at, side="right") - 1
                    low = np.maximum(at - window + 1, found.first[owner])
                    high = np.minimum(at + window, found.first[owner + 1])
                    # A new run where the words around two hits do not touch.
                    new = np.ones(len(at), bool)
                    new[1:] = (owner[1:] != owner[:-1]) | (low[1:] > high[:-1])
                    starts = np.flatnonzero(new)
                    for s, e in zip(starts, [*starts[1:], len(at)], strict=True):
                        t = owner[s]
                        base = found.first[t]
                        runs[t].append(
                            {
                                "start": int(low[s] - base),
                                "words": found.text(low[s], high[e - 1]),
                                "at": (at[s:e] - base).tolist(),
                                "shingle": values[s:e].tolist(),
                            }
                        )
                rows = np.arange(number, number + len(found))
                number += len(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in kept),
                        pa.array(rows, pa.int64()),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(runs, arrow_runs),
                    ],
                    [*kept, "_row", "n_words", "_runs"],
                )

    return df.select(*kept, text).mapInArrow(scan, schema)


def find(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``n_hit``, ``items`` (sorted, as strings) and
    ``contaminated``. Columns of these names in ``docs`` are replaced."""
    listed = checkpointed(windows(items, item_key, item_text, window))
    sizes = [r[0] for r in listed.select("shingle_size").distinct().collect()]  # 1 .. SHINGLE
    flags = bitmap(listed, filter_bits)
    named = docs.drop("n_words", "n_hit", "items", "contaminated", "_row", "_runs")
    scanned = checkpointed(_scan(named, text, sorted(sizes), flags, filter_bits, window))

    hits = (
        scanned.where(F.size("_runs") > 0)
        .select("_row", "n_words", F.explode("_runs").alias("_run"))
        .select("_row", "n_words", "_run.start", "_run.words", F.explode(F.arrays_zip("_run.at", "_run.shingle")).alias("_hit"))
        .select("_row", "n_words", "start", "words", F.col("_hit.at").alias("at"), F.col("_hit.shingle").alias("shingle"))
    )
    counts = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("count"))
    tokens = listed.select("window", "n", "offset", "shingle").distinct()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "offset", "shingle"))
    prefix = (
        tokens.join(counts, "shingle", "left")
        .groupBy("window", "n")
        .agg(rarest.alias("_rarest"))
        .where("_rarest.count > 0")
        .select("window", "n", "_rarest.offset", "_rarest.shingle")
    )
    place = F.col("at") - F.col("offset")
    here = F.array_join(F.slice(F.split("words", " "), F.col("begin") - F.col("start") + 1, F.col("n")), " ")
    found = (
        hits.join(prefix, "shingle")
        .withColumn("begin", place)
        .where((F.col("begin") >= F.col("start")) & (F.col("begin") + F.col("n") <= F.col("n_words")))
        .where(here == F.col("window"))
        .select("_row", "window", "begin", "n")
        .distinct()
    )
    ids = listed.select("window", F.col("item").cast("string").alias("item")).distinct()
    of_row = (
        found.join(ids, "window")
        .groupBy("_row")
        .agg(
            F.sort_array(F.collect_set("item")).alias("items"),
            F.sort_array(
                F.collect_set(F.struct("begin", (F.col("begin") + F.col("n")).alias("end")))
            ).alias("_spans"),
        )
        .select("_row", "items", covered(F.col("_spans")).alias("n_hit"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        scanned.drop("_runs")
        .join(of_row, "_row", "left")
        .drop("_row")
        .withColumns(
            {
                "n_hit": n_hit,
                "items": F.coalesce("items", F.array().cast("array<string>")),
                "contaminated": (n_hit > 0) & (n_hit * WORDS_PER_HIT >= F.col("n_words")),
            }
        )
    )


def covered(spans: Column) -> Column:
    """Number of places in the union of sorted ``[begin, end)`` spans."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))

    def step(state: Column, span: Column) -> Column:
        return F.struct(
            F.greatest(state["upto"], span["end"]).alias("upto"),
            (state["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(state["upto"], span["begin"]))).alias("n"),
        )

    return F.aggregate(spans, start, step, lambda state: state["n"])
