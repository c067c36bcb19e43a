"""Joins of texts by Jaccard similarity of their word n-grams, with Bayesian pruning.

Texts with the same set of n-grams are folded into one node first. Nodes whose MinHash values
agree in one of the bands are candidates; at a similarity of 0.8 a pair misses all bands once in
150,000. Candidates form groups, and a group's pairs are judged inside tasks, in blocks of bounded
size, so that no pair ever is a row:

- pairs whose sizes rule the threshold out are dropped;
- MinHash values are compared some at a time. With ``m`` of ``n`` equal and an even prior, the
  similarity has a Beta(m + 1, n - m + 1) posterior; a pair is dropped once the probability of
  reaching the threshold is below the tolerance;
- what is left is verified on the whole sets.

Of each block come a node's number of links, and one edge per node to hold linked nodes together.
A group beyond one block is compared block by block, each pair of blocks in a task of its own.

Edge cases: NULL and word-free texts have no n-grams, are linked to nothing and are classes of
their own; a text of fewer words than ``n`` is one n-gram; whole texts count; repeated rows are
linked to each other; other columns pass through, and columns named like results are replaced.
Columns with names that are used inside, which begin with an underscore, are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm import words as W
from mercatura.llm.components import components
from mercatura.llm.decontaminate import bitmap
from mercatura.session import checkpointed

N = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, BAND_ROWS = 30, 5
HASHES = BANDS * BAND_ROWS
# MinHash values compared at a time.
STEP = 25
# Bounds of a block: nodes, and n-grams in all of them.
BLOCK_NODES, BLOCK_GRAMS = 1_024, 1_000_000
FILTER_BITS = 26

_U = np.uint64
_random = np.random.default_rng(5_2024)
_FACTOR = _random.integers(0, 2**62, HASHES, dtype=np.uint64) * _U(2) + _U(1)
_SHIFT = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
_BAND_FACTOR = _random.integers(0, 2**62, (BANDS, BAND_ROWS), dtype=np.uint64) * _U(2) + _U(1)


def gram_sets(found: W.Words, n: int = N) -> list[np.ndarray]:
    """The sorted different n-gram hashes of each text."""
    hashes, at = found.shingles(n)
    cuts = np.searchsorted(at, found.first)
    out = []
    for t, (a, b) in enumerate(pairwise(cuts)):
        size = int(found.first[t + 1] - found.first[t])
        if 0 < size < n:
            first, last = found.first[t], found.first[t + 1]
            one = W.Words(found.lower, found.start[first:last], found.end[first:last],
                          np.array([0, size]), found.hashes[first:last])
            out.append(one.shingles(size)[0])
        else:
            out.append(np.unique(hashes[a:b]))
    return out


def min_hashes(grams: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(grams), 2_048):
            values = grams[start : start + 2_048, None] * _FACTOR + _SHIFT
            least = np.minimum(least, (values >> _U(32)).min(axis=0))
    return least.astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = signature.reshape(BANDS, BAND_ROWS).astype(np.uint64)
        total = (W.mixed(rows + _U(1)) * _BAND_FACTOR).sum(axis=1, dtype=np.uint64)
        return W.mixed(total + np.arange(BANDS, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)).view(np.int64)


def digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


@cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """After each step, the least number of equal values that keeps a pair."""

    def reaches(m: int, n: int) -> float:
        # P(Beta(m + 1, n - m + 1) >= t) is P(Binomial(n + 1, t) <= m).
        return sum(comb(n + 1, i) * threshold**i * (1 - threshold) ** (n + 1 - i) for i in range(m + 1))

    return tuple(
        next(m for m in range(n + 1) if reaches(m, n) >= tolerance)
        for n in range(STEP, HASHES + 1, STEP)
    )


def _scan(df: DataFrame, text: str, n: int) -> DataFrame:
    """Each row without its text, with ``_row``, ``_digest`` of its n-grams (NULL if none) and
    ``_bands``."""
    kept = [c for c in df.columns if c != text]
    schema = T.StructType(
        [
            *(f for f in df.schema.fields if f.name in kept),
            T.StructField("_row", T.LongType()),
            T.StructField("_digest", T.BinaryType()),
            T.StructField("_bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for a, b in W.chunks(whole.column(text)):
                batch = whole.slice(a, b - a)
                sets = gram_sets(W.words(batch.column(text)), n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in kept),
                        pa.array(np.arange(number, number + len(sets)), pa.int64()),
                        pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(
                            [band_keys(min_hashes(s)) if len(s) else [] for s in sets],
                            pa.list_(pa.int64()),
                        ),
                    ],
                    [*kept, "_row", "_digest", "_bands"],
                )
                number += len(sets)

    return df.select(*kept, text).mapInArrow(run, schema)


def _sets_of(df: DataFrame, text: str, n: int, flags: bytes) -> DataFrame:
    """``_digest``, ``size``, ``grams`` and ``signature`` of the texts whose digest passes."""
    shared = df.sparkSession.sparkContext.broadcast(flags)
    bits = FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.frombuffer(shared.value, np.uint8)
        for whole in batches:
            for a, b in W.chunks(whole.column(0)):
                rows = []
                for grams in gram_sets(W.words(whole.column(0).slice(a, b - a)), n):
                    if not len(grams):
                        continue
                    name = digest(grams)
                    top = int.from_bytes(name[:8], "big") >> (64 - bits)
                    if passes[top >> 3] >> (top & 7) & 1:
                        rows.append((name, len(grams), grams.tobytes(), min_hashes(grams).tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(c, kind)
                            for c, kind in zip(
                                zip(*rows, strict=True),
                                [pa.binary(), pa.int64(), pa.binary(), pa.binary()],
                                strict=True,
                            )
                        ],
                        ["_digest", "size", "grams", "signature"],
                    )

    return df.select(text).mapInArrow(run, "_digest binary, size long, grams binary, signature binary")


def _shared_counts(
    first: list[np.ndarray], second: list[np.ndarray], i: np.ndarray, j: np.ndarray
) -> np.ndarray:
    """Number of n-grams that ``first[i]`` and ``second[j]`` share."""
    if len(i) <= 4 * (len(first) + len(second)):
        return np.array(
            [len(np.intersect1d(first[a], second[b], assume_unique=True)) for a, b in zip(i, j, strict=True)],
            np.int64,
        )
    # Many pairs: products of 0/1 matrices over the n-grams that both sides have.
    sides = []
    for sets in (first, second):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        sides.append((owner, np.concatenate(sets)))
    common = np.intersect1d(sides[0][1], sides[1][1])
    total = np.zeros((len(first), len(second)), np.float32)
    columns = []
    for owner, grams in sides:
        place = np.searchsorted(common, grams)
        place = np.minimum(place, max(len(common) - 1, 0))
        known = common[place] == grams if len(common) else np.zeros(len(grams), bool)
        order = np.argsort(place[known], kind="stable")
        columns.append((owner[known][order], place[known][order]))
    for start in range(0, len(common), 4_096):
        parts = []
        for (owner, place), sets in zip(columns, (first, second), strict=True):
            a, b = np.searchsorted(place, [start, start + 4_096])
            dense = np.zeros((len(sets), 4_096), np.float32)
            dense[owner[a:b], place[a:b] - start] = 1
            parts.append(dense)
        total += parts[0] @ parts[1].T
    return total[i, j].astype(np.int64)


def linked_pairs(
    first: list[np.ndarray],
    second: list[np.ndarray],
    first_signs: np.ndarray,
    second_signs: np.ndarray,
    same: bool,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of two blocks that reach the threshold; within one block, ``i < j``."""
    sizes_a = np.array([len(s) for s in first])
    sizes_b = np.array([len(s) for s in second])
    needed = least_matches(threshold, tolerance)
    out_i, out_j = [], []
    for start in range(0, len(first), 128):
        rows = np.arange(start, min(start + 128, len(first)))
        low = np.minimum(sizes_a[rows, None], sizes_b)
        fits = low >= threshold * np.maximum(sizes_a[rows, None], sizes_b) - 1e-9
        if same:
            fits &= rows[:, None] < np.arange(len(second))
        i, j = np.nonzero(fits)
        i = i + start
        equal = np.zeros(len(i), np.int64)
        for step, least in enumerate(needed):
            if not len(i):
                break
            columns = slice(step * STEP, (step + 1) * STEP)
            for cut in range(0, len(i), 200_000):
                part = slice(cut, cut + 200_000)
                equal[part] += (first_signs[i[part], columns] == second_signs[j[part], columns]).sum(axis=1)
            kept = equal >= least
            i, j, equal = i[kept], j[kept], equal[kept]
        if len(i):
            shared = _shared_counts([first[r] for r in rows], second, i - start, j)
            either = sizes_a[i] + sizes_b[j] - shared
            reached = shared >= threshold * either - 1e-9
            out_i.append(i[reached])
            out_j.append(j[reached])
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def _hubs(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, one node of its component in the graph of the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def _judge(members: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``node, links, hub`` from rows sorted by ``root, low, high``; the rows of one pair of
    blocks are held at a time."""

    def settle(rows: list[tuple]) -> dict[str, list]:
        _, low, high = rows[0][:3]
        sides = [[r for r in rows if r[3] == block] for block in dict.fromkeys((low, high))]
        sets = [[np.frombuffer(r[6], np.uint64) for r in side] for side in sides]
        signs = [np.array([np.frombuffer(r[7], np.uint32) for r in side]).reshape(-1, HASHES) for side in sides]
        same = low == high
        other = 0 if same else 1
        i, j = linked_pairs(sets[0], sets[other], signs[0], signs[other], same, threshold, tolerance)
        if not same:
            j = j + len(sides[0])
        nodes = [r for side in sides for r in side]
        copies = np.array([r[5] for r in nodes], np.int64)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        hub = _hubs(len(nodes), i, j)
        some = np.flatnonzero(links)
        return {
            "node": [nodes[x][4] for x in some],
            "links": links[some].tolist(),
            "hub": [nodes[hub[x]][4] for x in some],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())])
        held: list[tuple] = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                if held and held[0][:3] != row[:3]:
                    yield pa.RecordBatch.from_pydict(settle(held), schema)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pydict(settle(held), schema)

    order = ["root", "low", "high"]
    chosen = members.select(*order, "block", "node", "copies", "grams", "signature")
    return (
        chosen.repartition(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, "node long, links long, hub long")
    )


def join(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` without its text, with ``class_id``, the least key of the row's group of linked
    rows, ``n_links``, the number of other rows it is linked to, and ``stands``, true for one row
    of each group: one with the least key."""
    named = docs.drop("class_id", "n_links", "stands", "_row", "_digest", "_bands")
    rows = checkpointed(_scan(named, text, n))
    # NULL keys come last.
    place = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"), F.col("_row").alias("row"))
    folded = (
        rows.where("_digest IS NOT NULL")
        .groupBy("_digest")
        .agg(
            F.min("_row").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.min(place).alias("_least"),
            F.first("_bands").alias("_bands"),
        )
    )
    nodes = checkpointed(folded)
    banded = nodes.select("node", F.explode("_bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = components(banded.join(hubs.drop("n"), "band"), "node", "hub")

    wanted = checkpointed(nodes.join(groups, "node").select("node", "root", "_digest", "copies"))
    first_bytes = F.conv(F.hex(F.substring("_digest", 1, 8)), 16, -10).cast("long")
    flags = bitmap(wanted.select(first_bytes.alias("shingle")), FILTER_BITS)
    sets = (
        _sets_of(named, text, n, flags)
        .groupBy("_digest")
        .agg(*[F.first(c).alias(c) for c in ("size", "grams", "signature")])
    )
    members = wanted.join(sets, "_digest")
    sized = checkpointed(members)
    blocks = sized.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_GRAMS)
        ).cast("int").alias("blocks")
    )
    dealt = (
        sized.join(blocks, "root")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )
    links = checkpointed(_judge(dealt, threshold, tolerance))
    counts = links.groupBy("node").agg(F.sum("links").alias("_links"))
    classes = components(links, "node", "hub").withColumnRenamed("root", "_class")
    named_nodes = nodes.select("node", "copies", "_least", "_digest").join(classes, "node", "left")
    least = (
        named_nodes.where("_class IS NOT NULL").groupBy("_class").agg(F.min("_least").alias("_class_least"))
    )
    told = (
        named_nodes.join(counts, "node", "left")
        .join(least, "_class", "left")
        .select(
            "_digest",
            F.when(F.col("_class").isNull(), F.col("_least")).otherwise(F.col("_class_least")).alias("_stands"),
            (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
        )
    )
    return (
        rows.drop("_bands")
        .join(told, "_digest", "left")
        .withColumn("class_id", F.when(F.col("_digest").isNull(), F.col(key)).otherwise(F.col("_stands.key")))
        .withColumn("n_links", F.coalesce("_n", F.lit(0)))
        .withColumn("stands", F.col("_digest").isNull() | (F.col("_stands.row") == F.col("_row")))
        .drop("_row", "_digest", "_stands", "_n")
    )
