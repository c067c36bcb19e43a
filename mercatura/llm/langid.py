"""Language identification by fusing evidence in Bayes' rule.

A row's language is judged from four kinds of evidence, each a likelihood or a prior:

- its text, by byte trigrams of the lower-cased letters, with models counted over all labelled
  texts; overlapping trigrams repeat each other, so a text weighs at most as ``TEXT_WEIGHT`` of
  them; ``und`` is a language whose trigrams are all equally likely;
- the language its markup declares, by how often each is declared in texts of each language;
- the suffix of its address, in the same way;
- its host, by the languages of the host's other rows, smoothed by those of the domain, and
  those by all rows.

The last three are counted by grouped aggregation of what text alone says. A row's own share is
taken out of the counts it is judged by. Hosts are joined as one row each, so that a hot host is
summed up on the map side and its rows can be split.

Edge cases: a NULL text counts as empty and says nothing; missing declarations, suffixes and hosts
say nothing; a text without letters is ``und`` whatever else is known, while a page without main text is
judged by all it shows, and one that shows no letters by what else is known; ties go to the language
first in the alphabet; equal rows get equal results; other columns pass through, and columns with
the names of results are replaced. Without labelled text, everything is ``und``.
More than ``MAX_LANGUAGES`` different labels raise ``ValueError``; nothing is lost silently.
Columns with names that are used inside, which begin with an underscore, are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm.mincut import blocks, main_text
from mercatura.session import checkpointed

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
MAX_LANGUAGES = 200
TEXT_WEIGHT = 60.0
# Added to trigram counts, and rows' worth of the level above in each smoothed count.
GRAM_SMOOTHING = 0.1
PRIOR_ROWS = 5.0
EVIDENCE_ROWS = 2.0

# Per row: what its text says, and the counts it meets.
_NUMBERS = ("_text", "_says", "_all", "_by_domain", "_by_host", "_with_suffix", "_with_declared")

_EVIDENCE = ("_by_host", "_with_suffix", "_with_declared")

RESULTS = ("language", "confidence", "text_language", "letters")

_KEEP = np.zeros(256, bool)
_KEEP[0x61:0x7B] = _KEEP[0x80:] = True
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", re.I)


def grams(text: str) -> tuple[np.ndarray, int]:
    """Buckets of all byte trigrams, runs of other characters counting as one space; and the
    number of letter bytes."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    letter = _KEEP[raw]
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # one gap after each run of letters
    codes = np.where(letter, raw, 32)[kept].astype(np.uint32)
    codes = np.concatenate([np.array([32], np.uint32), codes])
    if len(codes) < 3:
        return np.zeros(0, np.int64), int(letter.sum())
    mixed = (codes[:-2] * np.uint32(65536) + codes[1:-1] * np.uint32(256) + codes[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), int(letter.sum())


@dataclass(frozen=True)
class Model:
    """Log probabilities, a row for each trigram bucket, by language; ``und`` comes last."""

    languages: tuple[str, ...]
    logs: np.ndarray

    def likelihoods(self, text: str) -> tuple[list[float], int]:
        at, letters = grams(text)
        if not letters:
            return [0.0] * len(self.languages), 0
        total = self.logs[at].sum(axis=0) * min(1.0, TEXT_WEIGHT / len(at))
        return total.tolist(), letters


def train(labelled: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Count the trigrams of all labelled texts; rows with a NULL label teach nothing."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, _ = grams(value or "")
                if language not in counts:
                    if len(counts) >= MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    counts[language] = np.zeros(BUCKETS, np.int64)
                np.add.at(counts[language], at, 1)
        if counts:
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array(list(counts), pa.string()),
                 "counts": pa.array([c.tolist() for c in counts.values()], pa.list_(pa.int64()))}
            )

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "counts": [np.sum(rows["counts"].to_list(), axis=0)]})

    schema = "label string, counts array<long>"
    chosen = labelled.select(F.col(text), F.lower(F.col(label).cast("string")))
    counted = chosen.where(chosen[1].isNotNull()).mapInArrow(partial, schema)
    rows = counted.groupBy("label").applyInPandas(add, schema).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found = sorted((r["label"], np.array(r["counts"], float)) for r in rows if r["label"] != UNKNOWN)
    logs = [np.log((c + GRAM_SMOOTHING) / (c.sum() + GRAM_SMOOTHING * BUCKETS)) for _, c in found]
    logs.append(np.full(BUCKETS, -np.log(BUCKETS)))
    return Model((*(name for name, _ in found), UNKNOWN), np.ascontiguousarray(np.array(logs).T))


def _says_some(counts: object) -> bool:
    return isinstance(counts, np.ndarray) and counts.sum() > 0


def _softmax(logs: np.ndarray) -> np.ndarray:
    raised = np.exp(logs - logs.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def _smoothed(counts: np.ndarray, above: np.ndarray, rows: float) -> np.ndarray:
    """Shares by language, as if ``rows`` more rows had the shares of the level above."""
    counts = np.maximum(counts, 0)
    return (counts + rows * above) / (counts.sum(axis=1, keepdims=True) + rows)


def _posterior(rows: pd.DataFrame, size: int) -> np.ndarray:
    """Of each row, from its likelihoods and the counts it meets, its own share taken out."""

    def matrix(name: str) -> tuple[np.ndarray, np.ndarray]:
        known = rows[name].notna().to_numpy()
        out = np.zeros((len(rows), size))
        if known.any():
            out[known] = np.stack(rows.loc[known, name].to_numpy())
        return out, known[:, None]

    says, _ = matrix("_says")
    overall = _smoothed(matrix("_all")[0] - says, np.full((len(rows), size), 1 / size), 1.0)
    prior = overall
    for level in ("_by_domain", "_by_host"):
        counts, known = matrix(level)
        prior = np.where(known, _smoothed(counts - says, prior, PRIOR_ROWS), prior)
    logs = matrix("_text")[0] + np.log(prior)
    for evidence in ("_with_suffix", "_with_declared"):
        # P(value | language) is in proportion to P(language | value) / P(language).
        counts, known = matrix(evidence)
        logs += np.where(known, np.log(_smoothed(counts - says, overall, EVIDENCE_ROWS) / overall), 0.0)
    return _softmax(logs)


def _words_of(page: str) -> str:
    """A page's main text, or all it shows if nothing of it is main."""
    return main_text(page) or "\n".join(block.text for block in blocks(page))


def _with_likelihoods(df: DataFrame, model: Model, column: str, markup: bool) -> DataFrame:
    """``_text`` (log likelihoods), ``_says`` and ``letters`` in place of ``column``; from a page's
    main text if it is markup, and then ``_declared`` too.

    ``_says`` is what text alone says: one row's worth, spread over the languages, and nothing
    without letters."""
    kept = [c for c in df.columns if c != column]
    numbers = T.ArrayType(T.DoubleType())
    more = [T.StructField("_text", numbers), T.StructField("_says", numbers), T.StructField("letters", T.LongType())]
    more += [T.StructField("_declared", T.StringType())] * markup
    schema = T.StructType([*(f for f in df.schema.fields if f.name in kept), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v or "" for v in batch.column(column).to_pylist()]
            texts = map(_words_of, values) if markup else values
            done = [model.likelihoods(t) for t in texts]
            arrays = [
                *(batch.column(c) for c in kept),
                pa.array([d[0] for d in done], pa.list_(pa.float64())),
                pa.array([_softmax(np.array(d[0])) * (d[1] > 0) for d in done], pa.list_(pa.float64())),
                pa.array([d[1] for d in done], pa.int64()),
            ]
            if markup:
                found = [_DECLARED.search(v) for v in values]
                arrays.append(pa.array([m and m[1].lower() for m in found], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *(f.name for f in more)])

    return df.select(*kept, column).mapInArrow(run, schema)


def _sums(df: DataFrame, keys: Sequence[str], name: str, size: int) -> DataFrame:
    sums = [F.sum(F.get("_says", F.lit(i))) for i in range(size)]
    return df.groupBy(*keys).agg(F.array(*sums).alias(name))


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def identify(
    df: DataFrame,
    model: Model,
    column: str = "text",
    *,
    markup: bool = False,
    declared: Column | None = None,
    host: Column | None = None,
    suffix: Column | None = None,
) -> DataFrame:
    """Replace ``column`` by ``language``, ``confidence`` (its posterior probability),
    ``text_language`` (by text alone) and ``letters``.

    ``declared``, ``host`` and ``suffix`` are expressions over ``df``; with ``markup``, ``column``
    holds HTML and declares its language itself.
    """
    nothing = F.lit(None).cast("string")
    size = len(model.languages)
    named = df.drop(*RESULTS, "_text", "_declared", "_host", "_suffix", "_says", "_domain")
    given = {"_host": nothing if host is None else host, "_suffix": nothing if suffix is None else suffix}
    if not markup:
        given["_declared"] = nothing if declared is None else F.lower(declared.cast("string"))
    scored = _with_likelihoods(named.withColumns(given), model, column, markup)
    rows = checkpointed(scored.withColumn("_domain", domain_of(F.col("_host"))))

    everything = _sums(rows, [], "_all", size).select(F.col("_all")).scalar()
    hosts = _sums(rows.where("_host IS NOT NULL"), ["_domain", "_host"], "_by_host", size)
    domains = _sums(hosts.withColumnRenamed("_by_host", "_says"), ["_domain"], "_by_domain", size)
    by_host = hosts.join(domains, "_domain").drop("_domain")
    by_suffix = _sums(rows.where("_suffix IS NOT NULL"), ["_suffix"], "_with_suffix", size)
    by_declared = _sums(rows.where("_declared IS NOT NULL"), ["_declared"], "_with_declared", size)
    joined = (
        rows.join(by_host, "_host", "left")
        .join(by_suffix, "_suffix", "left")
        .join(by_declared, "_declared", "left")
        .withColumn("_all", F.coalesce(everything, F.array_repeat(F.lit(0.0), size)))
    )
    kept = [c for c in named.columns if c != column]
    schema = T.StructType(
        [
            *(f for f in named.schema.fields if f.name in kept),
            T.StructField("language", T.StringType()),
            T.StructField("confidence", T.DoubleType()),
            T.StructField("text_language", T.StringType()),
            T.StructField("letters", T.LongType()),
        ]
    )
    names = np.array(model.languages, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Only the numbers become pandas; what passes through stays as it is.
            frame = pa.Table.from_batches([batch]).select([*_NUMBERS, "letters"]).to_pandas()
            judged = frame["letters"].to_numpy() > 0
            if markup:
                # Of a page without letters, what else is known speaks.
                judged |= np.array([[_says_some(v) for v in frame[name]] for name in _EVIDENCE], bool).any(axis=0)
            shares = _posterior(frame, size)
            says = np.stack(frame["_says"].to_numpy()) if len(frame) else np.zeros((0, size))
            spoken = frame["letters"].to_numpy() > 0
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(np.where(judged, names[shares.argmax(axis=1)], UNKNOWN), pa.string()),
                    pa.array(np.where(judged, shares.max(axis=1), 0.0), pa.float64()),
                    pa.array(np.where(spoken, names[says.argmax(axis=1)], UNKNOWN), pa.string()),
                    batch.column("letters"),
                ],
                [*kept, "language", "confidence", "text_language", "letters"],
            )

    return joined.select(*kept, *_NUMBERS, "letters").mapInArrow(run, schema)
