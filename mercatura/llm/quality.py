"""Quality classifier by positive-unlabelled learning.

Only trusted positives and unlabelled web text are learnt from. With the squared loss
``l(f) = (1 - f)^2 / 4`` the non-negative unbiased risk of a linear score,

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1)),

rests on the first and second moments of the features over the two sets alone. One distributed
pass sums those up over all rows, and the risk is then minimised exactly: where the bracket is
negative at the unconstrained minimum, its multiplier is searched until the bracket is zero.

The class prior ``pi`` is estimated from the same sets: at a threshold that negatives hardly ever
pass, the share of unlabelled texts above it is the prior times the share of positives above it.

Features describe the writing only (character classes and their neighbours, word and line
repetition, word shape), never ids, languages or sources.

Edge cases: a NULL text counts as empty; an empty text has features and a score like any other;
labels that contradict each other make a text untrusted; without any positive, scores are the
middle, 0.5; an empty table gives no rows. Repeated rows are scored each; other columns pass through,
whatever their names, and a column ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.session import checkpointed

# Ridge on the mean second moment, and bins of the prior's histogram.
RIDGE = 1e-4
BINS = 400
# Positives that must lie above a threshold for it to count in the prior's estimate.
LEAST_POSITIVE_SHARE = 0.8

# Character classes by byte of the UTF-8 form.
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\f\v",
           "\n", ".", ",", "!?", "\"'`", "()[]{}<>", "|", "#$%&*@~^+=\\", "-_:;/")
OTHER, HIGH = len(_GROUPS), len(_GROUPS) + 1
CLASSES = len(_GROUPS) + 2
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[128:] = HIGH
for _i, _group in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _group]] = _i

STEPS = (0.02, 0.05, 0.1, 0.2, 0.4)
SHAPE_FEATURES = 14
FEATURES = 1 + CLASSES * CLASSES + SHAPE_FEATURES * (1 + len(STEPS))


def _shape(text: str) -> list[float]:
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, m = max(len(words), 1), max(len(lines), 1)
    lower = [w.lower() for w in words]
    again = sum(a == b for a, b in zip(lower, lower[1:], strict=False))
    different = len(set(lower))
    letters = sum(map(str.isalpha, words))
    size = max(len(text), 1)
    raw = text.encode("utf-8", "replace")
    marks = sum(w[-1] in "!%&*#$|" for w in words)
    return [
        again / n,
        1 - different / n,
        1 - len(set(lines)) / m,
        sum(map(str.isupper, words)) / n,
        letters / n,
        marks / n,
        sum(len(w) for w in words) / n / 20,
        sum(len(w) > 14 for w in words) / n,
        sum(map(str.isdigit, text)) / size,
        raw.count(b"://") / n,
        min(len(words), 20) / 20,
        np.log1p(len(words)) / 12,
        1 / m,
        max((len(w) for w in words), default=0) / size,
    ]


def features(texts: list[str | None]) -> np.ndarray:
    """One row of numbers for each whole text."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    out[:, 0] = 1
    pairs = CLASSES * CLASSES
    for row, text in zip(out, texts, strict=True):
        text = text or ""
        classes = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
        if len(classes) > 1:
            seen = np.bincount(classes[:-1].astype(np.int64) * CLASSES + classes[1:], minlength=pairs)
            row[1 : 1 + pairs] = np.sqrt(seen / (len(classes) - 1))
        shape = np.array(_shape(text))
        row[1 + pairs :] = np.concatenate([shape, *(shape > s for s in STEPS)])
    return out


def add_features(df: DataFrame, text: str, name: str = "features") -> DataFrame:
    kept = [c for c in df.columns if c not in (text, name)]
    schema = T.StructType(
        [
            *(f for f in df.schema.fields if f.name in kept),
            T.StructField(name, T.ArrayType(T.FloatType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[kept].copy()
            out[name] = list(features(batch[text].tolist()))
            yield out

    return df.select(*kept, text).mapInPandas(run, schema)


@dataclass(frozen=True)
class Moments:
    """Number of rows, mean, and mean second moment of the features of a set."""

    rows: float
    mean: np.ndarray
    second: np.ndarray


def moments(df: DataFrame, name: str = "features") -> Moments | None:
    """Summed up per partition, then per matrix row; only the matrix reaches the driver."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES, FEATURES))
        seen = False
        for batch in batches:
            for start in range(0, len(batch), 2_000):
                x = np.stack(batch[name].iloc[start : start + 2_000].to_numpy()).astype(np.float64)
                total += x.T @ x
                seen = True
        if seen:
            yield pd.DataFrame({"i": np.arange(FEATURES), "sums": list(total)})

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "sums": [np.sum(rows["sums"].to_list(), axis=0)]})

    schema = "i int, sums array<double>"
    summed = df.select(name).mapInPandas(partial, schema).groupBy("i").applyInPandas(add, schema)
    rows = summed.collect()  # FEATURES rows
    if not rows:
        return None
    matrix = np.zeros((FEATURES, FEATURES))
    for row in rows:
        matrix[row["i"]] = row["sums"]
    # Feature 0 is 1 everywhere, so its row has the count and the sums.
    n = matrix[0, 0]
    return Moments(n, matrix[0] / n, matrix / n)


def minimise(positive: Moments, unlabelled: Moments, prior: float, ridge: float = RIDGE) -> np.ndarray:
    """The weights of least non-negative risk."""
    p, u = positive, unlabelled
    fixed = ridge * np.eye(FEATURES)

    def solve(share: float) -> np.ndarray:
        second = prior * (1 - share) * p.second + share * u.second
        first = prior * (1 + share) * p.mean - share * u.mean
        return np.linalg.solve(second + fixed, first)

    def negative_risk(w: np.ndarray) -> float:
        on_u = 1 + 2 * w @ u.mean + w @ u.second @ w
        on_p = 1 + 2 * w @ p.mean + w @ p.second @ w
        return (on_u - prior * on_p) / 4

    w = solve(1.0)
    if negative_risk(w) >= 0:
        return w
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        if negative_risk(solve(middle)) >= 0:
            low = middle
        else:
            high = middle
    return solve(low)


def scores(df: DataFrame, weights: np.ndarray, features: str = "features", name: str = "score") -> DataFrame:
    """The linear score, moved from -1..1 to 0..1 and cut there."""
    kept = [c for c in df.columns if c != name]
    schema = T.StructType(
        [*(f for f in df.schema.fields if f.name in kept and f.name != features),
         T.StructField(name, T.DoubleType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns=features)
            x = np.stack(batch[features].to_numpy()).astype(np.float64) if len(batch) else None
            out[name] = np.clip((x @ weights + 1) / 2, 0, 1) if len(batch) else []
            yield out

    return df.select(*kept).mapInPandas(run, schema)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """From histograms of a score: the least ratio of the upper tails."""
    p = positive[::-1].cumsum() / max(positive.sum(), 1)
    u = unlabelled[::-1].cumsum() / max(unlabelled.sum(), 1)
    enough = p >= LEAST_POSITIVE_SHARE
    if not enough.any():
        return 0.5
    # One standard error up, so that a tail of few rows does not set the ratio by luck.
    error = np.sqrt(1 / np.maximum(positive[::-1].cumsum()[enough], 1))
    ratio = u[enough] / p[enough] * (1 + error)
    return float(np.clip(ratio.min(), 0.01, 0.99))


def _histogram(df: DataFrame, name: str = "score") -> np.ndarray:
    bins = df.groupBy(F.least(F.floor(F.col(name) * BINS), F.lit(BINS - 1)).alias("bin")).count()
    out = np.zeros(BINS)
    for row in bins.collect():  # BINS rows
        out[row["bin"]] = row["count"]
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    prior: float


def fit(positive: DataFrame, unlabelled: DataFrame, *, prior: float | None = None) -> Model:
    """``positive`` and ``unlabelled`` hold ``features``. Without a prior, it is estimated with
    a first model at an even one."""
    p, u = moments(positive), moments(unlabelled)
    if p is None or u is None:
        return Model(np.zeros(FEATURES), 0.5)
    if prior is None:
        first = minimise(p, u, 0.5)
        prior = estimate_prior(
            _histogram(scores(positive.select("features"), first)),
            _histogram(scores(unlabelled.select("features"), first)),
        )
    return Model(minimise(p, u, prior), prior)


def classify(
    docs: DataFrame, trusted: DataFrame, *, key: str = "doc_id", text: str = "text", prior: float | None = None
) -> DataFrame:
    """Add ``score`` in place of ``text``. ``trusted`` holds the keys of known good texts; all
    of ``docs`` is the unlabelled text."""
    # A column of the name that is used inside gets another one until the end.
    taken = {c.lower() for c in docs.columns}
    clash = [c for c in docs.columns if c.lower() == "features" and c not in (key, text)]
    spare = next(n for n in (f"features_{i}" for i in range(len(taken) + 1)) if n not in taken)
    named = docs.drop("score").withColumnsRenamed({c: spare for c in clash})
    rows = checkpointed(add_features(named, text))
    good = trusted.select(key).distinct()
    positive = rows.join(good, key, "left_semi")
    model = fit(positive, rows, prior=prior)
    return scores(rows, model.weights).withColumnsRenamed({spare: c for c in clash})
