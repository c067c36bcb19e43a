"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree are its adjacent symbol pairs, each worth ``rank * width + place`` or
a value above all if the pair never merges. The root is then the leftmost pair of lowest rank.
Merging it changes three leaves, and each change walks up the tree once. The word is done when
the root holds no pair.

Short words of a batch are merged side by side, one numpy row per word; a long word has a tree
of its own. Words are looked up in a bounded cache before that.

Edge cases: a NULL or blank text gives no ids and the empty string; texts are taken whole; equal
rows give equal results; all other columns pass through untouched.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Words of up to so many bytes are merged side by side, longer ones one by one.
ROW_WIDTHS = (8, 16, 32)
# Words kept by a task: two generations of this many.
CACHED_WORDS = 60_000
ENCODED_ROWS_PER_BATCH = 1_000

# What the tokenizer file's white space pattern covers, and what str.split() cuts besides.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_EXTRA_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that byte-level BPE writes for each of the 256 bytes."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and word pattern of a ``tokenizers`` file with word-end symbols."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + end] for s in symbols], np.int64)
        self.text = {number: symbol for symbol, number in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text.update({number: symbol for symbol, number in self.special.items()})
        self.special_pattern = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        (split,) = (
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.words = regex.compile(split)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in map(_pair, model["merges"])]
        self.merged = np.array([new for _, _, new in pairs], np.int64)
        self.rank = {(a, b): rank for rank, (a, b, _) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self.never = len(pairs)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``never`` for those that don't merge. Negative: no symbol."""
        keys = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self._keys, keys), self.never - 1)
        known = (self._keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(known, self._ranks[at], self.never)


def _pair(merge: str | Sequence[str]) -> Sequence[str]:
    return merge.split(" ") if isinstance(merge, str) else merge


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _symbols(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The start symbols of all words, one after the other, and the number of each word's."""
    raw = [w.encode("utf-8", "replace") for w in words]
    sizes = np.array(list(map(len, raw)), np.int64)
    joined = np.frombuffer(b"".join(raw), np.uint8)
    out = vocab.inner[joined]
    ends = np.cumsum(sizes) - 1
    out[ends] = vocab.last[joined[ends]]
    return out, sizes


def merge_long(vocab: Vocabulary, start: Sequence[int]) -> list[int]:
    """One word by a tree of its own: ``size - 1`` merges at most, each logarithmic."""
    symbols, size = list(map(int, start)), len(start)
    width = 1
    while width < size:
        width *= 2
    above = (vocab.never + 1) * width
    rank, merged = vocab.rank, vocab.merged
    tree = [above] * (2 * width)
    for i in range(size - 1):
        r = rank.get((symbols[i], symbols[i + 1]))
        if r is not None:
            tree[width + i] = r * width + i
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))

    def put(place: int, value: int) -> None:
        node = width + place
        tree[node] = value
        node //= 2
        while node:
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least
            node //= 2

    def pair(left: int, right: int) -> int:
        r = rank.get((symbols[left], symbols[right]))
        return above if r is None else r * width + left

    while tree[1] < above:
        r, place = divmod(tree[1], width)
        gone = after[place]
        follow = after[gone]
        symbols[place] = int(merged[r])
        symbols[gone] = -1
        after[place] = follow
        put(gone, above)
        if follow < size:
            before[follow] = place
            put(place, pair(place, follow))
        else:
            put(place, above)
        if before[place] >= 0:
            put(before[place], pair(before[place], place))
    return [s for s in symbols if s >= 0]


def merge_rows(
    vocab: Vocabulary, start: np.ndarray, sizes: np.ndarray, width: int
) -> list[list[int]]:
    """Words of at most ``width`` symbols, one tree per row, all merged in step."""
    # One column more on either side stands for "no symbol".
    n = len(sizes)
    symbols = np.full((n, width + 2), -1, np.int64)
    rows = np.repeat(np.arange(n), sizes)
    places = np.arange(len(start)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[rows, places + 1] = start
    above = (vocab.never + 1) * width
    tree = np.full((n, 2 * width), above, np.int64)
    first = vocab.ranks(symbols[:, 1 : width + 1], symbols[:, 2 : width + 2])
    leaves = first * width + np.arange(width)
    tree[:, width:] = np.where(first < vocab.never, leaves, above)
    level = width // 2
    while level:
        tree[:, level : 2 * level] = np.minimum(
            tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
        )
        level //= 2
    after = np.tile(np.arange(1, width + 3), (n, 1))
    before = np.tile(np.arange(-1, width + 1), (n, 1))
    after[np.arange(n), sizes] = width + 1

    def put(at: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        node = width + place
        tree[at, node] = value
        node = node >> 1
        while node[0]:
            tree[at, node] = np.minimum(tree[at, 2 * node], tree[at, 2 * node + 1])
            node = node >> 1

    def value(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        r = vocab.ranks(symbols[at, left], symbols[at, right])
        return np.where(r < vocab.never, r * width + left - 1, above)

    at = np.flatnonzero(tree[:, 1] < above)
    while len(at):
        r, place = np.divmod(tree[at, 1], width)
        place = place + 1
        gone = after[at, place]
        follow = after[at, gone]
        symbols[at, place] = vocab.merged[r]
        symbols[at, gone] = -1
        after[at, place] = follow
        before[at, follow] = place
        put(at, gone - 1, np.full(len(at), above))
        put(at, place - 1, value(at, place, follow))
        prior = before[at, place]
        has = prior > 0
        if has.any():
            put(at[has], prior[has] - 1, value(at[has], prior[has], place[has]))
        at = at[tree[at, 1] < above]
    body = symbols[:, 1 : width + 1]
    kept = body >= 0
    flat = body[kept].tolist()
    ends = np.cumsum(kept.sum(axis=1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Encoder:
    """Ids and decoded text of texts, a batch at a time, with a bounded word cache."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS) -> None:
        self.vocab = vocabulary(path)
        self._young: dict[str, tuple[tuple[int, ...], str]] = {}
        self._old: dict[str, tuple[tuple[int, ...], str]] = {}
        self._size = cached_words

    def _pieces(self, text: str | None) -> list[str]:
        """White-space free pieces; special tokens are pieces of their own, after a space."""
        if not text:
            return []
        out: list[str] = []
        for i, part in enumerate(self.vocab.special_pattern.split(text)):
            if i % 2:
                out.append(" " + part)
                continue
            # Lower-casing is by character: no final sigma.
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            if _EXTRA_SPACE.search(part):
                out += [p for p in _SPACE.split(part) if p]
            else:
                out += part.split()
        return out

    def _merge(self, words: list[str]) -> dict[str, list[int]]:
        start, sizes = _symbols(self.vocab, words)
        first = np.cumsum(sizes) - sizes
        of: dict[str, list[int]] = {}
        above = 0
        for width in ROW_WIDTHS:
            here = (sizes > above) & (sizes <= width)
            above = width
            if here.any():
                ids = merge_rows(self.vocab, start[np.repeat(here, sizes)], sizes[here], width)
                of.update(zip([words[i] for i in np.flatnonzero(here)], ids, strict=True))
        for i in np.flatnonzero(sizes > above):
            of[words[i]] = merge_long(self.vocab, start[first[i] : first[i] + sizes[i]])
        return of

    def _learn(self, pieces: list[str]) -> dict[str, tuple[tuple[int, ...], str]]:
        vocab, special = self.vocab, self.vocab.special
        cut = {
            p: [] if p[0] == " " else vocab.words.findall(p) for p in pieces
        }
        words = list(dict.fromkeys(chain.from_iterable(cut.values())))
        of = self._merge(words) if words else {}
        found = {}
        for p, own in cut.items():
            if p[0] == " ":
                all_ids: tuple[int, ...] = (special[p[1:]],)
            else:
                all_ids = tuple(chain.from_iterable(of[w] for w in own))
            found[p] = (all_ids, " ".join(map(vocab.text.__getitem__, all_ids)))
        return found

    def encode(self, texts: Sequence[str | None]) -> list[tuple[list[int], str]]:
        # Millions of small tuples and no cycles: collecting garbage would only cost time.
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: Sequence[str | None]) -> list[tuple[list[int], str]]:
        cut = [self._pieces(t) for t in texts]
        young, old = self._young, self._old
        seen = set(chain.from_iterable(cut))
        batch = {}
        missing = []
        for p in seen:
            got = young.get(p) or old.get(p)
            if got is None:
                missing.append(p)
            else:
                batch[p] = got
        for start in range(0, len(missing), 20_000):
            batch.update(self._learn(missing[start : start + 20_000]))
        for p, got in batch.items():
            if len(p) <= ROW_WIDTHS[-1]:
                young[p] = got
        if len(young) > self._size:
            self._old, self._young = young, {}
        out = []
        for pieces in cut:
            got = [batch[p] for p in pieces]
            ids = list(chain.from_iterable([g[0] for g in got]))
            out.append((ids, " ".join([g[1] for g in got if g[1]])))
        return out


def encode(
    df: DataFrame,
    text: str,
    vocabulary_path: str,
    *,
    ids: str = "ids",
    decoded: str = "decoded",
) -> DataFrame:
    """Add the ids of ``text`` (array of int) and the text that decoding them gives.

    ``vocabulary_path`` must exist on every worker. The result names replace columns of ``df``
    of the same name, except ``text`` itself, which they must not be.
    """
    if text in (ids, decoded):
        raise ValueError("the results need names other than the text's")
    kept = [c for c in df.columns if c not in (ids, decoded)]
    schema = T.StructType(
        [
            *(f for f in df.schema.fields if f.name in kept),
            T.StructField(ids, T.ArrayType(T.IntegerType())),
            T.StructField(decoded, T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the task alone: a reused worker would hold the cache for as long as it lives.
        encoder = Encoder(vocabulary_path)
        for whole in batches:
            for start in range(0, whole.num_rows, ENCODED_ROWS_PER_BATCH):
                batch = whole.slice(start, ENCODED_ROWS_PER_BATCH)
                done = encoder.encode(batch.column(text).to_pylist())
                ends = np.cumsum([0, *(len(i) for i, _ in done)], dtype=np.int32)
                flat = np.fromiter(chain.from_iterable(i for i, _ in done), np.int32, ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in kept),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array([d for _, d in done], pa.string()),
                    ],
                    [*kept, ids, decoded],
                )

    return df.select(*kept).mapInArrow(run, schema)


def decode_ids(ids: Sequence[int], vocabulary_path: str) -> str:
    """What the tokenizer file's decoding makes of ids: it names no decoder, so the symbols
    stand with a space between them."""
    return " ".join(map(vocabulary(vocabulary_path).text.__getitem__, ids))
