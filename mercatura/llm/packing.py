"""Packing token sequences into windows by best fit decreasing.

A document's tokens, with an end token, are first cut into full windows; what is left over, shorter
than a window, is one piece. Best fit decreasing puts the longest piece first, each into the tightest
open window that holds it. A segment tree indexed by remaining capacity finds that window.

Windows of equal remaining capacity are as good as one another, and so are pieces of equal length. So
the tree's leaves hold runs of alike windows, and a run takes as many pieces of one length at once as
best fit would give it one after the other. The whole plan follows from the number of pieces of
each length: the driver sees at most one number for each length, whatever the number of documents, and
gives back rules (length, ranks, first window, offset). Ranks within a length are running counts.

Documents of an unlucky length, such as a little over half a window, leave windows half empty. The
contents of windows with more than ``ROOM`` tokens to spare are therefore packed anew, cut at powers of
two: first into the rooms left elsewhere, then into new windows, which powers of two fill without waste.
The last window is cut into sequences of powers of two, which need no padding.

A piece's checksum is made where its tokens are, and so are those of the cuts it may get. Only numbers
are shuffled; no token and no text is.

Edge cases: a NULL or empty text is the end token alone; texts are taken whole; rows equal in key and
text are packed each for itself; a NULL key is a key like others; an empty table gives no rows; columns
other than key and text are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm.bpe import byte_symbols
from mercatura.llm.running import with_running_sums
from mercatura.session import checkpointed

WINDOW = 2048
END = 1
# Tokens that a window may have to spare before its contents are cut and packed anew.
ROOM = 16
# Different pieces of text whose ids a task keeps.
CACHED_WORDS = 800_000
WORDS_AT_ONCE = 1000
TEXTS_AT_ONCE = 500

# str.split() also cuts at these four, which the tokenizer takes for characters like others.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile(r"[^\S\x1c-\x1f]+")
# Latin letters that Unicode has had for long, without the one whose lower case is two characters.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_PLAIN = re.compile(f"[{_LETTERS}]+")
# Marks that end a word, unless they stand side by side with another.
_MARKS = ".,;:!?"
_UNUSUAL = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027]|_|[^\\w\\s][^\\w\\s]")


# Tokens ----------------------------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class _Places(dict):
    """The number of each word, given when it is first asked for."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Ids:
    """The ids of texts, by the ``tokenizers`` library, which sees each different word once.

    The vocabulary cuts at white space before anything else, so words can be encoded apart. Where it
    lower-cases and cuts off punctuation, texts of plain letters are lower-cased and cut that way first,
    which leaves fewer different words. Many words are handed over at once: plain ones with a space
    between them, as each ends with one symbol that ends a word, others with a special token.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS) -> None:
        self._of, self._cached = _tokenizer(path), cached
        added = self._of.get_added_tokens_decoder()
        plain = [
            (number, t.content)
            for number, t in added.items()
            if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)
        ]
        self._between = max(plain, default=None)
        self._special = [t.content for t in added.values()]
        self._ends = self._word_ends()
        self._bytes, self._symbols = self._of, {}
        same = self._encoded(["Ab", "ab"])
        self._marks = [m for m in _MARKS if len({*map(tuple, self._encoded([f"ab{m} 7{m}", f"ab {m} 7 {m}"]))}) == 1]
        self._simple = self._ends is not None and same[0] == same[1] and bool(self._marks)
        if self._simple:
            self._skip_cutting()
        self._forget()

    def _word_ends(self) -> np.ndarray | None:
        """Which ids end a word, if the vocabulary has a mark for that."""
        model = json.loads(self._of.to_str())["model"]
        mark = model.get("end_of_word_suffix")
        if not mark:
            return None
        out = np.zeros(self._of.get_vocab_size(), bool)
        for symbol, number in model["vocab"].items():
            out[number] = symbol.endswith(mark)
        return out

    def _skip_cutting(self) -> None:
        """Plain letters, once in lower case, need no more than their bytes' symbols and a cut at spaces."""
        spec = json.loads(self._of.to_str())
        cut = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
        lean = type(self._of).from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": cut}))
        symbols = {b: c for b, c in enumerate(byte_symbols()) if b > 127}
        probe = "ab zz \u00e9t\u00e9 \u024f\u00df"
        if lean.encode(probe.encode().decode("latin-1").translate(symbols)).ids == self._encoded([probe])[0]:
            self._bytes, self._symbols = lean, symbols

    def _plain_ids(self, words: list[str]) -> list[int]:
        text = " ".join(words).lower()
        if self._symbols:
            text = text.encode().decode("latin-1").translate(self._symbols)
        return self._bytes.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _forget(self) -> None:
        self._places = _Places()
        self._flat, self._used = np.zeros(1 << 16, np.uint32), 0
        self._starts, self._sizes = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._of.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not self._simple or _UNUSUAL.search(text):
            return [w for w in _SPACE.split(text) if w] if _NOT_SPACE.search(text) else text.split()
        text = text.lower()
        for mark in self._marks:
            if mark in text:
                text = text.replace(mark + " ", f" {mark} ").replace(mark + "\n", f" {mark}\n")
                if text[-1] == mark:
                    text = f"{text[:-1]} {mark}"
        return text.split()

    def _put(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        total = self._used + len(flat)
        if total > len(self._flat):
            self._flat = np.concatenate([self._flat, np.zeros(total, np.uint32)])
        self._flat[self._used : total] = flat
        at = np.array([self._places[w] for w in words], np.int64)
        self._sizes[at] = sizes
        self._starts[at] = self._used + np.cumsum(sizes) - sizes
        self._used = total

    def _apart(self, words: list[str]) -> None:
        alone = [w for w in words if not self._between or any(s in w for s in self._special)]
        if alone:
            ids = self._encoded(alone)
            self._put(alone, np.array(list(chain.from_iterable(ids)), np.uint32), np.array(list(map(len, ids)), np.int64))
            words = [w for w in words if w not in {*alone}]
        for at in range(0, len(words), WORDS_AT_ONCE):
            own = words[at : at + WORDS_AT_ONCE]
            number, mark = self._between
            (ids,) = self._encoded([mark.join(own) + mark])
            found = np.array(ids, np.int64)
            self._put(own, found[found != number], np.diff(np.flatnonzero(found == number), prepend=-1) - 1)

    def _learn(self) -> None:
        new, self._places.new = self._places.new, []
        known = len(self._places)
        if known > len(self._sizes):
            self._starts, self._sizes = (np.resize(x, 2 * known) for x in (self._starts, self._sizes))
        plain, other = [], []
        for word in new:
            (plain if self._simple and _PLAIN.fullmatch(word) else other).append(word)
        for at in range(0, len(plain), WORDS_AT_ONCE):
            own = plain[at : at + WORDS_AT_ONCE]
            found = np.array(self._plain_ids(own), np.int64)
            ends = np.flatnonzero(self._ends[found])
            if len(ends) == len(own) and ends[-1] == len(found) - 1:
                self._put(own, found, np.diff(ends, prepend=-1))
            else:
                other += own
        self._apart(other)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self._places) > self._cached:
            self._forget()
        place = self._places.__getitem__
        rows = [np.array(list(map(place, self._cut(t))), np.int64) for t in texts]
        self._learn()
        out = []
        for at in rows:
            sizes = self._sizes[at]
            first = np.cumsum(sizes) - sizes
            out.append(self._flat[np.arange(int(sizes.sum())) + np.repeat(self._starts[at] - first, sizes)])
        return out


@lru_cache(maxsize=1)
def ids_of(path: str) -> Ids:
    """One for a Python worker, whose tasks share what it knows of words, up to ``CACHED_WORDS``."""
    return Ids(path)


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pieces(docs: DataFrame, key: str, text: str, vocabulary_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """``key, start, length, crc, tokens`` and ``crcs`` (of the cuts at powers of two, for pieces shorter
    than a window). ``vocabulary_path`` must exist on every worker."""
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("key", kind),
            *(T.StructField(c, T.LongType()) for c in ("start", "length", "crc", "tokens")),
            T.StructField("crcs", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(vocabulary_path)
        last = np.array([end], np.uint32)
        for whole in batches:
            for first in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(first, TEXTS_AT_ONCE)
                owner, start, length, crc, tokens, crcs = [], [], [], [], [], []
                for row, found in enumerate(encode(batch.column(1).to_pylist())):
                    raw = memoryview(np.concatenate([found, last]).astype("<u4").tobytes())
                    n = len(raw) // 4
                    for at in range(0, n, window):
                        size = min(window, n - at)
                        own, cuts = raw[4 * at : 4 * (at + size)], []
                        if size < window:
                            to = 0
                            for part in powers(size):
                                cuts.append(zlib.crc32(own[4 * to : 4 * (to + part)]))
                                to += part
                        owner.append(row)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(own))
                        tokens.append(n)
                        crcs.append(cuts)
                keys = batch.column(0).take(pa.array(owner, pa.int64()))
                longs = [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
                yield pa.RecordBatch.from_arrays(
                    [keys, *longs, pa.array(crcs, pa.list_(pa.int64()))], names=schema.names
                )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


# The plan --------------------------------------------------------------------------------------------


class Capacities:
    """A segment tree over remaining capacities; a leaf holds the runs ``(first window, windows)`` that
    have this much room."""

    def __init__(self, window: int) -> None:
        self._width = 1
        while self._width <= window:
            self._width *= 2
        self._any = [False] * (2 * self._width)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, room: int) -> None:
        node = self._width + room
        self._any[node] = bool(self.runs.get(room))
        while node > 1:
            node //= 2
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length``."""
        node = self._width + length
        if self._any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self._any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self._width:
            node = 2 * node if self._any[2 * node] else 2 * node + 1
        return node - self._width

    def open(self, room: int, first: int, windows: int) -> None:
        if windows:
            self.runs.setdefault(room, []).append((first, windows))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run


# length, ranks from and to, first window, pieces a window takes, offset of the first of them.
Rule = tuple[int, int, int, int, int, int]


def best_fit(counts: Mapping[int, int], tree: Capacities, opened: int, window: int) -> tuple[list[Rule], int]:
    """Where pieces go, ``counts[length]`` of each length, and the number of windows opened until then.

    Same as putting them in one by one, longest first, each into the tightest window of the tree.
    """
    rules: list[Rule] = []
    for length in sorted((n for n, many in counts.items() if many), reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                each = window // length
                first, windows, room = opened, -(-left // each), window
                opened += windows
            else:
                first, windows = tree.take(room)
            # A window that took one stays the tightest as long as it holds another.
            each = room // length
            full = min(windows, left // each)
            offset = window - room
            if full:
                rules.append((length, rank, rank + full * each, first, each, offset))
                tree.open(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = windows - full
            if rest and left and left < each:
                rules.append((length, rank, rank + left, first + full, left, offset))
                tree.open(room - left * length, first + full, 1)
                rank, left, full, rest = rank + left, 0, full + 1, rest - 1
            tree.open(room, first + full, rest)
    return rules, opened


def is_power(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


def split_at(rules: list[Rule], runs: list[tuple[int, int]]) -> list[tuple[Rule, bool]]:
    """The rules, cut where runs of windows begin and end, and whether each part is within a run."""
    firsts = np.array([first for first, _ in runs], np.int64)
    ends = np.array([first + many for first, many in runs], np.int64)
    out = []
    for length, low, high, first, each, offset in rules:
        stop = first + (high - low) // each
        at = first
        # The runs are sorted and apart.
        for i in range(int(np.searchsorted(ends, first, side="right")), len(runs) + 1):
            begin, end = (int(firsts[i]), int(ends[i])) if i < len(runs) else (stop, stop)
            for to, inside in ((min(begin, stop), False), (min(end, stop), True)):
                if to > at:
                    part = (length, low + (at - first) * each, low + (to - first) * each, at, each, offset)
                    out.append((part, inside))
                    at = to
            if at >= stop:
                break
    return out


def plan(
    counts: Mapping[int, int], window: int = WINDOW, room: int = ROOM
) -> tuple[list[tuple[Rule, bool]], list[Rule], tuple[int, int] | None]:
    """Rules for whole pieces, each with whether they are cut at powers of two; rules for these cuts;
    and the last window with its number of tokens, if it is to be cut into powers of two."""
    tree = Capacities(window)
    rules, opened = best_fit(counts, tree, 0, window)
    loose = {r for r in tree.runs if r > room and not is_power(window - r)}
    runs = sorted(chain.from_iterable(tree.runs[r] for r in loose))
    parts = split_at(rules, runs)
    cuts: dict[int, int] = {}
    for (length, low, high, *_), inside in parts:
        for power in powers(length) if inside else ():
            cuts[power] = cuts.get(power, 0) + high - low
    left = Capacities(window)
    for r, those in tree.runs.items():
        if 0 < r <= room:
            for first, many in those:
                left.open(r, first, many)
    again, total = best_fit(cuts, left, opened, window)
    last = None
    if total > opened:
        (spare,) = [r for r, those in left.runs.items() if (total - 1, 1) in those] or [0]
        if spare:
            last = (total - 1, window - spare)
    return parts, again, last


# Packing ---------------------------------------------------------------------------------------------

_RULE = "length long, low long, high long, first long, each long, at long, cut boolean"


def _placed(ranked: DataFrame, rules: list[tuple]) -> DataFrame:
    """``sequence_id`` and ``offset`` of ranked pieces. There are as many rules as runs of alike windows,
    which the number of lengths bounds."""
    table = F.broadcast(ranked.sparkSession.createDataFrame(rules, _RULE))
    rank = F.col("_sum_one") - 1
    found = ranked.join(table, "length").where((rank >= F.col("low")) & (rank < F.col("high")))
    nth = rank - F.col("low")
    return found.withColumns(
        {
            "sequence_id": F.col("first") + F.floor(nth / F.col("each")),
            "offset": F.col("at") + nth % F.col("each") * F.col("length"),
        }
    ).drop("_sum_one", "low", "high", "first", "each", "at")


def pack(
    docs: DataFrame,
    vocabulary_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end: int = END,
    room: int = ROOM,
) -> DataFrame:
    """One row for each piece: ``key, start, length, crc, tokens, sequence_id, offset``.

    ``start`` counts the document's tokens before the piece, ``tokens`` all of them, ``crc`` is the
    CRC-32 of the piece's ids as little-endian 32-bit numbers.
    """
    if not is_power(window):
        raise ValueError("a window is a power of two")
    cut = pieces(docs, key, text, vocabulary_path, window, end)
    rows = checkpointed(cut.withColumns({"row": F.monotonically_increasing_id(), "one": F.lit(1).cast("long")}))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    first, again, last = plan(counts, window, room)
    ranked = _placed(with_running_sums(rows, "length", ["row"], ["one"]), [(*rule, inside) for rule, inside in first])
    ready = ["key", "start", "length", "crc", "tokens", "sequence_id", "offset"]
    whole = ranked.where("NOT cut").select(*ready)

    numbers = F.array(*[F.lit(1 << b).cast("long") for b in range(window.bit_length() - 2, -1, -1)])
    own = F.filter(numbers, lambda p: F.col("length").bitwiseAND(p) != 0)
    opened = ranked.where("cut").select(
        "key", "start", "length", "tokens", "row", "one", F.explode(F.arrays_zip(own.alias("p"), F.col("crcs").alias("c"))).alias("_cut")
    )
    power = F.col("_cut.p")
    small = opened.select(
        "key",
        (F.col("start") + F.col("length") - F.col("length") % (2 * power)).alias("start"),
        power.alias("length"),
        F.col("_cut.c").alias("crc"),
        "tokens",
        "row",
        "one",
    )
    # The start tells the cuts of one piece apart.
    summed = with_running_sums(checkpointed(small), "length", ["row", "start"], ["one"])
    refilled = _placed(summed, [(*rule, False) for rule in again]).select(*ready)
    if last:
        number, tokens = last
        at = 0
        sequence, offset = F.col("sequence_id"), F.col("offset")
        for n, size in enumerate(powers(tokens)):
            inside = (F.col("sequence_id") == number) & (F.col("offset") >= at)
            sequence = F.when(inside, F.lit(number + n).cast("long")).otherwise(sequence)
            offset = F.when(inside, F.col("offset") - at).otherwise(offset)
            at += size
        refilled = refilled.withColumns({"sequence_id": sequence, "offset": offset})
    return whole.unionByName(refilled).withColumnRenamed("key", key)
