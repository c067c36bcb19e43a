"""Packing against one-by-one best fit decreasing and against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus_fixtures import store, table  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercatura.llm import packing
from mercatura.llm import queries as Q

PATH = str(public_tokenizers.path(Q.VOCABULARY))
ODD_TEXTS = [
    None,
    "",
    "  \n\t ",
    "a\x1cb \x1f c\u0085d e　f",
    "<|endoftext|>x <|startoftext|> <|endoftext|",
    "é é ́x ΑΣ Σ İ İx ŉ K Ǆ ǅ ſ ɏ, Élan; élan ..",
    "it's 'S don't 12 x² Foo, foo. FOO! , . a,b",
    "a" * 9000,
    "one two three " * 3000,
]


def library_ids(texts):
    of = Tokenizer.from_file(PATH)
    of.no_truncation()
    of.no_padding()
    return [of.encode(t or "", add_special_tokens=False).ids for t in texts]


def one_by_one(lengths, window):
    """Contents of the windows that best fit decreasing makes."""
    windows = []
    for n in sorted(lengths, reverse=True):
        fits = [w for w in windows if window - sum(w) >= n]
        if fits:
            max(fits, key=sum).append(n)
        else:
            windows.append([n])
    return windows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_rules_are_best_fit_decreasing(lengths):
    tree = packing.Capacities(32)
    rules, opened = packing.best_fit(Counter(lengths), tree, 0, 32)
    got = defaultdict(list)
    ranks = defaultdict(list)
    for length, low, high, first, each, at in rules:
        for rank in range(low, high):
            window, nth = first + (rank - low) // each, (rank - low) % each
            got[window].append((at + nth * length, length))
            ranks[length].append(rank)
    for length, many in Counter(lengths).items():
        assert sorted(ranks[length]) == list(range(many))
    assert len(got) == opened
    for placed in got.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 32
    want = one_by_one(lengths, 32)
    # Windows with the same room are as good as one another, so only their fill can be compared.
    assert Counter(sum(n for _, n in p) for p in got.values()) == Counter(map(sum, want))


def test_tree_gives_the_tightest_room():
    rng = random.Random(1)
    tree, rooms = packing.Capacities(64), set()
    for _ in range(500):
        if rooms and rng.random() < 0.5:
            room = rng.choice(sorted(rooms))
            tree.take(room)
            rooms.remove(room)
        else:
            room = rng.randrange(65)
            if room not in rooms:
                tree.open(room, 0, 1)
                rooms.add(room)
        for length in range(65):
            assert tree.tightest(length) == min((r for r in rooms if r >= length), default=None)


def test_ids_are_those_of_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = ODD_TEXTS + [r["text"] for r in rows]
    want = library_ids(texts)
    assert [x.tolist() for x in packing.Ids(PATH)(texts)] == want
    # A cache that is always full, and other vocabularies.
    assert [x.tolist() for x in packing.Ids(PATH, cached=0)(texts[:9])] == want[:9]
    assert [x.tolist() for x in packing.Ids(PATH, cached=0)(texts[:9])] == want[:9]


def check_packing(got, texts, window=2048):
    """Everything that must hold, whatever the way of packing; gives the share of padding."""
    ids = [[*x, packing.END] for x in library_ids(t for _, t in texts)]
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    want = Counter()
    for (key, _), own in zip(texts, ids, strict=True):
        want[key] += len(own)
    assert {k: sum(r["length"] for r in rs) for k, rs in pieces.items()} == dict(want)
    if len({k for k, _ in texts}) == len(texts):
        for (key, _), own in zip(texts, ids, strict=True):
            at = 0
            for r in sorted(pieces[key], key=lambda r: r["start"]):
                part = own[at : at + r["length"]]
                assert (r["start"], r["doc_tokens"]) == (at, len(own)) and r["length"] > 0
                assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
                at += r["length"]
            assert at == len(own)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if packing.is_power(at) else window - at
    return padding / max(1, sum(map(len, ids)))


def test_query_on_a_sample(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = Q.op13_packing(spark, sf)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check_packing(got.collect(), [(r["doc_id"], r["text"]) for r in docs]) < 0.005


@pytest.mark.parametrize("words", [1100, 700, 2047, 2048, 1])
def test_unlucky_lengths_leave_no_room(table, words):
    texts = [(i, " ".join(["a"] * words)) for i in range(60)]
    got = packing.pack(table(texts, "doc_id long, text string"), PATH)
    got = got.withColumnsRenamed({"crc": "ids_crc32", "tokens": "doc_tokens"}).collect()
    assert check_packing(got, texts) <= packing.ROOM / (2048 - packing.ROOM)


def test_odd_rows(table):
    texts = [*enumerate(ODD_TEXTS), (None, "a b"), (None, None), (7, "a b"), (7, "a b")]
    rows = [(k, t, 1, "x", 2) for k, t in texts]
    df = table(rows, "doc_id long, text string, length int, crc string, _sum_one long")
    got = packing.pack(df, PATH)
    assert got.columns == ["doc_id", "start", "length", "crc", "tokens", "sequence_id", "offset"]
    check_packing(got.withColumnsRenamed({"crc": "ids_crc32", "tokens": "doc_tokens"}).collect(), texts)
    assert packing.pack(df.limit(0), PATH).collect() == []
    named = packing.pack(df.selectExpr("cast(doc_id AS string) AS name", "text AS body"), PATH, key="name", text="body")
    assert named.columns[0] == "name" and named.count() >= len(texts)


def test_running_sums(table):
    from mercatura.llm.running import with_running_sums

    rng = random.Random(3)
    # Half of all rows are in one group, which several tasks share.
    data = [(rng.choice([7, 7, 7, *range(3)]), i, rng.randrange(9)) for i in range(4000)]
    rng.shuffle(data)
    df = table(data, "g long, i long, x long").repartition(3)
    sums, want = defaultdict(int), {}
    for g, i, x in sorted(data):
        sums[g] += x
        want[g, i] = sums[g]
    got = {(r["g"], r["i"]): r["_sum_x"] for r in with_running_sums(df, "g", ["i"], ["x"]).collect()}
    assert got == want
    assert with_running_sums(df.limit(0), "g", ["i"], ["x"]).collect() == []
