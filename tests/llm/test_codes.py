"""Vector codes against plain versions."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import rows
from corpus_fixtures import table  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercatura.llm import codes
from mercatura.llm import queries as Q

INF, NAN = float("inf"), float("nan")


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(1, 30), st.integers(0, 9))
def test_orchard_finds_the_nearest_entry(size, width, spread, seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (3, size, width))
    vectors = rng.integers(-2 * spread, 2 * spread + 1, (50, 3 * width))
    code, error = codes.Codebooks.of(entries).nearest(vectors)
    apart = ((vectors.reshape(50, 3, 1, width) - entries[None]) ** 2).sum(axis=3)
    # argmin takes the first of equals, which is the lower number.
    assert (code == apart.argmin(axis=2)).all() and (error == apart.min(axis=2)).all()


def plain(data, parts, size, rounds):
    """(key, vector) with finite numbers only -> codes, errors, entries."""
    whole = [(k, [int(np.floor(256 * x)) for x in v]) for k, v in data]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    books = [[list(c[p]) for c in cut[:size]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for c in cut:
                of[near(c[p], books[p])[1]].append(c[p])
            for i, own in of.items():
                books[p][i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return [(k, [i for _, i in f], sum(d for d, _ in f)) for (k, _), f in zip(whole, found, strict=True)], books


@pytest.mark.parametrize(("n", "size"), [(80, 9), (5, 9)])
def test_codes_are_those_of_a_plain_version(table, n, size):
    rng = np.random.default_rng(n)
    data = [(int(k), [float(x) for x in np.round(rng.normal(size=8), 2)]) for k in rng.integers(0, n, n)]
    data += data[:3] + [(None, [0.0] * 8), (None, [1.0] * 8)]
    df = table(data, "id long, v array<float>").repartition(3)
    books = codes.fit(df, "id", "v", parts=4, entries=size)
    want, entries = plain([(k, np.float32(v).astype(float)) for k, v in data], 4, size, 2)
    assert books.entries.tolist() == entries
    got = codes.encode(df, "v", books)
    assert sorted(map(repr, rows(got.select("id", "code", "error")))) == sorted(map(repr, want))
    back = codes.decode(got, books).collect()
    assert all(r["decoded"] == [x / 256 for p, i in enumerate(r["code"]) for x in entries[p][i]] for r in back)


def test_rows_without_a_whole_vector_go(table):
    good = [0.5, -0.25]
    data = [(1, good, "a"), (2, None, "b"), (3, [None, 1.0], None), (4, [INF, 1.0], "c"), (5, [NAN, 1.0], "d"), (None, good, None)]
    df = table(data, "id long, v array<double>, label string")
    books = codes.fit(df, "id", "v", parts=2)
    got = codes.encode(df, "v", books)
    assert sorted(map(repr, rows(got.select("id", "label", "code", "error")))) == sorted(
        map(repr, [(1, "a", [0, 0], 0), (None, None, [0, 0], 0)])
    )
    empty = df.where("id > 9")
    none = codes.fit(empty, "id", "v", parts=2)
    assert none.entries.size == 0 and codes.encode(empty, "v", none).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        codes.fit(table([(1, [1.0, 2.0]), (2, [1.0])], "id long, v array<double>"), "id", "v", parts=1)
    with pytest.raises(ValueError, match="too large"):
        codes.fit(table([(1, [1e30])], "id long, v array<double>"), "id", "v", parts=1)


def test_other_columns_stay(table):
    names = ["key", "vector", "_vector", "_row", "slot", "code", "error"]
    df = table([(1, "x", 2, 3, 4, 5, 6, [1.0])], ", ".join(f"{n} string" if n == "vector" else f"{n} int" for n in names) + ", v array<float>")
    books = codes.fit(df, "key", "v", parts=1)
    got = codes.encode(df, "v", books)
    assert got.columns == ["key", "vector", "_vector", "_row", "slot", "v", "code", "error"]
    assert rows(got) == [(1, "x", 2, 3, 4, [1.0], [0], 0)]


def test_group_sums_take_nulls_together(table):
    df = table([("a", 1), (None, 2), (None, 5), ("b", 3), ("a", 4)], "g string, x long")
    got = codes.with_group_sum(df, "g", "x", "s")
    assert sorted(map(repr, rows(got))) == sorted(map(repr, [("a", 1, 5), ("a", 4, 5), (None, 2, 7), (None, 5, 7), ("b", 3, 3)]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = Q.op11_vector_codes(spark, sf)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    source = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, entries = plain([(r["vec_id"], r["embedding"]) for r in source], 16, 64, 2)
    text = ",".join(str(x) for book in entries for e in book for x in e)
    done = {r["vec_id"]: r for r in got.collect()}
    sums = defaultdict(int)
    label = {r["vec_id"]: r["label"] for r in source}
    for k, _, error in want:
        sums[label[k]] += error
    for k, code, error in want:
        r = done[k]
        assert (r["code"], r["error"]) == ("".join(f"{c:02x}" for c in code), error)
        assert r["label_error"] == sums[label[k]]
        assert r["codebooks_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert len(done) == len(want) and got.agg(F.sum("error")).first()[0] == sum(sums.values())
