"""The prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import rows
from corpus_fixtures import table  # noqa: F401

from mercatura.llm import queries as Q
from mercatura.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(data):
    """(conv, turn, role, text) -> the rows of all nodes, by walking every path."""
    own = defaultdict(list)
    for conv, turn, role, text in data:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    said = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        leader = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = said.get(leader, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own_cost = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        leaves[path] = sum(leaves[p] for p in children[path]) or 1
        saved[path] = own_cost + sum(saved[p] for p in children[path])
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves[path], saved[path], digest))
    return out


def check(got, data):
    assert got.columns == COLUMNS
    assert sorted(map(repr, rows(got))) == sorted(map(repr, plain(data)))


def conversations(seed, n, words="ab", most=7, step=1):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice([*words, words * 3, "", None]))
        for c in range(0, n * step, step)
        for t in range(rng.randrange(1, most))
    ]


@pytest.mark.parametrize(("seed", "n", "step"), [(1, 60, 1), (2, 150, 7), (3, 3, 100)])
def test_nodes_are_those_of_a_plain_version(table, seed, n, step):
    data = conversations(seed, n, step=step)
    check(trie.trie(table(data, SCHEMA).repartition(3)), data)


def test_odd_rows(table):
    data = [
        # A leader that is absent, turns without a number, ties, repeated rows, negative and NULL ids.
        (205, None, "user", "x"), (205, None, None, "y"), (205, 3, "user", "z"), (205, 3, "user", "z"), (205, 3, "assistant", "a"),
        (-5, 1, "user", "é🙂"), (-105, 1, "user", "é🙂"), (0, 9, "", None), (1, 1, None, None), (1, 2, None, ""), (None, 1, "user", "lost"),
        (300, 1, "u", "ser"), (301, 1, "us", "er"), (302, 1, "u", "ser"), (303, 2, "long", "word " * 20000),
    ]
    check(trie.trie(table(data, SCHEMA)), data)
    assert trie.trie(table(data, SCHEMA).where("turn > 99")).collect() == []
    wide = table([(*r, "n", 1, 2) for r in data], SCHEMA + ", digest string, depth int, conv long")
    check(trie.trie(wide), data)
    named = table(data, "c long, t long, r string, w string")
    check(trie.trie(named, conv="c", turn="t", role="r", text="w"), data)


def test_one_conversation_with_most_turns(spark, table, conf):
    # Its prefixes are shared by several tasks, and its repeated turns are folded.
    conf(spark__sql__shuffle__partitions="7", spark__sql__adaptive__enabled="false")
    data = [(100, t, "user", f"w{t % 5}") for t in range(300)] + [(100, 301, "user", "again")] * 50
    data += [(101, t, "user", f"w{t % 5}") for t in range(310)] + conversations(4, 20)
    check(trie.trie(table(data, SCHEMA)), data)


def test_many_copies_end_in_one_node(table):
    data = [(c, t, "user", "same") for c in range(1000, 4000) for t in range(6)]
    got = trie.trie(table(data, SCHEMA))
    check(got, data)
    assert got.where("depth = 6").first()["n_convs"] == 3000


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    check(Q.op12_prefix_trie(spark, sf), rows(source))
