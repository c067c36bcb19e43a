"""The trie of conversation prefixes, by collapsing whole sequences.

Every conversation is rebuilt: its first ``head`` turns are those of the conversation that leads its
hundred, the rest are its own. Identical rebuilt conversations become one weighted sequence with the list of
those that end there. A sequence that is a proper prefix of another goes in an anti-join, which leaves the
trie's leaves. Each sequence's prefixes, weighted, are then summed up by node.

A turn is a digest of its role and text and the text's length; no text is shuffled. A prefix is the sum
of one random number of 128 bits for each place and turn, so that the prefixes of a conversation of any
length are running sums, which many tasks share. A node is depth and sum.

The sum over a subtree needs no walk through it. A node's cost belongs to the one sequence through it
that has the least conversation; a node's subtree then costs what the sequences through it cost in all,
less what the owner of the node has spent above it.

Edge cases: a NULL role or text is empty; a NULL turn comes first; turns of equal number are ordered by
the MD5 of role and text, and rows equal in all are as many turns; rows without a conversation
are no turns of any; an empty table has no nodes, not even a root; texts are taken whole; columns other than
the four named are not looked at, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercatura.llm.running import with_running_sums
from mercatura.session import checkpointed

HEADS = 6
HUNDRED = 100
# Conversations of a list of ends that make one string, and repeated turns that make one array.
_ENDS = 10
_REPEATS = 4096
NODE = ["depth", "n1", "n2"]


def head(conv: Column) -> Column:
    """How many first turns a conversation takes over."""
    return F.crc32(conv.cast("string")) % HEADS


def turns_in_order(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, at`` (1, 2, ...), ``digest, chars`` for each turn."""
    of, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    # The length of the role tells where it ends.
    whole = F.concat(F.char_length(of).cast("string"), F.lit(":"), of, said)
    found = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.char_length(said).cast("long").alias("chars"),
    )
    # Equal rows cannot be told apart, so a range of them would be one task.
    folded = found.groupBy("conv", "turn", "digest").agg(F.min("chars").alias("chars"), F.count(F.lit(1)).alias("many"))
    counted = with_running_sums(checkpointed(folded), "conv", ["turn", "digest"], ["many"])
    last, first = F.col("_sum_many"), F.col("_sum_many") - F.col("many") + 1
    some = counted.select("*", last.alias("last"), F.explode(F.sequence(first, last, F.lit(_REPEATS).cast("long"))).alias("low"))
    each = F.sequence("low", F.least(F.col("low") + _REPEATS - 1, "last"))
    return some.select("conv", F.explode(each).alias("at"), "digest", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns of rebuilt conversations, and a place 0 without a turn for each."""
    sizes = checkpointed(turns.groupBy("conv").agg(F.max("at").alias("n")))
    leader = F.col("conv") - F.col("conv") % HUNDRED
    named = sizes.select("conv", head(F.col("conv")).alias("h"), leader.alias("leader"))
    leaders = sizes.where(leader == F.col("conv")).select(F.col("conv").alias("leader"), F.col("n").alias("lead"))
    heads = checkpointed(
        named.join(leaders, "leader", "left").select(
            "conv", "h", "leader", F.least("h", F.coalesce("lead", F.lit(0))).alias("lead")
        )
    )
    own = (
        turns.join(heads, "conv")
        .where(F.col("at") > F.col("h"))
        .select("conv", (F.col("at") - F.col("h") + F.col("lead")).alias("at"), "digest", "chars")
    )
    # At most so many turns of a leader, for the others of its hundred.
    first = turns.where((leader == F.col("conv")) & (F.col("at") < HEADS)).withColumnRenamed("conv", "leader")
    taken = first.join(heads, "leader").where(F.col("at") <= F.col("lead")).select("conv", "at", "digest", "chars")
    roots = heads.select(
        "conv", F.lit(0).cast("long").alias("at"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars")
    )
    return own.unionByName(taken).unionByName(roots)


def _lanes() -> dict[str, Column]:
    """Four random numbers of 32 bits for a place and its turn."""
    out = {}
    for i, pair in enumerate(("ab", "cd")):
        mixed = F.xxhash64(F.lit(i), "at", "digest")
        for name, half in zip(pair, (F.shiftrightunsigned(mixed, 32), mixed.bitwiseAND(0xFFFFFFFF)), strict=True):
            out[name] = F.when(F.col("at") > 0, half).otherwise(F.lit(0).cast("long"))
    return out


def _joined(one: Column, two: Column) -> Column:
    """64 bits of two sums."""
    return F.shiftleft(one % (1 << 32), 32).bitwiseOR(two % (1 << 32))


def paths(turns: DataFrame) -> DataFrame:
    """``conv``, the node of each of its places, the node above, and the characters of its turn."""
    rows = checkpointed(turns.select("conv", "at", "chars", *[c.alias(n) for n, c in _lanes().items()]))
    summed = with_running_sums(rows, "conv", ["at"], list("abcd"))
    now = [F.col(f"_sum_{n}") for n in "abcd"]
    above = [F.col(f"_sum_{n}") - F.col(n) for n in "abcd"]
    return summed.select(
        "conv",
        F.col("at").alias("depth"),
        _joined(*now[:2]).alias("n1"),
        _joined(*now[2:]).alias("n2"),
        _joined(*above[:2]).alias("p1"),
        _joined(*above[2:]).alias("p2"),
        "chars",
    )


def ends(whole: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node of ``whole``, which has a node for each conversation.

    A digest is one pass over all ids in order. Neighbouring ids are joined first; these strings then
    pass through one digest for each node, one after the other.
    """
    joined = whole.groupBy(*NODE, F.shiftright("conv", _ENDS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in NODE), T.StructField("ends_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, found = None, None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*NODE, "ids")]
            for *node, ids in zip(*columns, strict=True):
                if node != now:
                    if now:
                        found.append((*now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], schema.names)
                found = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, digest.hexdigest())], schema.names)

    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "block")
    return dealt.select(*NODE, "ids").mapInArrow(run, schema)


def trie(
    df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    turns = checkpointed(turns_in_order(df, conv, turn, role, text))
    all_paths = paths(rebuilt(turns))
    all_paths = checkpointed(all_paths)

    # Whole sequences, each with its weight and its least conversation, which stands for it.
    whole = checkpointed(
        all_paths.groupBy("conv").agg(F.max_by(F.struct(*NODE), "depth").alias("end")).select("conv", "end.*")
    )
    sequences = checkpointed(
        whole.groupBy(*NODE).agg(F.count(F.lit(1)).alias("weight"), F.min("conv").alias("conv"))
    )
    standing = checkpointed(all_paths.join(sequences.select("conv", "weight"), "conv"))
    nodes = checkpointed(
        standing.groupBy(*NODE).agg(
            F.sum("weight").alias("n_convs"),
            F.min("conv").alias("conv"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "chars")],
        )
    )
    below = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"))
    children = checkpointed(below.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children")))
    leaves = sequences.join(children, NODE, "left_anti").select("conv")

    cost = (F.col("n_convs") - 1) * F.col("chars")
    costs = checkpointed(nodes.select("conv", *NODE, cost.alias("cost")))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    about = checkpointed(
        costs.select("conv", "cost", zero.alias("leaf"))
        .unionByName(leaves.select("conv", zero.alias("cost"), one.alias("leaf")))
        .groupBy("conv")
        .agg(F.sum("cost").alias("spent"), F.sum("leaf").alias("leaf"))
    )
    through = (
        standing.select("conv", *NODE)
        .join(about, "conv")
        .groupBy(*NODE)
        .agg(F.sum("spent").alias("spent"), F.sum("leaf").alias("n_leaves"))
    )
    spent = with_running_sums(costs, "conv", ["depth"], ["cost"])
    above = spent.select(*NODE, (F.col("_sum_cost") - F.col("cost")).alias("above"))

    # All that is known of a node, brought together by one shuffle.
    named = [*NODE, "conv", "p1", "p2", "n_convs", "n_children", "n_leaves", "spent", "above", "ends_sha256"]
    nothing = {c: F.lit(None).cast("string" if c == "ends_sha256" else "long") for c in named}
    known = None
    for part in (nodes, children, through, above, ends(whole)):
        row = part.select(*[F.col(c) if c in part.columns else nothing[c].alias(c) for c in named])
        known = row if known is None else known.unionByName(row)
    together = checkpointed(known.groupBy(*NODE).agg(*[F.min(c).alias(c) for c in named if c not in NODE]))

    parents = together.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    # The root's sums are those of no turn, and so would be those above it.
    return together.join(parents, ["depth", "p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        (F.col("spent") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
