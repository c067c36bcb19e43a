"""URL filters: host-suffix and path-prefix expressions matched on short hash prefixes.

Every different (host, path) is expanded once into its host suffixes, cut at dots, and those path
prefixes whose length some rule has. The expressions meet the rules on the first four bytes of
their SHA-256; a meeting counts if the full digests agree. The longest rule wins: by characters,
then by host, and a block goes before an allow for the same rule.

Edge cases: a NULL URL or one without ``://`` has an empty host and path and fits no rule; an empty
host fits none either; an empty table gives no rows; rules with a NULL host, path or verdict are left out; without rules, all
rows get the default verdict. Repeated rows are all judged, other columns pass through, and result
names replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULE_COLUMNS = ("host", "path", "verdict")
RESULTS = ("host", "path", "rule", "verdict")
# Hex digits of the digest that the join runs on: four bytes.
PREFIX_DIGITS = 8

RULES = [
    # The filter list of the query.
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, with A-Z in lower case."""
    host = F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #``."""
    return F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A NUL cannot stand in a host suffix that a rule names, so host and path stay apart.
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def host_suffixes(host: Column) -> Column:
    """``a.b.c``, ``b.c``, ``c``; nothing for an empty host."""
    labels = F.split(host, r"\.", -1)
    return F.when(
        host != "",
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))


def judge(
    df: DataFrame, rules: DataFrame, url: str = "url", *, default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the winning rule) and ``verdict``.

    ``rules`` has the columns host, path, verdict. Spark decides whether it is small enough to
    broadcast; a shuffled join can be split on a hot expression.
    """
    listed = (
        rules.select(*RULE_COLUMNS)
        .dropna()
        .where(F.col("host") != "")
        .withColumn("host", F.translate("host", UPPER, UPPER.lower()))
        # One verdict a rule: "block" stands after "allow" in the alphabet.
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("_digest", _digest(F.col("host"), F.col("path")))
        .select(
            F.substring("_digest", 1, PREFIX_DIGITS).alias("_prefix"),
            F.col("_digest").alias("_rule_digest"),
            F.length("host").alias("_host_size"),
            F.length("path").alias("_path_size"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict"),
        )
    )
    # At most one number for each length a path can have.
    lengths = rules.select(
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths")
    ).scalar()
    # The columns of the table travel as one value, so that none of their names can clash.
    others = [c for c in df.columns if c not in RESULTS]
    named = df.select(
        F.struct(*others).alias("others") if others else F.lit(None).alias("others"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    different = named.select("host", "path").distinct()
    expressions = (
        different.withColumn("_suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("_length", F.explode(lengths))
        .where(F.col("_length") <= F.length("path"))
        .withColumn("_digest", _digest(F.col("_suffix"), F.expr("left(path, _length)")))
        .withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
        .select("host", "path", "_prefix", "_digest")
    )
    longest = F.struct(
        (F.col("_host_size") + F.col("_path_size")).alias("size"),
        F.col("_host_size"),
        F.col("rule"),
        F.col("verdict"),
    )
    best = (
        expressions.join(listed, "_prefix")
        .where(F.col("_digest") == F.col("_rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(longest).alias("_best"))
    )
    found = best.select("host", "path", "_best.rule", "_best.verdict")
    return named.join(found, ["host", "path"], "left").select(
        *[F.col("others")[c].alias(c) for c in others],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
