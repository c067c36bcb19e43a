"""Document fingerprints by winnowing, with DataFrame functions only.

Every k-gram of a text (k code points) is hashed. In each window of ``window`` consecutive k-grams
the least hash is chosen, the rightmost of equal ones, and chosen k-grams are kept with their
positions. Two texts that share ``window + k - 1`` code points in a row share a fingerprint entry,
and the positions say where.

An entry is held as one number, the hash above the complement of the position, so the least
number of a window is the rightmost least hash. Windows are minimised by doubling: a minimum
over 2n k-grams is the lesser of two minima over n.

Edge cases: a NULL or empty text has no entries; a shorter text than k is one k-gram; a text with
fewer k-grams than a window is one window; texts are taken whole; equal texts have equal
fingerprints; an empty table gives no rows; other columns pass through, whatever their names, and a column
named like the result is replaced. Keys may be NULL, repeated, and of any type that has an order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercatura.session import checkpointed

K = 12
WINDOW = 16

_POSITION_BITS = 31
_LAST = (1 << _POSITION_BITS) - 1
# Neighbours are looked up in ranges of keys: at least so many, and more if they would hold more bytes of text.
RANGES = 1024
RANGE_BYTES = 256 << 20


def _free(taken: Iterable[str], *names: str) -> list[str]:
    """The names, longer by underscores where they are taken."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def entries(df: DataFrame, text: str, name: str, *, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add the numbers of the chosen k-grams, in text order."""
    whole = F.coalesce(F.col(text), F.lit(""))
    # A lookahead takes the k-gram, then one code point is consumed.
    grams = F.when(
        F.char_length(whole) >= k,
        F.regexp_extract_all(whole, F.lit(f"(?s)(?=(.{{{k}}}))."), 1),
    ).otherwise(F.filter(F.array(whole), lambda g: g != ""))

    def number(gram: Column, place: Column) -> Column:
        high = F.shiftleft(F.shiftrightunsigned(F.xxhash64(gram), 64 - 31), _POSITION_BITS)
        return high + (F.lit(_LAST) - place)

    names = [c for c in df.columns if c != name]
    kept = [F.col(c) for c in names]
    (least,) = _free([*names, name], "least")
    # Each step is a column of its own, so that none is computed twice. The k-grams are not one: as they
    # are looked at once, they need not be written anywhere.
    out = df.select(*kept, F.transform(grams, number).alias(least))
    done = 1
    while done < window:
        step = min(done, window - done)
        later = F.slice(least, F.lit(step + 1), F.greatest(F.size(least) - step, F.lit(0)))
        # Beyond the end there is nothing, which is never the least.
        lesser = F.zip_with(least, later, lambda a, b: F.least(a, b))
        out = out.select(*kept, lesser.alias(least))
        done += step
    whole_windows = F.slice(least, F.lit(1), F.greatest(F.size(least) - (window - 1), F.lit(1)))
    return out.select(*kept, F.array_distinct(whole_windows).alias(name))


def position(entry: Column) -> Column:
    """From 0."""
    return F.lit(_LAST) - entry.bitwiseAND(F.lit(_LAST))


def hash_of(entry: Column) -> Column:
    return F.shiftright(entry, _POSITION_BITS)


def winnow(
    df: DataFrame, text: str = "text", name: str = "fingerprint", *, k: int = K, window: int = WINDOW
) -> DataFrame:
    """Add the fingerprint of ``text``: an array of ``position`` (in code points, from 0) and
    ``hash``, in text order."""
    found = entries(df, text, name, k=k, window=window)
    pairs = F.transform(
        name, lambda e: F.struct(position(e).cast("int").alias("position"), hash_of(e).alias("hash"))
    )
    return found.withColumn(name, pairs)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the distinct hashes of two columns of entries; 1 if both are empty."""
    first, second = (F.array_distinct(F.transform(x, hash_of)) for x in (a, b))
    shared = F.size(F.array_intersect(first, second))
    either = F.size(first) + F.size(second) - shared
    return F.when(either > 0, shared / either).otherwise(F.lit(1.0))


def _cuts(df: DataFrame, key: str, text: str) -> list:
    """The least ``(key, hash of the text)`` of each range, in order: one row a range."""
    narrow = checkpointed(
        df.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.octet_length(text).alias("size"))
    )
    total = narrow.agg(F.sum("size")).first()[0] or 0
    spread = narrow.repartitionByRange(max(RANGES, -(-total // RANGE_BYTES)), "key", "tie")
    firsts = spread.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("key", "tie")).alias("cut"))
    return [row["cut"] for row in firsts.orderBy("cut").collect()]


def _range_of(mark: Column, cuts: Column, n: int) -> Column:
    """The number of cuts that are not above the mark, by binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    # Beyond the last cut there is NULL, which nothing is above.
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(cuts, low + step - 1) <= mark, low + step).otherwise(low),
    )


def with_next(df: DataFrame, key: str, text: str, derive) -> DataFrame:
    """Add ``next_...`` for each column of ``derive(df)``: the value in the next row by descending
    ``key``, NULL keys last, ties by the hash of the text, and the first row after the last.

    The rows are cut into ranges of key and hash, so that a key that many rows have, or that they lack, is
    spread over several ranges. Each range gets a copy of the first row of the next one, so that no row's
    neighbour lies outside its range, and only one range is ever sorted in one task. Rows that are equal in
    key and text are in one range.
    """
    at, guest, tie, top = _free(df.columns, "at", "guest", "tie", "top")
    cuts = _cuts(df, key, text)
    kind = df.schema[key].dataType
    ends = F.array(*[F.struct(F.lit(k).cast(kind).alias("key"), F.lit(t).alias("tie")) for k, t in cuts])
    tied = df.withColumn(tie, F.xxhash64(text))
    mark = F.struct(F.col(key).alias("key"), F.col(tie).alias("tie"))
    placed = tied.withColumn(at, _range_of(mark, ends, len(cuts)) if cuts else F.lit(0))
    # One row a range, so that broadcasting them is bounded and the texts need not move.
    tops = placed.groupBy(F.col(at).alias("range")).agg(F.max(mark).alias(top))
    first = (F.col("range") == F.col(at)) & (F.col(top) == mark)
    heads = (
        placed.select(key, text, tie, at)
        .join(F.broadcast(tops), first)
        .groupBy(at, key, tie)
        .agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias(text))
    )
    # No range is empty: each holds its own cut.
    above = F.when(F.col(at) < len(cuts), F.col(at) + 1).otherwise(F.lit(1))
    guests = heads.select(key, text, tie, above.alias(at), F.lit(True).alias(guest))
    everything = placed.withColumn(guest, F.lit(False)).unionByName(guests, allowMissingColumns=True)
    ready = derive(everything.repartition(at))
    order = Window.partitionBy(at).orderBy(guest, F.desc_nulls_last(key), F.desc(tie), F.coalesce(text, F.lit("")))
    added = [c for c in ready.columns if c not in everything.columns]
    return (
        ready.withColumns({f"next_{c}": F.lead(c).over(order) for c in (text, *added)})
        .where(~F.col(guest))
        .drop(at, guest, tie)
    )


def edited_entries(
    df: DataFrame,
    text: str,
    following: str,
    own: str,
    name: str,
    edited: str,
    following_own: str | None = None,
    *,
    k: int = K,
    window: int = WINDOW,
) -> DataFrame:
    """Add ``edited``, the text with its last ``floor(n / 2)`` code points replaced by as many
    from the start of ``following``, and ``name``, its entries.

    Windows that lie in the part both texts share choose what they choose in the text, so only
    the rest is hashed again, from two windows before the change on. With ``following_own``, the
    entries of ``following``, windows that lie in the replacement choose what they choose there: only
    those across the seam and the last ones, whose choices the cut may hide, are hashed again.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    half = F.floor(F.char_length(whole) / 2).cast("int")
    kept = F.char_length(whole) - half
    start = F.greatest(kept - (k + 2 * window - 4), F.lit(1))
    sewn = F.substring(F.coalesce(F.col(following), F.lit("")), F.lit(1), half)
    columns = df.columns
    begin, seam, added, tail, rest, last, end, ending = _free(
        [*columns, edited, name], "begin", "seam", "added", "tail", "rest", "last", "end", "ending"
    )
    out = df.withColumns({begin: start, seam: kept, added: sewn})
    # The last whole window of the replacement, from 0; below 0, it is all hashed again.
    out = out.withColumn(last, F.char_length(added) - (k + window - 1) if following_own else F.lit(-1))
    across = F.when(F.col(last) >= 0, F.substring(added, F.lit(1), F.lit(k + window - 2))).otherwise(F.col(added))
    # No window that begins before this one chooses behind the last.
    final = F.greatest(F.col(last) - (window - 2), F.lit(0))
    out = out.withColumns(
        {
            edited: F.concat(F.substring(whole, F.lit(1), F.col(seam)), F.col(added)),
            tail: F.concat(F.substring(whole, F.col(begin), F.col(seam) - F.col(begin) + 1), across),
            end: F.when(
                F.col(last) >= 0, F.substring(added, final + 1, F.char_length(added) - final)
            ).otherwise(F.lit("")),
        }
    ).drop(added)
    out = entries(out, tail, rest, k=k, window=window)
    shift = F.col(begin) - 1
    before = F.filter(own, lambda e: position(e) < shift + F.when(shift > 0, F.lit(window - 1)).otherwise(F.lit(0)))
    parts = [before, F.transform(rest, lambda e: e - shift)]
    if following_own:
        out = entries(out, end, ending, k=k, window=window)
        reused = F.filter(F.coalesce(following_own, F.array().cast("array<bigint>")), lambda e: position(e) <= F.col(last))
        parts.append(F.transform(reused, lambda e: e - F.col(seam)))
        parts.append(F.transform(ending, lambda e: e - (F.col(seam) + final)))
    joined = F.array_distinct(F.concat(*parts))
    return out.select(*columns, edited, joined.alias(name))


def text_of(entries_column: str) -> Column:
    """Entries as text: sixteen hexadecimal digits each, hash above the position's complement."""
    return F.array_join(F.transform(entries_column, lambda e: F.lpad(F.hex(e), 16, "0")), " ")
