"""Token sequences as strings: each code point is a token id.

Reading UTF-8 bytes as ISO-8859-1 makes the first 256 ids, and then a merge is
one `replace`: left to right, without overlaps. All of it stays in Spark's own
expressions. Ids from 0xD800 on are moved past the surrogates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Merge = tuple[int, int, int]  # left, right, new

SURROGATES, GAP = 0xD800, 0x800


def symbol(token_id: int) -> str:
    """The character that stands for a token id."""
    if not 0 <= token_id <= 0x10FFFF - GAP:
        raise ValueError(f"no code point for token {token_id}")
    return chr(token_id if token_id < SURROGATES else token_id + GAP)


def from_text(text: Column) -> Column:
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def merge(seq: Column, left: int, right: int, new: int) -> Column:
    """One pass of a merge rule."""
    return F.replace(seq, F.lit(symbol(left) + symbol(right)), F.lit(symbol(new)))


def apply_merges(seq: Column, merges: Sequence[Merge]) -> Column:
    """All rules in rank order, as one fold: a chain of replacements would be too deep a plan."""
    if not merges:
        return seq
    rules = F.array(*(F.struct(F.lit(symbol(a) + symbol(b)).alias("p"), F.lit(symbol(n)).alias("n")) for a, b, n in merges))
    return F.aggregate(rules, seq, lambda acc, m: F.replace(acc, m["p"], m["n"]))


def encode(text: Column, merges: Sequence[Merge]) -> Column:
    return apply_merges(from_text(text), merges)


def decode(seq: Column, merges: Sequence[Merge]) -> Column:
    """The text of a sequence; an unknown id or bytes that are not UTF-8 are an error."""
    if merges:
        rules = F.array(*(F.struct(F.lit(symbol(n)).alias("n"), F.lit(symbol(a) + symbol(b)).alias("p")) for a, b, n in reversed(merges)))
        seq = F.aggregate(rules, seq, lambda acc, m: F.replace(acc, m["n"], m["p"]))
    return F.decode(F.encode(seq, "ISO-8859-1"), "UTF-8")


def to_ids(seq: Column) -> Column:
    """A sequence as an array of ids."""
    number = lambda c: F.when(F.ascii(c) >= SURROGATES, F.ascii(c) - GAP).otherwise(F.ascii(c))
    return F.when(seq == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(seq, ""), number))


def length(seq: Column) -> Column:
    return F.char_length(seq).cast("long")


def hexed(seq: Column) -> Column:
    """The sequence's UTF-8 form in hexadecimal, for comparison."""
    return F.hex(F.encode(seq, "UTF-8"))
