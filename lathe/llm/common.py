"""What the operators of this subpackage share: tables, staging in the shared folder, ordering.

Nothing here collects documents: the only driver-side values are paths and
bounded, documented summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.sources.staging import session, shared_dir, staged

__all__ = ["lower_ascii", "session", "shared_dir", "sieved", "spread_join", "staged", "table", "text_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Keys that hold more than one in HOT_KEYS of all rows are spread over SPREAD tasks each; fewer than HOT_KEYS keys can.
HOT_KEYS, SPREAD = 1000, 32


def spread_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, by: list[str]) -> DataFrame:
    """Inner join on columns of 64-bit numbers with a side of unique keys, of which `weight` tells how many rows of the left one has.

    A key that holds more than one in HOT_KEYS of all rows is dealt out by a hash
    of the columns `by` over SPREAD tasks, and its one row on the right goes to each
    of them. Which keys these are is sent to all executors: fewer than HOT_KEYS rows
    of numbers, whatever the table.
    """
    right = staged(right)
    total = right.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) * HOT_KEYS > total
    hot = right.filter(heavy).select(*on, F.lit(True).alias("__hot"))
    marked = left.join(F.broadcast(hot), on, "left")
    salted = marked.withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*by), F.lit(SPREAD))).otherwise(0).cast("int")).drop("__hot")
    copies = right.withColumn("__salt", F.explode(F.when(heavy, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0))))).drop(weight)
    return salted.join(copies, [*on, "__salt"]).drop("__salt")


#: Rows of 64 bits that a sieve has at most: that many pairs of numbers are broadcast, whatever the tables.
SIEVE = 1 << 18


def sieved(df: DataFrame, keys: DataFrame, key: Column, out: str) -> DataFrame:
    """Append a boolean: false only if a row's 64-bit `key`, an expression on both sides, is that of no row of `keys`.

    A row that is false needs no exact join. With far more keys than the sieve has
    bits nearly all rows are true, and the exact join behind it does the whole work.
    """
    word, bit = F.pmod(F.shiftright(key, 6), F.lit(SIEVE)), F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    met = df.withColumn("__word", word).join(F.broadcast(words), "__word", "left")
    return met.withColumn(out, F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).drop("__word", "__bits")
