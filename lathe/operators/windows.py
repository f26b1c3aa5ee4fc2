"""Input and shifted target windows over token ids, and batches of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.sources.corpus import positions


def count_of(n: Column, context: int, stride: int) -> Column:
    """How many windows a sequence of n ids has."""
    return F.when(n < context + 1, F.lit(0)).otherwise(F.floor((n - context - 1) / stride) + 1).cast("long")


def _length(df: DataFrame, ids: str) -> Column:
    return F.octet_length(ids) if isinstance(df.schema[ids].dataType, T.BinaryType) else F.size(ids)


def windows(df: DataFrame, context: int, stride: int, ids: str = "ids") -> DataFrame:
    """A row (start, input, target) for each window that fits whole, with the other columns of its sequence.

    Ids are an array, or binary with one byte for each. Starts are 0, stride,
    2 * stride, ...; a tail that does not fill a window is dropped. Slices are cut
    from the sequence in the same stage: nothing is shuffled.
    """
    if context < 1 or stride < 1:
        raise ValueError("context and stride must be positive")
    n, packed = _length(df, ids), isinstance(df.schema[ids].dataType, T.BinaryType)
    starts = F.when(n >= context + 1, F.sequence(F.lit(0), n - context - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    rest = [c for c in df.columns if c not in (ids, "start", "input", "target")]
    cut = df.select(*rest, ids, F.explode(starts).alias("start"))
    part = lambda at: F.substring(F.col(ids), at, F.lit(context)) if packed else F.slice(ids, at, context)
    return cut.select(*rest, "start", part(F.col("start") + 1).alias("input"), part(F.col("start") + 2).alias("target"))


def numbered(df: DataFrame, context: int, stride: int, ids: str = "ids") -> DataFrame:
    """The windows of sequences (doc_id, ids) with window_id, their place in order of (doc_id, start).

    Sequences are dealt out and written once; their windows, which are larger, are cut afterwards.
    """
    placed = positions(df, "doc_id", count_of(_length(df, ids), context, stride)).withColumnRenamed("position", "__before")
    return windows(placed, context, stride, ids).withColumn("window_id", F.col("__before") + F.floor(F.col("start") / stride)).drop("__before")


def window_ids(df: DataFrame) -> DataFrame:
    """Append window_id to rows (doc_id, start, ...) that have none: the place in order of (doc_id, start)."""
    if "window_id" in df.columns:
        return df
    keyed = df.withColumn("__key", F.struct("doc_id", "start"))
    return positions(keyed, "__key").withColumnRenamed("position", "window_id").drop("__key")


def window_at(df: DataFrame, index: int) -> DataFrame:
    """The window of a place, with all its columns."""
    return window_ids(df).filter(F.col("window_id") == index)


def batches(df: DataFrame, size: int = 32) -> DataFrame:
    """Append batch_id in file order; the last batch may be short and is kept."""
    return window_ids(df).withColumn("batch_id", F.floor(F.col("window_id") / size).cast("long"))


def shuffled_batches(df: DataFrame, size: int = 32, seed: int = 0, epoch: int = 0) -> DataFrame:
    """Append batch_id after a seeded shuffle, another for each epoch: by the MD5 of seed:epoch:window_id.

    Only numbers and digests are put in order; the windows are joined to their places.
    """
    every = window_ids(df)
    order = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.lit(epoch).cast("string"), F.col("window_id").cast("string")).cast("binary"))
    placed = positions(every.select("window_id", F.struct(order.alias("digest"), "window_id").alias("__order")), "__order")
    return every.join(placed.select("window_id", F.floor(F.col("position") / size).cast("long").alias("batch_id")), "window_id")


def epoch_losses(losses: DataFrame) -> DataFrame:
    """The mean of batch means of each epoch, from rows (epoch, batch_id, loss) of tokens or windows; a short batch weighs as much."""
    by_batch = losses.groupBy("epoch", "batch_id").agg(F.avg("loss").alias("loss"))
    return by_batch.groupBy("epoch").agg(F.avg("loss").alias("train_loss"))
