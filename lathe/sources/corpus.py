"""Corpora as DataFrames: tables, splits, slices, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lathe.sources.staging import staged

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
SPLITS = ("train", "validation", "test")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a folder; columns are pruned and filters pushed down by whoever reads it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, name: str = "documents", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A corpus as (doc_id, text)."""
    return table(spark, sf_dir, name).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def literal(spark: SparkSession, *texts: str) -> DataFrame:
    """Inline texts as a corpus."""
    return spark.createDataFrame(list(enumerate(texts)), DOCUMENT)


def split_of(doc_id: Column) -> Column:
    """Deterministic split by id: eight tenths train, one validation, one test."""
    r = F.pmod(doc_id, F.lit(10))
    return F.when(r < 8, F.lit(SPLITS[0])).when(r == 8, F.lit(SPLITS[1])).otherwise(F.lit(SPLITS[2]))


def with_split(df: DataFrame) -> DataFrame:
    return df.withColumn("split", split_of(F.col("doc_id")))


def split(df: DataFrame, name: str) -> DataFrame:
    if name not in SPLITS:
        raise ValueError(f"no such split: {name}")
    return df.filter(split_of(F.col("doc_id")) == name)


def row_at(df: DataFrame, position: int) -> DataFrame:
    """The row at a position in document order."""
    return df.orderBy("doc_id").offset(position).limit(1)


def first(df: DataFrame, n: int) -> DataFrame:
    """The first n documents in order: a top-k, never a full sort in one place."""
    return df.orderBy("doc_id").limit(n)


def positions(df: DataFrame, key: str = "doc_id", weight: Column | None = None) -> DataFrame:
    """Append `position`, a row's place in key order (from 0), by ranges: no single-partition sort.

    Rows are dealt out by ranges of the key and written once, with their range;
    ranges are counted from that table, and each row gets the rows before its
    range plus its place inside. What is ordered in one task is a row per range.
    With a weight the position is the sum of the weights before. Null keys come
    first; rows of equal key are ordered by a hash of their other columns.
    """
    others = [f.name for f in df.schema.fields if f.name != key and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = df.withColumn("__tie", F.xxhash64(*others) if others else F.lit(0).cast("long")).withColumn("__weight", F.lit(1) if weight is None else weight)
    dealt = staged(tied.repartitionByRange(key, "__tie").withColumn("__range", F.spark_partition_id()))
    sizes = dealt.groupBy("__range").agg(F.sum("__weight").alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(key, "__tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("__at", F.coalesce(F.sum("__weight").over(inside), F.lit(0)))
    return placed.join(before, "__range").withColumn("position", (F.col("__before") + F.col("__at")).cast("long")).drop("__range", "__before", "__at", "__tie", "__weight")


def batches(df: DataFrame, size: int = 1000) -> DataFrame:
    """Append `batch_id`: consecutive batches of a size in document order, with all columns."""
    return positions(df).withColumn("batch_id", F.floor(F.col("position") / size).cast("long")).drop("position")


def joined(df: DataFrame, separator: str = "\n\n") -> DataFrame:
    """The whole corpus as one text, documents in order: a single cell, so for corpora under 2 GB (training has its own joined mode)."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]), separator)
    return df.agg(text.alias("text"))


def profile(df: DataFrame) -> DataFrame:
    """Characters and bytes of each document."""
    return df.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("n_bytes"))
