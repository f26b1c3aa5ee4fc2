"""A corpus pipeline over `documents`: quality, line dedup, near-dedup, decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one
before it kept; between stages the documents are written as Parquet and read
again. All but the last return the columns of `documents`.

Defined cases: rows of equal doc_id and text are one document from the near-dedup
stage on, rows of one doc_id (or of none) with different texts are several; null
texts are empty texts; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm import decontaminate, linededup, nearsets, quality, sentencepieces
from lathe.llm.common import sieved, staged, table, text_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle in the near-dedup stage.
WIDTH = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones, predicts to be good."""
    model = quality.fitted(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score(docs, model, out="__score").filter(F.col("__score") >= quality.CUT).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines, short ones too, whose template came earlier; n_chars follows."""
    done = linededup.drop_recurring(docs.select(COLUMNS))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id.

    Five-word shingles, Jaccard 0.8 or more: candidates by SimHash blocks, completed by an exact prefix filter.
    """
    first = staged(nearsets.firsts(docs.select("doc_id", "text"), WIDTH)).select(F.col("id").alias("__kept"), F.col("h").alias("__of"))
    keyed = docs.select(*COLUMNS, F.xxhash64(text_of("text")).alias("__hash"))
    rows = keyed.groupBy("doc_id", "__hash").agg(F.count("*").alias("__rows"))
    same = F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.col("__hash") == F.col("__of"))
    # Documents that go or stand in several rows; all others stay without a shuffle of their texts.
    odd = staged(rows.join(first, same, "left").filter(F.col("__of").isNull() | (F.col("__rows") > 1)).select("doc_id", "__hash", F.col("__of").isNull().alias("__goes")))
    met = sieved(keyed, odd, F.xxhash64("doc_id", "__hash"), "__met")
    marks = odd.select(F.col("doc_id").alias("__kept"), F.col("__hash").alias("__of"), "__goes")
    some = met.filter("__met").join(marks, same, "left").filter(~F.coalesce("__goes", F.lit(False))).dropDuplicates(["doc_id", "__hash"])
    return met.filter("not __met").select(COLUMNS).union(some.select(COLUMNS))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = decontaminate.matches(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    gone = staged(found.select(F.col("doc_id").alias("__gone")).distinct())
    return docs.select(COLUMNS).join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the text decoded from them."""
    path = sentencepieces.model_path()
    done = sentencepieces.encode(docs.select("doc_id", "text"), path, decoded="decoded")
    return done.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near_duplicates", near_stage), ("benchmark", benchmark_stage), ("tokens", tokens_stage)]

#: The classifier, XXH64, alignment and the tokenizer are not in SQL: the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs)
    return docs
