"""Structured Streaming over corpora: stateless encoding, and the per-document fold as micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lathe.functions import seq as S
from lathe.operators.bpe import Tokenizer, train
from lathe.sources.corpus import DOCUMENT


def documents_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """New Parquet files of a folder as (doc_id, text)."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def encoded(stream: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(doc_id, ids) of each document: a projection, so there is no state and no watermark."""
    return stream.select("doc_id", S.to_ids(tokenizer.encode(F.col("text"))).alias("ids"))


class FoldingTrainer:
    """Learns from each micro-batch in turn, going on from the rules learned before."""

    def __init__(self, vocab_size: int, min_frequency: int = 2, init: Tokenizer | None = None):
        self.vocab_size, self.min_frequency, self.tokenizer = vocab_size, min_frequency, init or Tokenizer()

    def on_batch(self, df: DataFrame, _: int) -> None:
        if self.tokenizer.vocab_size < self.vocab_size:
            self.tokenizer, _counts = train(df, self.vocab_size, self.min_frequency, "per_document_fold", self.tokenizer)

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
