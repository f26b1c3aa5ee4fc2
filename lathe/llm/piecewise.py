"""Operator 4: context-triggered piecewise hashing of documents.

A rolling hash over seven UTF-8 bytes cuts a text where its value hits a
multiple of the block size; each chunk gives one signature character (six bits
of its CRC-32). A fingerprint is ``block:signature:signature of twice the block``.
Block sizes are 3 * 2^k, the first that leaves at most 64 chunks on average,
halved while there are under 32. The rolling hash is a sum of shifted bytes, so
numpy computes it for a whole text at once.

Fingerprints are compared only at compatible block sizes: equal, or one twice
the other. Likeness is 1 - edits / longer length of the better pair of
signatures, by Spark's own edit distance (at most 64 x 64 characters); unless
the two share a run of `RUN` characters it is 0, since chance alone aligns a few.

Neighbours: documents are dealt out by descending (doc_id, hash of text) and
sorted; a worker needs only the row before. The first and last document of each
partition are kept in the staged table, so that a partition's last document is
edited with the first of the next non-empty one: two rows a partition.

Defined cases: a null text is the empty text, with fingerprint ``3::``; two
equal texts have likeness 1, the empty text and any other 0; rows of one doc_id
are ordered by the hash of their text; null doc_ids come last; a table of one
row is its own next document; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lathe.llm.arrow import slices, texts, with_columns
from lathe.llm.common import session, staged, table, text_of

LENGTH, LEAST_BLOCK, WINDOW, RUN = 64, 3, 7, 4
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _rolling(data: np.ndarray) -> np.ndarray:
    """For each byte, a hash of it and the six before it."""
    x = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32)])
    n = data.size
    plain, weighted, shifted = (np.zeros(n, np.uint32) for _ in range(3))
    for k in range(WINDOW):
        y = x[WINDOW - 1 - k : WINDOW - 1 - k + n]
        plain += y
        weighted += y * np.uint32(WINDOW - k)
        shifted ^= y << np.uint32(5 * k)
    return plain + weighted + shifted


def _signature(data: bytes, cuts: np.ndarray, most: int) -> str:
    """One character for each chunk; what lies beyond `most` chunks is part of the last."""
    ends = [*(cuts[: most - 1] + 1).tolist()]
    if not ends or ends[-1] < len(data):
        ends.append(len(data))
    out, a = [], 0
    for b in ends:
        out.append(ALPHABET[zlib.crc32(data[a:b]) & 63])
        a = b
    return "".join(out)


def fingerprint(text: str) -> str:
    data = text.encode()
    if not data:
        return f"{LEAST_BLOCK}::"
    h = _rolling(np.frombuffer(data, np.uint8)) + np.uint32(1)
    block = LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    while True:
        cuts = np.flatnonzero(h % np.uint32(block) == 0)
        if cuts.size >= LENGTH // 2 or block == LEAST_BLOCK:
            break
        block //= 2
    return f"{block}:{_signature(data, cuts, LENGTH)}:{_signature(data, cuts[h[cuts] % np.uint32(2 * block) == 0], LENGTH // 2)}"


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Append the fingerprint of each text."""
    session(df)
    df = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield with_columns(batch, **{out: pa.array([fingerprint(x) for x in texts(batch, text)], pa.string())})

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def _alike(a: Column, b: Column) -> Column:
    """Likeness of two signatures at one block size."""
    longer = F.greatest(F.length(a), F.length(b))
    # One run of each offset is enough to look at: both must hold the same RUN characters somewhere.
    runs = lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - (RUN - 1)), lambda i: F.substring(s, i, F.lit(RUN)))
    shares = F.when(F.least(F.length(a), F.length(b)) >= RUN, F.arrays_overlap(runs(a), runs(b))).otherwise(False)
    return F.when(a == b, F.lit(1.0)).when(shares, 1.0 - F.levenshtein(a, b) / longer).otherwise(F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two fingerprints; null if either is."""
    part = lambda x, k: F.split_part(x, F.lit(":"), F.lit(k))
    block_a, block_b = part(a, 1).cast("long"), part(b, 1).cast("long")
    same = F.greatest(_alike(part(a, 2), part(b, 2)), F.when((part(a, 3) != "") & (part(b, 3) != ""), _alike(part(a, 3), part(b, 3))).otherwise(0.0))
    found = (
        F.when(a == b, F.lit(1.0))
        .when((part(a, 2) == "") | (part(b, 2) == ""), F.lit(0.0))
        .when(block_a == block_b, same)
        .when(block_a == 2 * block_b, _alike(part(a, 2), part(b, 3)))
        .when(block_b == 2 * block_a, _alike(part(b, 2), part(a, 3)))
        .otherwise(F.lit(0.0))
    )
    return F.when(a.isNotNull() & b.isNotNull(), found)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many characters of the next document's start."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


ROW = "part int, edge int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string, text string"


def with_edited(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint), one for each document."""
    session(df)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc(), F.col("tie").desc()]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")

    def whole(part: int, edge: int, of: tuple, following: tuple | None) -> tuple:
        """edge 0: done; 1: first of its partition; 2: last, still without its next document."""
        key, text, mark = of
        if edge:
            return part, edge, key, len(text), None, mark, None, None, text
        new = edited(text, following[1])
        return part, 0, key, len(text), hashlib.sha256(new.encode()).hexdigest(), mark, fingerprint(new), following[2], None

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.string()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], [x.split()[0] for x in ROW.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        for batch in slices(batches, "text"):
            out = []
            for key, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                now = (key, text, fingerprint(text))
                out.append(whole(part, 1, now, None) if before is None else whole(part, 0, before, now))
                before = now
            yield batch_of(out)
        if before is not None:
            yield batch_of([whole(part, 2, before, None)])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for r in batch.to_pylist():
                out.append(whole(r["part"], 0, (r["doc_id"], r["text"], r["fingerprint"]), (None, r["next_text"], r["next_mark"])))
            yield batch_of(out)

    done = staged(dealt.mapInArrow(run, ROW))
    # Two rows a partition: the first of each, and after the last partition the very first.
    firsts = done.filter("edge = 1").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark"))
    follows = firsts.select("part").select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part"))).alias("to"))
    lasts = done.filter("edge = 2").select("part", "doc_id", "text", "fingerprint")
    joined = lasts.join(follows, "part").join(firsts.withColumnRenamed("part", "to"), "to").select("part", "doc_id", "text", "fingerprint", "next_text", "next_mark")
    every = done.filter("edge = 0").unionByName(joined.mapInArrow(edges, ROW))
    return every.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses. Tested against a plain Python version."""
    found = with_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    mark = F.col("fingerprint")
    return found.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(mark, F.col("edited_fingerprint")).alias("near_edited"), likeness(mark, F.col("next_fingerprint")).alias("near_next"))
