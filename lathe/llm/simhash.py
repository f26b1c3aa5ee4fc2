"""Operator 7: SimHash near-duplicates by pigeonhole blocks.

A fingerprint is cut into `max_bits + 2` blocks; two fingerprints at `max_bits`
or fewer differing bits agree on two whole blocks at least, so every such pair
meets under a key of two blocks (32 of 64 bits for the usual 2). Keys with few
fingerprints are joined with themselves and each pair's Hamming distance is
verified. Fingerprints under a crowded key are linked without their pairs: each
writes itself and its 64 one-bit neighbours, and all that share such a point
are within two bits of each other, so a star to the least of them links the
same sets (a point has 65 fingerprints at most; this holds for 2 bits only, and
`links` refuses other radii). Work therefore grows with the
number of distinct fingerprints, never with the square of a group.

Equal fingerprints are one node. Components are found on the linked
fingerprints alone, by least-neighbour labels with pointer jumping; every round
is a written table, and nothing but a count and a sum reaches the driver. The
component of a fingerprint that many documents have is sent to several tasks.

Defined cases: a null or empty text has fingerprint 0, linked like any other;
repeated rows share a component; a null doc_id never names a component unless
it has no other id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.llm.arrow import slices, texts, with_columns
from lathe.llm.common import session, spread_join, staged, table

#: Fingerprints under one key that are compared pair by pair; more are linked through shared points.
CROWDED = 16
#: Bit k of byte value v, for counting set bits from a histogram of byte values.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = np.arange(8, dtype=np.int64) * 256


def bits_of(h: np.ndarray) -> int:
    """The signed 64-bit fingerprint of some hashes: the bits set in over half of them."""
    counts = np.bincount((h.view(np.uint8).reshape(h.size, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(counts.ravel() * 2 > h.size, bitorder="little").view(np.int64)[0])


def fingerprint(text: str, width: int) -> int:
    """The signed 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # ASCII only, for both
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else [b" ".join(words)]
    n = max(1, len(words) - width + 1)
    return bits_of(np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, n))


def fingerprints(df: DataFrame, text: str = "text", width: int = 3, out: str = "simhash") -> DataFrame:
    """Append the SimHash of each text's word shingles as a long."""
    session(df)
    df = df.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield with_columns(batch, **{out: pa.array([fingerprint(x, width) for x in texts(batch, text)], pa.int64())})

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))


def _masks(max_bits: int) -> list[int]:
    """Masks of all choices of two blocks out of max_bits + 2, as signed 64-bit integers."""
    n = max_bits + 2
    edges = [64 * k // n for k in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in (a | b for a, b in combinations(blocks, 2))]


def _points(fp) -> F.Column:
    """A fingerprint and its 64 neighbours at one bit."""
    flips = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
    return F.array(fp, *(fp.bitwiseXOR(F.lit(x)) for x in flips))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints `fp` whose components are those of all pairs within max_bits (2)."""
    if max_bits != 2:
        raise ValueError("links through shared points are exact for 2 bits")
    keys = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(max_bits)))).alias("way", "key"))
    crowd = keys.groupBy("way", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = staged(keys.join(crowd, ["way", "key"]))
    few = met.filter(F.col("n") <= CROWDED)
    pairs = (
        few.select("way", "key", F.col("fp").alias("a"))
        .join(few.select("way", "key", F.col("fp").alias("b")), ["way", "key"])
        .filter("a < b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
    )
    dense = met.filter(F.col("n") > CROWDED).select("fp").distinct()
    shared = dense.select("fp", F.explode(_points(F.col("fp"))).alias("point")).groupBy("point").agg(F.collect_set("fp").alias("of")).filter(F.size("of") > 1)
    stars = shared.select(F.array_min("of").alias("a"), F.explode("of").alias("b")).filter("a < b")
    return pairs.union(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(fp, root) for all nodes of edges (a, b); root is the least node reachable."""
    both = staged(edges.select(F.col("a").alias("fp"), F.col("b").alias("to")).union(edges.select("b", "a")))
    label = staged(both.groupBy("fp").agg(F.min("to").alias("root")).select("fp", F.least("fp", "root").alias("root")))
    before = None
    for _ in range(max_rounds):
        now = label.agg(F.count("*"), F.sum(F.col("root").cast("decimal(38,0)"))).first()
        if now == before:
            return label
        before = now
        offers = both.join(label.withColumnRenamed("fp", "to"), "to").select("fp", "root")
        least = offers.union(label).groupBy("fp").agg(F.min("root").alias("root"))
        jump = label.select(F.col("fp").alias("root"), F.col("root").alias("far"))
        label = staged(least.join(jump, "root", "left").select("fp", F.least("root", "far").alias("root")))
    raise RuntimeError("components did not settle")


def groups(docs: DataFrame, max_bits: int = 2, doc_id: str = "doc_id", fp: str = "simhash") -> DataFrame:
    """Rows (doc_id, simhash) of a table that can be read again, with component_id."""
    nodes = staged(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("rep"), F.count("*").alias("n")))
    root = components(links(nodes.select("fp"), max_bits))
    least = root.join(nodes, "fp").groupBy("root").agg(F.min("rep").alias("component_id"))
    of = root.join(least, "root").select("fp", "component_id")
    every = nodes.join(of, "fp", "left").select(F.col("fp").alias(fp), F.coalesce("component_id", "rep").alias("component_id"), "n")
    return spread_join(docs, every, [fp], "n", [doc_id])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and component. XXH64 is not in the SQL dialect: tested against brute force."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = groups(staged(fingerprints(docs).select("doc_id", "simhash")))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")
