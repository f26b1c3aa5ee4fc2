"""Near-duplicates of the pipeline: all pairs of shingle sets at Jaccard similarity 0.8 or more.

SimHash goes first: sets whose fingerprints meet in pigeonhole blocks and are
within two bits are candidates (`simhash.links`), verified like all others. Two
bits reach few pairs near 0.8, so a prefix filter, which is exact, completes
them: with all shingles in one global order, two
sets of similarity 4/5 share a shingle among the first n - ceil(4n/5) + 1 of
each. The order is by hash, behind which come the commonest shingles of a sample
of the documents (`DEMOTED` at most, commonest last); any order is exact, this
one keeps the lists of a shingle short. Sizes and the position of the first
shared shingle rule out pairs that cannot reach the overlap (a pair meets under
its first shared shingle too, so others may be held to the same bound); all that
are left are verified on their whole sets.

Lists of up to `CROWDED` sets give all their pairs. A longer list first gives
the pairs with its `LEADERS` sets of the fewest rarer shingles; where its sets are then not one
component, all pairs of it between different components follow. So no pair that
could join two components is left out, and a group of copies costs no square.

Words are split and lower-cased as for SimHash; a text of fewer words than a
shingle is one shingle, a text without words the empty set. Equal sets are one
node, named by a 64-bit hash. A document is (id, hash of its text).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.arrow import slices, texts
from lathe.llm.common import session, sieved, staged, text_of
from lathe.llm.simhash import bits_of, components, links

CROWDED, LEADERS, DEMOTED = 16, 4, 200_000
#: One document in SAMPLED is counted for the order, and shingles that OFTEN of them have are common.
SAMPLED, OFTEN = 8, 3
SKETCH = ["p0", "p1", "p2", "p3"]


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct hashes of a text's word shingles, in order."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # ASCII only, as in simhash.fingerprint
    if not words:
        return np.zeros(0, np.int64)
    grams = map(b" ".join, zip(*(words[k:] for k in range(width)))) if len(words) >= width else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxh64_intdigest, grams, repeat(42)), np.uint64, max(1, len(words) - width + 1)).view(np.int64))


def node(found: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    x = xxh64_intdigest(found.tobytes(), 7)
    return x - (1 << 64) if x >> 63 else x


def _prefix(found: np.ndarray, common: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first n - ceil(4n/5) + 1 of a set, common shingles last."""
    n = found.size
    size = n - (4 * n + 4) // 5 + 1 if n else 0
    if common.size and n:
        at = np.minimum(np.searchsorted(common, found), common.size - 1)
        weight = np.where(common[at] == found, count[at], 0)
        if weight.any():
            return found[np.lexsort((found, weight))[:size]]
    return found[:size]


def sketch(found: np.ndarray) -> np.ndarray:
    """For each value of the low 8 bits whether an odd number of shingles has it, as four longs."""
    return np.packbits((np.bincount(found & 255, minlength=256) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(a.size for a in arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]), pa.int64()))


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles of a sample, sorted, with their counts: at most DEMOTED. They only set the order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(x, width) for x in set(texts(batch, "text"))]
            values, counts = np.unique(np.concatenate([*sets, np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], ["s", "n"])

    sample = docs.filter(F.col("h") % SAMPLED == 0).select("text")
    counted = sample.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    rows = counted.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "s").limit(DEMOTED).collect()
    rows.sort()
    return np.array([r["s"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def _may_reach() -> Column:
    """Whether sizes (na, nb) and positions from 1 (ia, ib) allow 0.8, the shared shingle being the pair's first one."""
    na, nb, ia, ib = (F.col(x) for x in ("na", "nb", "ia", "ib"))
    sizes = (5 * na >= 4 * nb) & (5 * nb >= 4 * na)
    # A shingle that only one of the two has changes one bit of the sketch at most.
    apart = sum((F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in SKETCH), F.lit(0))
    return sizes & (9 * apart <= na + nb) & (9 * (1 + F.least(na - ia, nb - ib)) >= 4 * (na + nb))


def _pairs(left: DataFrame, right: DataFrame, *more: str, leads: bool = False) -> DataFrame:
    more = (*more, *SKETCH)
    a = left.select("s", F.col("node").alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), *(F.col(x).alias(f"{x}_a") for x in more))
    b = right.select("s", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), *(F.col(x).alias(f"{x}_b") for x in more))
    return a.join(b, "s").filter("a <> b" if leads else "a < b").filter(_may_reach()).withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes within two bits: of equal fingerprints each with the least node, of close ones the two least."""
    least = staged(nodes.groupBy("fp").agg(F.min("node").alias("least")))
    equal = nodes.select("fp", "node").join(least, "fp").filter("node > least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    ends = links(least.select("fp")).join(least.select(F.col("fp").alias("a"), F.col("least").alias("x")), "a").join(least.select(F.col("fp").alias("b"), F.col("least").alias("y")), "b")
    return equal.union(ends.select(F.least("x", "y"), F.greatest("x", "y")))


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """Those of some pairs (a, b) of nodes whose sets are 0.8 alike or more."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    reps = staged(nodes.join(needed, "node").select("node", F.col("rep.id").alias("rid"), F.col("rep.h").alias("rh")))
    docs = sieved(docs, reps.select(F.col("rid").alias("id"), F.col("rh").alias("h")), F.xxhash64("id", "h"), "met").filter("met").drop("met")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists([shingles(x, width) for x in texts(batch, "text")])], ["node", "of"])

    held = docs.join(reps, docs.id.eqNullSafe(reps.rid) & (docs.h == reps.rh)).select("node", "text")
    # Not written: both joins go on from the one exchange by node, and only the sets of `a` move again.
    sets = held.mapInArrow(run, "node long, of array<long>").groupBy("node").agg(F.any_value("of").alias("of"))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("of").alias("of_a")), "a").join(sets.select(F.col("node").alias("b"), F.col("of").alias("of_b")), "b")
    return both.filter(9 * F.size(F.array_intersect("of_a", "of_b")) >= 4 * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def firsts(docs: DataFrame, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, h) of the first document of each component of near-duplicates; h is xxhash64 of the text. `docs` can be read again."""
    session(docs)
    docs = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text_of(text)).alias("h"), text_of(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(_common(docs, width))

    def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(x, width) for x in texts(batch, "text")]
            names = pa.array([node(x) for x in sets], pa.int64())
            sizes = pa.array([x.size for x in sets], pa.int64())
            bits = [pa.array(x) for x in np.ascontiguousarray(np.array([sketch(x) for x in sets]).T)]
            fps = pa.array([bits_of(x.view(np.uint64)) if x.size else 0 for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), names, sizes, fps, _lists([_prefix(x, *shared.value) for x in sets]), *bits], ["id", "h", "node", "n", "fp", "prefix", *SKETCH])

    kind = docs.schema["id"].dataType.simpleString()
    marks = docs.mapInArrow(run, f"id {kind}, h long, node long, n long, fp long, prefix array<long>, {', '.join(f'{x} long' for x in SKETCH)}")
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    nodes = staged(marks.groupBy("node").agg(F.min(rep).alias("rep"), *(F.any_value(x).alias(x) for x in ("n", "fp", "prefix", *SKETCH))))

    posts = nodes.select("node", "n", F.posexplode("prefix").alias("at", "s")).select("node", "n", "s", (F.col("at") + 1).alias("i"))
    many = posts.groupBy("s").agg(F.count("*").alias("of")).filter("of > 1")
    met = staged(posts.join(many, "s").join(nodes.select("node", *SKETCH), "node"))
    few, crowd = met.filter(F.col("of") <= CROWDED), met.filter(F.col("of") > CROWDED)
    place = F.row_number().over(Window.partitionBy("s").orderBy("i", "node"))
    leads = staged(crowd.select("s", "i", "node").withColumn("place", place).filter(F.col("place") <= LEADERS).select("s", "node"))
    near = _pairs(crowd.join(leads, ["s", "node"]), crowd, leads=True)
    candidates = _by_fingerprint(nodes).union(_pairs(few, few).select("a", "b")).union(near.select("a", "b")).distinct()
    close = staged(_verified(staged(candidates), docs, nodes, width))
    root = components(close)

    named = crowd.join(root.withColumnRenamed("fp", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = named.groupBy("s").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("s")
    rest = staged(named.join(open_, "s").join(leads.withColumn("led", F.lit(True)), ["s", "node"], "left").filter("led is null").drop("led"))
    left = staged(_pairs(rest, rest, "root").filter("root_a <> root_b").select("a", "b").distinct())
    if not left.isEmpty():
        root = components(close.union(_verified(left, docs, nodes, width)))

    of = nodes.select("node", "rep").join(root.withColumnRenamed("fp", "node"), "node", "left")
    return of.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("rep").alias("rep")).select("rep.id", "rep.h")
