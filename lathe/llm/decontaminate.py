"""Operator 10: benchmark decontamination by n-gram seeds and Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased. Benchmark items are a query
set: they are read in blocks of at most `BLOCK_WORDS` words (all blocks, one
after another), so what is sent to the executors has a fixed bound; usually
there is one block.

For each block, one scan finds the 3-grams of its items, common or rare, in every
document; each hit opens a window around where the item would lie and overlapping
windows of an item are merged. A window with fewer words of the item than the
least score takes is passed over; with any other the item is aligned by
Smith-Waterman (match 2, mismatch and gap -1). The score is the best alignment
over the item's perfect score.

Documents are never shuffled and never paired with each other; a task holds one
slice of documents, the block's items and seeds.

Defined cases: a null or empty text, and an item of fewer than three words, match
nothing; equal items are separate items; repeated rows give repeated results;
columns that clash are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lathe.llm.arrow import slices, texts
from lathe.llm.common import session, table, text_of

WORD = re.compile(r"[^\W_]+")
N, BLOCK_WORDS, LEAST = 3, 1_000_000, 0.5
_POSITIVE = np.int64((1 << 63) - 1)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Items:
    """A block of items: their words as numbers (from 1; 0 is any other word) and their 3-grams."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.ids = [i for i, _ in rows]
        self.number: dict[str, int] = {}
        self.words = [np.array([self.number.setdefault(w, len(self.number) + 1) for w in ws], np.int64) for _, ws in rows]
        self.base = len(self.number) + 1
        self.grams = [self.codes(w) for w in self.words]
        self.all = np.unique(np.concatenate([*self.grams, np.zeros(0, np.int64)]))

    def codes(self, w: np.ndarray) -> np.ndarray:
        """The 3-grams of some words; -1 where one of them is in no item."""
        if w.size < N:
            return np.zeros(0, np.int64)
        # Beyond two million words codes wrap and may meet, which gives more hits to align and loses none.
        code = ((w[:-2] * self.base + w[1:-1]) * self.base + w[2:]) & _POSITIVE
        return np.where((w[:-2] > 0) & (w[1:-1] > 0) & (w[2:] > 0), code, -1)

    def numbers(self, text: str) -> np.ndarray:
        get = self.number.get
        return np.array([get(w, 0) for w in WORD.findall(text.lower())], np.int64)


def _at(sorted_: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which codes are in a sorted array, and where there."""
    where = np.flatnonzero(codes >= 0)
    if not sorted_.size or not where.size:
        return where[:0], where[:0]
    place = np.searchsorted(sorted_, codes[where])
    place[place == sorted_.size] = 0
    real = sorted_[place] == codes[where]
    return where[real], place[real]


def _rows(item: np.ndarray, window: np.ndarray, local: bool) -> Iterator[np.ndarray]:
    """The rows of an alignment, one for each word of the item; a local one may begin anywhere, any other at the beginning of both."""
    slope = np.arange(window.size + 1)
    row = np.zeros(window.size + 1, np.int64) if local else -slope
    for k, w in enumerate(item):
        now = np.full_like(row, 0 if local else -k - 1)
        now[1:] = np.maximum(row[:-1] + np.where(window == w, 2, -1), row[1:] - 1)
        now = np.maximum.accumulate(now + slope) - slope  # gaps in the item: -1 for each step right
        row = np.maximum(now, 0) if local else now
        yield row


def align(item: np.ndarray, window: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman: the best local score over the perfect score, and where in the window it begins and ends.

    Of several the one that ends first in the item, then in the window; where it
    begins is found by aligning backwards from there, the shortest of equals.
    """
    best, until, end = 0, 0, 0
    for k, row in enumerate(_rows(item, window, True), 1):
        if (top := int(row.max())) > best:
            best, until, end = top, k, int(row.argmax())
    begin = end
    if best:
        back = (row == best for row in _rows(item[:until][::-1], window[:end][::-1], False))
        begin = end - min(int(hit.argmax()) for hit in back if hit.any())
    return best / (2 * item.size), begin, end


def _words_in(item: np.ndarray, window: np.ndarray) -> int:
    """How many words of a window are words of the item: no alignment matches more."""
    return int(np.isin(window, item).sum())


def _windows(at: list[tuple[int, int]], length: int, size: int) -> list[tuple[int, int]]:
    """Merged stretches of a document in which an item with hits (position, offset) may lie."""
    slack = length // 4 + N
    out: list[tuple[int, int]] = []
    for a in sorted({p - o for p, o in at}):
        b = (max(0, a - slack), min(size, a + length + slack))
        if out and b[0] <= out[-1][1]:
            out[-1] = (out[-1][0], b[1])
        else:
            out.append(b)
    return out


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    block: list[tuple[int, list[str]]] = []
    held = 0
    for r in items.select(F.col(item_id).alias("i"), text_of(text).alias("t")).orderBy("i", "t").toLocalIterator():
        words = words_of(r["t"])
        if len(words) < N:
            continue
        if block and held + len(words) > BLOCK_WORDS:
            yield Items(block)
            block, held = [], 0
        block.append((r["i"], words))
        held += len(words)
    if block:
        yield Items(block)


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: float = LEAST) -> DataFrame:
    """Rows (doc_id, item_id, score, first_word, end_word): items that align with a document at `least` or more, each at its best place (words first_word to end_word, the first of equals)."""
    spark = session(docs)
    kind = docs.schema[doc_id].dataType.simpleString()
    of_item = items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {of_item}, score double, first_word long, end_word long"
    item_kind = to_arrow_type(items.schema[item_id].dataType)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    found = None
    for block in _blocks(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(block)

        seeds = _seeds(block)
        shared_seeds = spark.sparkContext.broadcast(seeds)

        def search(batches: Iterator[pa.RecordBatch], shared=shared, shared_seeds=shared_seeds) -> Iterator[pa.RecordBatch]:
            block, (codes, posts) = shared.value, shared_seeds.value
            for batch in slices(batches, "text"):
                out: list[tuple] = []
                for key, x in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                    w = block.numbers(x)
                    hits = defaultdict(list)
                    for p, s in zip(*(y.tolist() for y in _at(codes, block.codes(w)))):
                        for k, o in posts[s]:
                            hits[k].append((p, o))
                    for k, at in hits.items():
                        item = block.words[k]
                        spans = [(a, b) for a, b in _windows(at, item.size, w.size) if _words_in(item, w[a:b]) >= least * item.size]
                        score, begin, end = max(((s, a + b, a + e) for a, z in spans for s, b, e in [align(item, w[a:z])]), key=lambda x: (x[0], -x[1]), default=(-1.0, 0, 0))
                        if score >= least:
                            out.append((key, block.ids[k], score, begin, end))
                kinds = [batch.schema.field("doc_id").type, item_kind, pa.float64(), pa.int64(), pa.int64()]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "item_id", "score", "first_word", "end_word"])

        part = rows.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _seeds(block: Items) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """The block's 3-grams, sorted, and for each its (item, offset) postings."""
    posts = defaultdict(list)
    for k, grams in enumerate(block.grams):
        for o, c in enumerate(grams.tolist()):
            posts[c].append((k, o))
    return block.all, [posts[c] for c in block.all.tolist()]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items. Tested against alignment of every pair on a small fixture."""
    return matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
