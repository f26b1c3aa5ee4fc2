"""Arrow helpers for the mapInArrow operators: bounded slices, and a table of distinct chunks."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once in a Python worker; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about `limit` bytes of a text or binary column, one row at least."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64) + 16)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def with_columns(batch: pa.RecordBatch, **more: pa.Array) -> pa.RecordBatch:
    """A batch with columns appended; columns of the same names are replaced."""
    names = [x for x in batch.schema.names if x not in more]
    return pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *more.values()], [*names, *more])


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces flat[start:start+length], one behind the other."""
    total = int(length.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(length)
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


class ChunkTable(dict):
    """Distinct chunks by number, with the ids of each; a new chunk is segmented once.

    `segment` turns a list of chunks into all their ids and the number of each. Over
    `most` chunks the table keeps only those used most, half of them at
    most, so it never outgrows a worker.
    """

    def __init__(self, segment: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int):
        super().__init__()
        self.segment, self.most = segment, most
        self.new: list[str] = []
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.uses = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _shrink(self) -> None:
        uses = self.uses[: len(self)]
        least = max(2, int(np.partition(uses, -(self.most // 2))[-(self.most // 2)]) + 1)
        kept = np.flatnonzero(uses >= least)
        names = list(self)
        self.clear()
        for n, k in enumerate(kept.tolist()):
            self[names[k]] = n
        size = self.length[kept]
        flat = gather(self.flat, self.start[kept], size)
        self.flat[: flat.size], self.used = flat, flat.size
        self.start[: kept.size], self.length[: kept.size] = np.cumsum(size) - size, size
        self.uses[: kept.size] = uses[kept] // 2
        self.uses[kept.size :] = 0

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n

    def _segment_new(self) -> None:
        if not self.new:
            return
        more, sizes = self.segment(self.new)
        first = len(self) - len(self.new)
        while self.start.size < len(self):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        while self.flat.size < self.used + more.size:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[first : len(self)] = self.used + np.cumsum(sizes) - sizes
        self.length[first : len(self)] = sizes
        self.flat[self.used : self.used + more.size] = more
        self.used += more.size
        self.new = []

    def ids(self, chunks: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some documents' chunks, and each document's number of ids."""
        # Many short lists live for a moment; none is part of a cycle, so looking for cycles meanwhile is in vain.
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._ids(chunks)
        finally:
            if collecting:
                gc.enable()

    def _ids(self, chunks: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self._shrink()
        counts = np.fromiter(map(len, chunks), np.int64, len(chunks))
        total = int(counts.sum())
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(chunks)), np.int64, total)
        self._segment_new()
        self.uses[: len(self)] += np.bincount(at, minlength=len(self))
        sizes = self.length[at]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        return gather(self.flat, self.start[at], sizes), sums[ends] - sums[ends - counts]
