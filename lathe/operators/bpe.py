"""Byte-pair vocabularies: counting, choosing, learning, encoding, decoding.

Learning works on a table of segments, packed arrays of token ids. A round
applies the rules learned since the table was last written, counts adjacent
pairs in each task with numpy, and sums the counts in Spark; the best pairs, a
bounded few, reach the driver; in bounded mode a job may find several
rules at once (see `_Learner.best`). Every `REWRITE` rounds the segments are
written anew, so neither the plan nor the work of a round grows with the number
of rules.

Three modes, which learn different vocabularies:

* document-bounded: pairs never cross documents;
* joined: the corpus is one sequence, documents in order with a separator
  between them. It is kept as consecutive segments; pairs that cross from one
  segment to the next are counted and merged too (a summary row per segment
  tells the driver its ends), so the result is that of one long sequence;
* per-document fold: documents one after another, each continuing from the rules
  learned before.

Ties go to the pair that occurs first: least (document, position) in the current
sequences. A second scan for that is made only when there is a tie.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lathe.functions import seq as S
from lathe.sources.staging import session, staged

BASE = 256
#: Rounds between two writings of the segments, and ids of a joined segment.
REWRITE, SEGMENT_IDS = 16, 32 << 20
#: Best pairs looked at for ties in the first place, and rules guessed ahead in bounded mode.
TIES, AHEAD = 64, 4
#: Up to this vocabulary pairs are counted in a dense table.
DENSE = 2048


@dataclass(frozen=True)
class Tokenizer:
    """Merge rules in rank order; everything else follows from them."""

    merges: tuple[S.Merge, ...] = ()

    @property
    def vocab_size(self) -> int:
        return BASE + len(self.merges)

    def vocab(self) -> dict[int, bytes]:
        out = {i: bytes([i]) for i in range(BASE)}
        for a, b, n in self.merges:
            out[n] = out[a] + out[b]
        return out

    def encode(self, text: Column) -> Column:
        """A text column as a sequence."""
        return S.encode(text, self.merges)

    def decode(self, sequence: Column) -> Column:
        return S.decode(sequence, self.merges)

    def rules_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(k, *m) for k, m in enumerate(self.merges)], "rank int, left_id int, right_id int, new_id int")

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        """(token_id, bytes): the base rows are made by Spark, the learned ones are as many as there are rules."""
        learned = spark.createDataFrame([(i, bytearray(b)) for i, b in self.vocab().items() if i >= BASE], "token_id int, bytes binary")
        return base_vocab(spark).union(learned)

    def save(self, spark: SparkSession, path: str) -> None:
        self.rules_table(spark).write.parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Tokenizer:
        rows = spark.read.parquet(path).orderBy("rank").collect()
        return Tokenizer(tuple((r["left_id"], r["right_id"], r["new_id"]) for r in rows))


def base_vocab(spark: SparkSession) -> DataFrame:
    return spark.range(BASE).select(F.col("id").cast("int").alias("token_id"), F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("bytes"))


# Columns only: the operators on a table of sequences.


def pairs(df: DataFrame, ids: str = "ids") -> DataFrame:
    """(doc_id, pos, l, r): adjacent pairs, overlapping."""
    a, n = F.col(ids), F.size(ids)
    zipped = F.arrays_zip(F.slice(a, 1, n - 1).alias("l"), F.slice(a, 2, n - 1).alias("r"))
    return df.filter(n > 1).select("doc_id", F.posexplode(zipped).alias("pos", "p")).select("doc_id", "pos", F.col("p.l").alias("l"), F.col("p.r").alias("r"))


def pair_counts(df: DataFrame, ids: str = "ids") -> DataFrame:
    """(l, r, n): how often each pair occurs; counted with numpy in each batch, then summed. A null array has no pairs."""
    session(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0)
            flat, sizes = own.flatten().to_numpy().astype(np.int64), pc.fill_null(pc.list_value_length(own), 0).to_numpy()
            inside = np.ones(max(flat.size - 1, 0), bool)
            last = np.cumsum(sizes)[sizes > 0] - 1
            inside[last[last < inside.size]] = False
            code, n = np.unique((flat[:-1] << 32 | flat[1:])[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((code >> 32).astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(n)], ["l", "r", "n"])

    return df.select(F.col(ids).cast("array<int>")).mapInArrow(run, "l int, r int, n long").groupBy("l", "r").agg(F.sum("n").alias("n"))


def best_pair(df: DataFrame, min_frequency: int = 2, ids: str = "ids") -> DataFrame:
    """The most frequent pair (l, r, n), the first seen of several; no row if it is under the threshold.

    Places are looked up only for pairs with the greatest count, so the counting
    itself stays a hash aggregate.
    """
    counts = pair_counts(df, ids)
    top = counts.join(counts.agg(F.max("n").alias("n")), "n").filter(F.col("n") >= min_frequency)
    places = pairs(df, ids).join(top, ["l", "r"]).groupBy("l", "r", "n").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    return places.orderBy("first").limit(1).select("l", "r", "n")


def decode_ids(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids") -> DataFrame:
    """(doc_id, text) of arrays of ids: each is looked up in the vocabulary, a literal, where the row is; an unknown id is an error."""
    vocabulary = F.from_json(F.lit(json.dumps([b.hex() for _, b in sorted(tokenizer.vocab().items())])), "array<string>")
    unknown = lambda i: F.raise_error(F.concat(F.lit("no such token: "), i.cast("string"))).cast("string")
    surface = lambda i: F.when((i >= 0) & (i < tokenizer.vocab_size), F.get(vocabulary, i)).otherwise(unknown(i))
    return df.select("doc_id", F.decode(F.unhex(F.array_join(F.transform(ids, surface), "")), "UTF-8").alias("text"))


# Learning.


def apply_rule(s: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    """One left-to-right pass of a rule without overlaps."""
    if s.size < 2:
        return s
    at = np.flatnonzero((s[:-1] == a) & (s[1:] == b))
    if not at.size:
        return s
    if a == b:
        apart = np.concatenate([[True], np.diff(at) != 1])
        begin = np.maximum.accumulate(np.where(apart, np.arange(at.size), 0))
        at = at[(np.arange(at.size) - begin) % 2 == 0]
    keep = np.ones(s.size, bool)
    keep[at + 1] = False
    s = s.copy()
    s[at] = new
    return s[keep]


@dataclass(frozen=True)
class _Step:
    """A rule, and the segments that lose their first token to it or whose last token it turns into the new one."""

    rule: S.Merge
    drop: frozenset = frozenset()
    take: frozenset = frozenset()

    def on(self, key: int, s: np.ndarray) -> np.ndarray:
        if key in self.drop:
            s = s[1:]
        s = apply_rule(s, *self.rule)
        if key in self.take:
            s = np.append(s[:-1], self.rule[2]).astype(s.dtype)
        return s


SEGMENT = "key long, seq binary"
#: Counts of pairs after so many guessed rules, or (with ends) what is told of a segment.
PARTIAL = "step long, code long, n long, ends array<bigint>"


def _end_rows(keys: list[int], flat: np.ndarray, stops: np.ndarray) -> Iterator[pa.RecordBatch]:
    s = flat[: stops[0]]
    if s.size:
        other, last = np.flatnonzero(s != s[0]), np.flatnonzero(s != s[-1])
        row = [keys[0], s.size, int(s[0]), int(other[0]) if other.size else s.size, int(s[-1]), int(s.size - 1 - last[-1]) if last.size else s.size]
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, pa.array([row], pa.list_(pa.int64()))], ["step", "code", "n", "ends"])


def _sorted_ends(df: DataFrame) -> list[dict]:
    names = ("key", "n", "first", "first_run", "last", "last_run")
    return sorted((dict(zip(names, r["ends"])) for r in df.filter("ends is not null").select("ends").collect()), key=lambda x: x["key"])


def _segments(batches: Iterator[pa.RecordBatch], steps: Sequence[_Step], bounded: bool, kind: type) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Keys, ids and lengths of some segments, after the steps. Bounded segments are handled many at once."""
    for batch in batches:
        keys = batch.column("key").to_pylist()
        raw = [x or b"" for x in batch.column("seq").to_pylist()]
        parts, end = [np.frombuffer(x, kind) for x in raw], _end(kind)
        if bounded:
            # A separator that is in no rule keeps documents apart.
            flat = np.concatenate([y for x in parts for y in (x, end)]) if parts else end[:0]
            for step in steps:
                flat = apply_rule(flat, *step.rule)
            ends = np.flatnonzero(flat == end)
            yield keys, flat, ends
        else:
            for key, s in zip(keys, parts):
                for step in steps:
                    s = step.on(key, s)
                yield [key], np.append(s, end), np.array([s.size])


def _kind(vocab_size: int) -> type:
    """The numbers that segments are kept in: the narrower, the less is read in each round."""
    return np.uint16 if vocab_size < np.iinfo(np.uint16).max else np.int32


def _end(kind: type) -> np.ndarray:
    """What stands behind each document; no token."""
    return np.array([np.iinfo(kind).max], kind)


def _codes(flat: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of each adjacent pair, and whether both are tokens."""
    token = flat != np.iinfo(flat.dtype).max
    return flat[:-1].astype(np.int64) * base + flat[1:], token[:-1] & token[1:]


def _pairs(flat: np.ndarray, base: int) -> np.ndarray:
    code, real = _codes(flat, base)
    return code[real]


class _Learner:
    def __init__(self, segments: DataFrame, tokenizer: Tokenizer, bounded: bool, kind: type):
        self.segments, self.bounded, self.kind = segments, bounded, kind
        self.merges = list(tokenizer.merges)
        self.steps: list[_Step] = []
        self.guesses: list[tuple[int, int]] = []

    def _map(self, run, schema: str) -> DataFrame:
        steps, bounded, kind = tuple(self.steps), self.bounded, self.kind
        return self.segments.mapInArrow(lambda batches: run(_segments(batches, steps, bounded, kind)), schema)

    def write(self) -> None:
        """Write the segments as they are now."""
        if not self.steps:
            return

        def run(parts):
            for keys, flat, ends in parts:
                starts = np.concatenate([[0], ends[:-1] + 1])
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([flat[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], ["key", "seq"])

        self.segments = staged(self._map(run, SEGMENT))
        self.steps = []

    def ends(self) -> list:
        """Of each segment in order: key, length, first token and its run, last token and its run."""
        return _sorted_ends(self._map(lambda parts: (r for keys, flat, stops in parts for r in _end_rows(keys, flat, stops)), PARTIAL))

    def best(self, least: int, most: int) -> list[tuple[int, int, int, list]]:
        """The next rules, one at least unless no pair is frequent enough, `most` at most.

        In bounded mode the tasks also count what follows if the next rules are
        those guessed: as long as a guess proves right, the counts behind it give
        another rule without another job.
        """
        base = BASE + len(self.merges)
        guessed = self.guesses[: min(AHEAD, most - 1)] if self.bounded and base + AHEAD <= DENSE else []
        base += len(guessed)  # one for all counts of the job
        first = BASE + len(self.merges)

        def run(parts):
            dense = np.zeros((len(guessed) + 1, base * base), np.int64) if base <= DENSE else None
            sparse: list[tuple[np.ndarray, np.ndarray]] = []
            for keys, flat, stops in parts:
                if not bounded:
                    yield from _end_rows(keys, flat, stops)
                if dense is None:
                    sparse.append(np.unique(_pairs(flat, base), return_counts=True))
                    continue
                for k in range(len(guessed) + 1):
                    if k:
                        flat = apply_rule(flat, *guessed[k - 1], first + k - 1)
                    code = _pairs(flat, base)
                    if code.size * 8 > dense.shape[1]:
                        dense[k] += np.bincount(code, minlength=dense.shape[1])
                    else:
                        np.add.at(dense[k], code, 1)
            if dense is not None:
                step, code = np.nonzero(dense)
                n = dense[step, code]
            else:
                every = np.concatenate([c for c, _ in sparse]) if sparse else np.zeros(0, np.int64)
                code, back = np.unique(every, return_inverse=True)
                n = np.bincount(back, np.concatenate([k for _, k in sparse]), code.size).astype(np.int64) if sparse else code
                step = np.zeros(code.size, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int64()), pa.array(code), pa.array(n), pa.nulls(len(code), pa.list_(pa.int64()))], ["step", "code", "n", "ends"])

        bounded = self.bounded
        partial = self._map(run, PARTIAL)
        if bounded:
            return self._choose(partial, base, least, [], guessed)
        partial = partial.persist()  # read twice; a lost part is computed again
        try:
            ends = _sorted_ends(partial)
            crossing = [(0, x["last"] * base + y["first"], 1) for x, y in zip(ends, ends[1:])]
            own = partial.filter("ends is null").select("step", "code", "n")
            return self._choose(own.union(own.sparkSession.createDataFrame(crossing, "step long, code long, n long")) if crossing else own, base, least, ends, [])
        finally:
            partial.unpersist()

    def _choose(self, partial: DataFrame, base: int, least: int, ends: list, guessed: list) -> list[tuple[int, int, int, list]]:
        counts = partial.groupBy("step", "code").agg(F.sum("n").alias("n"))
        if guessed:
            place = F.row_number().over(Window.partitionBy("step").orderBy(F.col("n").desc(), "code"))
            rows = counts.withColumn("place", place).filter(F.col("place") <= TIES).collect()
        else:
            rows = counts.orderBy(F.col("n").desc(), "code").limit(TIES).collect()
        found: list[tuple[int, int, int, list]] = []
        for k in range(len(guessed) + 1):
            top = sorted(((r["n"], r["code"]) for r in rows if r["step"] == k), key=lambda x: (-x[0], x[1]))
            if not top or top[0][0] < least:
                break
            n = top[0][0]
            tied = [c for m, c in top if m == n]
            if len(tied) > 1:
                if k:
                    break  # the first place is looked up in the segments as they are: by the next job
                if len(tied) == TIES:
                    tied = [r["code"] for r in counts.filter((F.col("step") == 0) & (F.col("n") == n)).select("code").collect()]
            code = tied[0] if len(tied) == 1 else self._first(sorted(tied), base, ends)
            pair = (code // base, code % base)
            found.append((*pair, n, ends))
            # Pairs that this rule does not touch are likely to be the next ones.
            self.guesses = [(c // base, c % base) for _, c in top if c // base != pair[1] and c % base != pair[0] and c != code]
            if k == len(guessed) or pair != guessed[k]:
                break
        return found

    def _first(self, tied: list[int], base: int, ends: list) -> int:
        """The tied pair that occurs first."""
        want = np.array(tied, np.int64)

        def run(parts):
            best: dict[int, tuple[int, int]] = {}
            for keys, flat, stops in parts:
                code, real = _codes(flat, base)
                code[~real] = -1
                hit = np.flatnonzero(np.isin(code, want))
                which = np.searchsorted(stops, hit)
                starts = np.concatenate([[0], stops[:-1] + 1])
                for c in want.tolist():
                    own = np.flatnonzero(code[hit] == c)
                    for k in own[np.concatenate([[True], np.diff(which[own]) != 0])] if own.size else []:
                        place = (keys[which[k]], int(hit[k] - starts[which[k]]))
                        best[c] = min(best.get(c, place), place)
            if best:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*((c, *p) for c, p in best.items()))], ["code", "key", "pos"])

        places = {r["code"]: (r["p"]["key"], r["p"]["pos"]) for r in self._map(run, "code long, key long, pos long").groupBy("code").agg(F.min(F.struct("key", "pos")).alias("p")).collect()}
        for x, y in zip(ends, ends[1:]):
            c = int(x["last"]) * base + int(y["first"])
            if c in set(tied):
                place = (x["key"], x["n"] - 1)
                places[c] = min(places.get(c, place), place)
        return min(tied, key=lambda c: places[c])

    def add(self, a: int, b: int, ends: list) -> None:
        new = BASE + len(self.merges)
        drop, take = set(), set()
        waiting = None  # a segment before whose last token is a left one without its right
        for x in ends:
            gone = waiting is not None and x["first"] == b
            if gone:
                drop.add(x["key"])
                take.add(waiting)
            left = x["n"] - gone
            if not left:
                waiting = None
            elif x["last"] != a:
                waiting = None
            elif a != b:
                waiting = x["key"]
            else:
                run = left if x["last_run"] == x["n"] else x["last_run"]
                waiting = x["key"] if run % 2 else None
        self.merges.append((a, b, new))
        self.steps.append(_Step((a, b, new), frozenset(drop), frozenset(take)))

    def learn(self, vocab_size: int, least: int) -> list[int]:
        """Learn until the vocabulary is full or no pair is frequent enough; the count of each new rule."""
        found = []
        while BASE + len(self.merges) < vocab_size:
            best = self.best(least, vocab_size - BASE - len(self.merges))
            if not best:
                break
            for a, b, n, ends in best:
                self.add(a, b, ends)
                found.append(n)
            if len(self.steps) >= REWRITE:
                self.write()
        return found


def _packed(df: DataFrame, merges: Sequence[S.Merge], kind: type) -> DataFrame:
    """Documents as bounded segments, dealt out over the session's cores."""

    def run(batches):
        for batch in batches:
            parts = [np.frombuffer((x or "").encode(), np.uint8).astype(kind) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([_rules(p).tobytes() for p in parts], pa.binary())], ["key", "seq"])

    def _rules(s):
        for m in merges:
            s = apply_rule(s, *m)
        return s

    return df.mapInArrow(run, SEGMENT)


def _joined(df: DataFrame, separator: str, kind: type) -> DataFrame:
    """The corpus as consecutive segments, in order of doc_id; keys follow that order."""
    gap = np.frombuffer(separator.encode(), np.uint8).astype(kind)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")

    def run(batches):
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for x in batch.column("text").to_pylist():
                # The separator stands before each document; the very first one's is cut off by the caller.
                held += [gap, np.frombuffer((x or "").encode(), np.uint8).astype(kind)]
                size += held[-1].size + gap.size
                if size >= SEGMENT_IDS:
                    yield _one(part, k, held)
                    k, held, size = k + 1, [], 0
        if held:
            yield _one(part, k, held)

    def _one(part, k, held):
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | k], pa.int64()), pa.array([np.concatenate(held).tobytes()], pa.binary())], ["key", "seq"])

    return ordered.mapInArrow(run, SEGMENT)


def train(df: DataFrame, vocab_size: int, min_frequency: int = 2, mode: str = "document_bounded", init: Tokenizer | None = None, separator: str = "\n\n") -> tuple[Tokenizer, list[int]]:
    """Learn from a corpus (doc_id, text); the tokenizer and the count of each rule when it was learned.

    With `init` learning goes on from its rules. The order of documents is that
    of doc_id.
    """
    init = init or Tokenizer()
    session(df)
    kind = _kind(max(vocab_size, init.vocab_size))
    df = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if mode == "document_bounded":
        cores = df.sparkSession.sparkContext.defaultParallelism
        dealt = df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
        learner = _Learner(staged(_packed(dealt, init.merges, kind)), init, True, kind)
    elif mode == "joined":
        learner = _Learner(staged(_joined(df, separator, kind)), init, False, kind)
        first = learner.segments.agg(F.min("key")).first()[0]
        cut = len(separator.encode()) * np.dtype(kind).itemsize
        if first is not None:
            body = F.when(F.col("key") == first, F.substring("seq", cut + 1, 2**31 - 1)).otherwise(F.col("seq"))
            learner.segments = staged(learner.segments.select("key", body.alias("seq")))
        for m in init.merges:
            rules, learner.merges = learner.merges, learner.merges[: m[2] - BASE]
            learner.add(m[0], m[1], learner.ends())
            learner.merges = rules
            if len(learner.steps) >= REWRITE:
                learner.write()
    elif mode == "per_document_fold":
        return _fold(df, vocab_size, min_frequency, init)
    else:
        raise ValueError(f"no such mode: {mode}")
    counts = learner.learn(vocab_size, min_frequency)
    return Tokenizer(tuple(learner.merges)), counts


def train_one(text: str, vocab_size: int, min_frequency: int, init: Tokenizer) -> tuple[Tokenizer, list[int]]:
    """Learn from one text in this process: a step of the fold."""
    s = np.frombuffer(text.encode(), np.uint8).astype(np.int32)
    merges, found = list(init.merges), []
    for m in merges:
        s = apply_rule(s, *m)
    while BASE + len(merges) < vocab_size and s.size > 1:
        base = BASE + len(merges)
        code, at, n = np.unique(s[:-1].astype(np.int64) * base + s[1:], return_index=True, return_counts=True)
        if n.max() < min_frequency:
            break
        top = np.flatnonzero(n == n.max())
        c = int(code[top[at[top].argmin()]])
        merges.append((c // base, c % base, base))
        found.append(int(n.max()))
        s = apply_rule(s, *merges[-1])
    return Tokenizer(tuple(merges)), found


def _fold(df: DataFrame, vocab_size: int, min_frequency: int, init: Tokenizer) -> tuple[Tokenizer, list[int]]:
    """Documents in order, one at a time from the cluster; stops once the vocabulary is full."""
    tokenizer, counts = init, []
    for r in df.orderBy("doc_id").toLocalIterator():
        if tokenizer.vocab_size >= vocab_size:
            break
        tokenizer, found = train_one(r["text"] or "", vocab_size, min_frequency, tokenizer)
        counts += found
    return tokenizer, counts
