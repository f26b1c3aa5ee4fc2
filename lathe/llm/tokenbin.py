"""Operator 8: token ids as binary shards, compressed with a Re-Pair grammar.

Documents are dealt out by ranges of (doc_id, hash of text) and sorted, so the
shards, read in order of (part, shard), hold all ids in ascending doc_id order.
Ids come from the tokenizers library. Where the tokenizer file's own rules never
join what a blank or line end sets apart, each worker keeps a bounded table of
distinct blank-separated chunks and has the library encode each new one once;
with any other tokenizer whole texts go to the library.

A shard of about `SHARD_IDS` ids is compressed by itself: round after round the
frequent adjacent pairs become nonterminals and all occurrences are replaced, from
the commonest down, until no pair occurs `LEAST` times; rules and expansion
lengths are stored. No rule spans the end of a document, so each document is a run of
symbols that can be decoded alone.

File format of a shard, little-endian: magic ``RPG1``; eight unsigned 32-bit
sizes (documents, terminals, rules, rounds, symbols, bytes per symbol, ids,
end id); doc_ids (signed 64) and their null flags (one byte each); first symbol
of each document (32); terminals (32); left and right symbols of the rules (32);
first rule of each round (32); expansion lengths of all symbols (32); symbols.
Shards are rows (part, shard, n_docs, n_ids, data) of a Parquet table, which any
store that Spark reads can hold.

Defined cases: a null or empty text is the end id alone; null doc_ids come
first; documents of one doc_id are ordered by the hash of their text; equal rows
are interchangeable; other columns are not read.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lathe.llm.arrow import gather, slices, texts
from lathe.llm.common import session, shared_dir, table, text_of

MAGIC = b"RPG1"
BETWEEN = "<|endoftext|>"
SHARD_IDS = 1 << 20
END_ID = 1
#: Occurrences a pair needs, and how much rarer than the commonest a pair of the same round may be.
LEAST, SPREAD = 12, 16
#: Distinct chunks that a worker remembers.
CHUNKS = 500_000
# The rules of a tokenizer file under which blank-separated chunks can be encoded apart.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
SHARDS = "part int, shard int, n_docs long, n_ids long, data binary"


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order, and how often each occurs."""
    order = np.sort(code)
    at = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if order.size else np.zeros(0, np.int64)
    return order[at], np.diff(np.append(at, order.size))


def _marked(pairs: np.ndarray) -> np.ndarray:
    """A table over mixed bits: whether one of some pairs may be there."""
    table = np.zeros(1 << 20, bool)
    table[_mixed(pairs)] = True
    return table


def _taken(where: np.ndarray, after: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the places of pairs, in order, are replaced: of overlapping ones the commonest pair, so that copies of a passage are cut alike."""
    taken = np.zeros(where.size, bool)
    left = np.arange(where.size)
    while left.size:
        r = rank[left]
        close = after[left[:-1]] == where[left[1:]]
        same = close & (r[1:] == r[:-1])
        if same.any():  # of a run of one id, every other place
            begin = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(left.size), 0))
            left = left[(np.arange(left.size) - begin) % 2 == 0]
            continue
        no = np.zeros(1, bool)
        best = ~np.concatenate([no, close & (r[:-1] > r[1:])]) & ~np.concatenate([close & (r[1:] > r[:-1]), no])
        taken[left[best]] = True
        gone = best.copy()
        gone[1:] |= close & best[:-1]
        gone[:-1] |= close & best[1:]
        left = left[~gone]
    return taken


def compress(ids: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray, end_id: int = END_ID) -> bytes:
    """A shard of documents' ids (each ends with end_id) as bytes."""
    terminals, s = _numbered(ids)
    ends = np.zeros(s.size, bool)
    ends[np.cumsum(sizes) - 1] = True
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    first: list[int] = []
    used = terminals.size
    # Symbols stay where they are until the end; `after` and `before` lead from one that is left to the next.
    after, before = np.arange(1, s.size + 1, dtype=np.int32), np.arange(-1, s.size - 1, dtype=np.int32)
    left_over = np.ones(s.size, bool)
    # Places whose pair may be frequent: one that was not stays so unless a neighbour changes.
    live = np.ones(s.size, bool)
    live[-1:] = False
    while True:
        at = np.flatnonzero(live)
        at = at[~(ends[at] | ends[after[at]])]  # a pair with a document's last id is never replaced
        kind = np.uint32 if used <= 1 << 16 else np.uint64
        code = s[at].astype(kind, copy=False) * kind(used) + s[after[at]].astype(kind, copy=False)
        pairs, n = _distinct(code)
        frequent = n >= LEAST
        if not frequent.any():
            break
        # Pairs far rarer than the commonest wait: they may be part of what is replaced now.
        picked = frequent & (n * SPREAD >= n.max())
        chosen, often = pairs[picked], n[picked]
        mixed = _mixed(code)
        live[:] = False
        live[at[_marked(pairs[frequent])[mixed]]] = True
        number = np.full(1 << 20, -1, np.int32)
        number[_mixed(chosen)] = np.arange(chosen.size, dtype=np.int32)
        rule = number[mixed]
        maybe = np.flatnonzero(rule >= 0)
        rule, wanted = rule[maybe], code[maybe]
        other = np.flatnonzero(chosen[rule] != wanted)  # of pairs that share their mixed bits the table has one
        rule[other] = np.minimum(np.searchsorted(chosen, wanted[other]), chosen.size - 1)
        real = chosen[rule] == wanted
        where, rule = at[maybe[real]], rule[real]
        rank = np.empty(chosen.size, np.int64)
        rank[np.lexsort((_mixed(chosen), often))] = np.arange(chosen.size)
        taken = _taken(where, after[where], rank[rule])
        where, rule = where[taken], rule[taken]
        # Overlapping pairs may have left one without a place.
        held = np.bincount(rule, minlength=chosen.size) > 0
        rule, chosen = (np.cumsum(held) - 1)[rule], chosen[held]
        left.append((chosen // kind(used)).astype(np.uint32))
        right.append((chosen % kind(used)).astype(np.uint32))
        first.append(used - terminals.size)
        s[where] = rule.astype(np.uint32) + np.uint32(used)
        gone = after[where]
        beyond = after[gone]
        after[where] = beyond
        before[beyond[beyond < s.size]] = where[beyond < s.size]
        left_over[gone] = live[gone] = False
        live[where] = True
        live[before[where[before[where] >= 0]]] = True
        live[where[beyond == s.size]] = False
        used += chosen.size
    s, ends = s[left_over], ends[left_over]
    rules = [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in (left, right)]
    expansion = np.ones(used, np.uint32)
    for k, a in enumerate(first):
        b = first[k + 1] if k + 1 < len(first) else rules[0].size
        expansion[terminals.size + a : terminals.size + b] = expansion[rules[0][a:b]] + expansion[rules[1][a:b]]
    starts = np.concatenate([[0], np.flatnonzero(ends) + 1])[:-1] if sizes.size else np.zeros(0)
    width = 2 if used <= 65536 else 4
    head = struct.pack("<8I", sizes.size, terminals.size, rules[0].size, len(first), s.size, width, ids.size, end_id)
    parts = [np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], "u1"), starts.astype("<u4"), terminals.astype("<u4"), *(x.astype("<u4") for x in rules), np.array(first, "<u4"), expansion.astype("<u4"), s.astype(f"<u{width}")]
    return b"".join((MAGIC, head, *(x.tobytes() for x in parts)))


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, and each id's place among them."""
    if not ids.size or ids.max() >= 1 << 24:
        terminals = np.unique(ids).astype(np.uint32)
        return terminals, np.searchsorted(terminals, ids).astype(np.uint32)
    seen = np.bincount(ids)
    terminals = np.flatnonzero(seen).astype(np.uint32)
    number = np.zeros(seen.size, np.uint32)
    number[terminals] = np.arange(terminals.size, dtype=np.uint32)
    return terminals, number[ids]


def _mixed(code: np.ndarray) -> np.ndarray:
    """Twenty well-mixed bits of each pair."""
    if code.dtype == np.uint32:
        return (code * np.uint32(2654435761)) >> np.uint32(12)
    return (code * np.uint64(11400714819323198485)) >> np.uint64(44)


class Shard:
    """A shard's bytes, read; documents can be decoded one by one or all at once."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        docs, terminals, rules, rounds, symbols, width, self.n_ids, self.end_id = struct.unpack_from("<8I", data, 4)
        at = 36

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x

        ids, null = take(docs, "<i8"), take(docs, "u1")
        self.doc_ids = [None if b else a for a, b in zip(ids.tolist(), null.tolist())]
        self.starts = np.append(take(docs, "<u4"), symbols).astype(np.int64)
        self.terminals, self.left, self.right = take(terminals, "<u4"), take(rules, "<u4"), take(rules, "<u4")
        self.first, self.expansion, self.symbols = take(rounds, "<u4"), take(terminals + rules, "<u4"), take(symbols, f"<u{width}")

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64)
        for a in self.first[::-1].tolist():
            low = a + self.terminals.size
            pair = s >= low
            at = np.flatnonzero(pair)
            to = at + np.arange(at.size)  # each pair before it has taken one place more
            rule = s[at] - self.terminals.size
            s = np.repeat(s, 1 + pair)
            s[to], s[to + 1] = self.left[rule], self.right[rule]
        return self.terminals[s]

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, from its own symbols alone."""
        return self.expand(self.symbols[self.starts[k] : self.starts[k + 1]])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each document."""
        sums = np.concatenate([[0], np.cumsum(self.expansion[self.symbols].astype(np.int64))])
        return self.expand(self.symbols), np.diff(sums[self.starts])


def _kind(c: str) -> str:
    """The class of a Latin-1 character: a letter or digit, a blank, a stop, anything else."""
    return "a" if unicodedata.category(c)[0] in "LN" else " " if c in " \n" else "." if c in ".," else "p"


_LATIN = [chr(k) for k in range(256)]
#: Each Latin-1 byte's lower case and its class.
LOWER = "".join(c.lower() if len(c.lower()) == 1 and c.lower() < "\u0100" else c for c in _LATIN).encode("latin-1")
KINDS = np.frombuffer("".join(map(_kind, _LATIN)).encode(), np.uint8)
#: Bytes of a chunk that is looked up by its own bytes, and masks that keep the first 0 to 8 bytes of a word.
SHORT = 16
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
SLOTS = 1 << 21


class _Chunks:
    """Distinct chunks by number, with the ids of each; a new one is encoded once.

    Short chunks of Latin-1 texts are looked up many at a time: their bytes are
    two numbers, found by open addressing and compared whole. Others are keys of
    a dictionary. Over `CHUNKS` chunks the table starts anew.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(SLOTS, -1, np.int32)
        self.low, self.high = np.zeros(CHUNKS, np.uint64), np.zeros(CHUNKS, np.uint64)
        self.bytes = np.zeros(CHUNKS, np.uint8)
        self.others: dict[str, int] = {}
        self.start, self.size = np.zeros(CHUNKS, np.int64), np.zeros(CHUNKS, np.int64)
        self.flat, self.used, self.n = np.zeros(4 * CHUNKS, np.uint32), 0, 0

    def add(self, chunks: list[str]) -> np.ndarray:
        """Encode new chunks; their numbers."""
        ids, sizes = self.encode(chunks)
        number = np.arange(self.n, self.n + len(chunks))
        if number.size and number[-1] >= self.start.size:
            more = max(CHUNKS, len(chunks))
            self.low, self.high, self.bytes, self.start, self.size = (np.concatenate([x, np.zeros(more, x.dtype)]) for x in (self.low, self.high, self.bytes, self.start, self.size))
        if self.used + ids.size > self.flat.size:
            self.flat = np.concatenate([self.flat, np.zeros(max(self.flat.size, ids.size), np.uint32)])
        self.flat[self.used : self.used + ids.size] = ids
        self.start[number], self.size[number] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.n = self.used + ids.size, self.n + len(chunks)
        return number

    def strings(self, chunks: list[str]) -> np.ndarray:
        """The numbers of some chunks."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.others]
        if new:
            self.others.update(zip(new, self.add(new).tolist()))
        return np.fromiter(map(self.others.__getitem__, chunks), np.int64, len(chunks))

    def _slot(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        x = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + size.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of some keys, -1 where there is none."""
        slot = self._slot(low, high, size)
        found = self.slots[slot].astype(np.int64)
        left = np.flatnonzero((found >= 0) & ~((self.low[found] == low) & (self.high[found] == high) & (self.bytes[found] == size)))
        while left.size:
            slot[left] = (slot[left] + 1) % SLOTS
            now = self.slots[slot[left]].astype(np.int64)
            found[left] = now
            left = left[(now >= 0) & ~((self.low[now] == low[left]) & (self.high[now] == high[left]) & (self.bytes[now] == size[left]))]
        return found

    def keys(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of short chunks raw[start:start+size]; raw has SHORT more bytes at its end."""
        words = np.ndarray((raw.size - 7,), np.uint64, raw, strides=(1,))
        low = words[start] & KEEP[np.minimum(size, 8)]
        high = words[start + 8] & KEEP[np.maximum(size, 8) - 8]
        found = self._find(low, high, size)
        missing = np.flatnonzero(found < 0)
        while missing.size:
            _, one = np.unique(low[missing] * np.uint64(31) + high[missing] * np.uint64(17) + size[missing].astype(np.uint64), return_index=True)
            one = missing[one]  # chunks that meet in this sum have their turn in the next round
            whole = raw.tobytes() if one.size > 1000 else raw
            number = self.add([bytes(whole[a : a + n]).decode("latin-1") for a, n in zip(start[one].tolist(), size[one].tolist())])
            self.low[number], self.high[number], self.bytes[number] = low[one], high[one], size[one]
            slot = self._slot(low[one], high[one], size[one])
            while number.size:
                free = self.slots[slot] < 0
                self.slots[slot[free]] = number[free]
                rest = self.slots[slot] != number
                slot, number = (slot[rest] + 1) % SLOTS, number[rest]
            found[missing] = self._find(low[missing], high[missing], size[missing])
            missing = missing[found[missing] < 0]
        return found

    def latin(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all chunks of lower-case Latin-1 texts, and how many each has."""
        joined = b"\n".join([*texts, b" " * SHORT])
        raw = np.frombuffer(joined, np.uint8)
        kind = KINDS[raw]
        solid = kind != 32
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        # A stop or comma between a letter or digit and a blank is a chunk of its own.
        tail = np.flatnonzero((kind == 46) & closes)
        tail = tail[(tail > 0) & (kind[tail - 1] == 97)]
        opens[tail] = True
        closes[tail - 1] = True
        start = np.flatnonzero(opens)
        size = np.flatnonzero(closes) + 1 - start
        found = np.empty(start.size, np.int64)
        short = size <= SHORT
        found[short] = self.keys(raw, start[short], size[short])
        if not short.all():
            found[~short] = self.strings([joined[a : a + n].decode("latin-1") for a, n in zip(start[~short].tolist(), size[~short].tolist())])
        ends = np.cumsum([len(x) + 1 for x in texts])
        return found, np.diff(np.searchsorted(start, ends), prepend=0)


class _Tokenizer:
    """The library behind a table of distinct chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.between = self.library.token_to_id(BETWEEN)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        #: Whether the file's own rules allow chunks to be encoded apart; else whole texts go to the library.
        self.apart = (
            [spec[x] for x in ("normalizer", "pre_tokenizer", "post_processor", "truncation")] == [NORMALIZER, SPLITTER, None, None]
            and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or not x["content"].startswith("<|") or set(" \n") & set(x["content"]) for x in spec["added_tokens"])
        )
        self.table = _Chunks(self._encode)
        # Words of letters alone are one piece of the splitter and have no other normal form: they need its bytes and the model.
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = spec["model"].get("end_of_word_suffix")
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.last[[k for x, k in vocabulary.items() if x.endswith(suffix)]] = True
        letters = [chr(k) for k in range(128, 256) if chr(k).isalpha()] + [chr(k) for k in range(97, 123)]
        #: Whether every such word ends, and no part of it before its end does, in an id that says so.
        self.plain = bool(suffix) and all(self.last[x[-1]] and not self.last[x[:-1]].any() for x in self._words([f"{a}{b}" for a in letters for b in letters]))

    def _words(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.words.encode_batch_fast(words, add_special_tokens=False)]

    def _each(self, chunks: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(chunks, add_special_tokens=False)]

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of distinct chunks."""
        simple = np.array([self.plain and c.isalpha() and c.islower() and max(c) < "\u0100" for c in chunks], bool)
        sizes = np.zeros(len(chunks), np.int64)
        flat = np.zeros(0, np.uint32)
        if simple.any():
            words = [c for c, x in zip(chunks, simple.tolist()) if x]
            runs = self._words([" ".join(words[a : a + 64]) for a in range(0, len(words), 64)])
            flat = np.fromiter(chain.from_iterable(runs), np.uint32)
            sizes[simple] = np.diff(np.flatnonzero(self.last[flat]), prepend=-1)
        if simple.all():
            return flat, sizes
        others = self._apart([c for c, x in zip(chunks, simple.tolist()) if not x])
        sizes[~simple] = [len(x) for x in others]
        every = np.zeros(int(sizes.sum()), np.uint32)
        mine = np.repeat(simple, sizes)
        every[mine] = flat
        every[~mine] = np.fromiter(chain.from_iterable(others), np.uint32)
        return every, sizes

    def _apart(self, chunks: list[str]) -> list[list[int]]:
        """One call of the library for many chunks, set apart by a special token that none of them holds."""
        if self.between is None or any(BETWEEN in c for c in chunks):
            return self._each(chunks)
        joined = [BETWEEN.join(chunks[a : a + 64]) for a in range(0, len(chunks), 64)]
        out: list[list[int]] = []
        for x in self._each(joined):
            at = -1
            for b in [*(k for k, i in enumerate(x) if i == self.between), len(x)]:
                out.append(x[at + 1 : b])
                at = b
        return out

    def ids(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and each one's number of ids.

        Texts of Latin-1 characters without a special token's beginning are
        lower-cased first: none of these composes with another, and each has one
        lower case, so the library does the same.
        """
        if not self.apart:
            ids = self._each(batch)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes
        if self.table.n > CHUNKS:
            self.table.clear()
        latin: list[bytes] = []
        others: list[list[str]] = []
        of_latin = np.zeros(len(batch), bool)
        for k, x in enumerate(batch):
            if "<|" not in x:
                try:
                    latin.append(x.encode("latin-1").translate(LOWER))
                    of_latin[k] = True
                    continue
                except UnicodeEncodeError:
                    pass
            others.append(x.replace("\n", " ").split(" "))
        found, sizes = self.table.latin(latin)
        counts = np.zeros(len(batch), np.int64)
        counts[of_latin] = sizes
        if others:
            counts[~of_latin] = [len(x) for x in others]
            mine, every = np.repeat(of_latin, counts), np.zeros(int(counts.sum()), np.int64)
            every[mine], every[~mine] = found, self.table.strings(list(chain.from_iterable(others)))
            found = every
        length = self.table.size[found]
        sums, ends = np.concatenate([[0], np.cumsum(length)]), np.cumsum(counts)
        return gather(self.table.flat, self.table.start[found], length), sums[ends] - sums[ends - counts]


@lru_cache(maxsize=2)
def _tokens(path: str) -> _Tokenizer:
    return _Tokenizer(path)


def write(df: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode a table and write its shards to a folder."""
    session(df)
    tie = F.xxhash64(text_of(text))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("tie", tie.alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, shard = _tokens(tokenizer), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        docs: list[int | None] = []

        def full() -> pa.RecordBatch:
            nonlocal ids, sizes, docs, shard
            flat, counts = np.concatenate(ids), np.concatenate(sizes)
            row = [[part], [shard], [counts.size], [flat.size], [compress(flat, docs, counts, end_id)]]
            ids, sizes, docs, shard = [], [], [], shard + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["part", "shard", "n_docs", "n_ids", "data"])

        for batch in slices(batches, "text", 1 << 20):
            flat, counts = tokens.ids(texts(batch, "text"))
            with_end = np.insert(flat, np.cumsum(counts), end_id)
            ids.append(with_end)
            sizes.append(counts + 1)
            docs += batch.column("doc_id").to_pylist()
            if sum(x.size for x in ids) >= SHARD_IDS:
                yield full()
        if docs:
            yield full()

    rows.mapInArrow(run, SHARDS).write.parquet(path)


def _parts(spark: SparkSession, path: str, ids: bool) -> tuple[DataFrame, DataFrame]:
    """The documents of each shard, decoded, and the ids before each shard."""
    shards = spark.read.schema(SHARDS).parquet(path)
    session(shards)
    inside = Window.partitionBy("part").orderBy("shard")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    base = shards.select("part", "shard", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("before")).join(parts, "part").select("part", "shard", (F.col("before") + F.col("before_part")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(*(batch.column(x).to_pylist() for x in ("part", "shard", "data"))):
                x = Shard(data)
                flat, counts = x.documents()
                raw, ends = memoryview(flat.astype("<u4", copy=False)).cast("B"), np.cumsum(counts)
                own = [raw[4 * a : 4 * b] for a, b in zip(ends - counts, ends)]
                own_ids = {"ids": pa.array([bytes(y) for y in own], pa.binary())} if ids else {}
                columns = {"part": pa.array([part] * len(own), pa.int32()), "shard": pa.array([shard] * len(own), pa.int32()), "doc_id": pa.array(x.doc_ids, pa.int64()), "at": pa.array(ends - counts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array([zlib.crc32(y) for y in own], pa.int64()), **own_ids}
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    docs = shards.select("part", "shard", "data").mapInArrow(run, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)
    return docs, base


def documents(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The documents of a written folder: doc_id, start (ids before it), n_tokens, ids_crc32 and, if wanted, the packed ids."""
    docs, base = _parts(spark, path, ids)
    out = docs.select("part", "shard", "doc_id", "at", "n_tokens", "ids_crc32", *["ids"] * ids).join(base, ["part", "shard"])
    return out.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as shards and read back. No SQL can express it: tested against the library and as a round trip."""
    import uuid

    path = f"{shared_dir(spark).rstrip('/')}/lathe-tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer_path())
    return documents(spark, path, ids=False)
