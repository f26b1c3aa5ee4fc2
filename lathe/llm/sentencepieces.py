"""Operator 1: SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary crosses a whitespace marker (checked when the plan is
made): a marked word is segmented alike wherever it stands. Each Python worker
therefore keeps a table of distinct marked words, has the sentencepiece library
segment each new one once, and joins the ids back by position with one numpy
gather. The table is bounded (`CHUNKS`), lives as long as the
worker and is no part of the result, so a lost executor costs only its tasks.
Nothing is shuffled: a corpus-wide table would have to move a row per word of
the corpus, several times the input, to save little more than the repeats that
one partition already has.

Defined cases: a null text is the empty text; the empty text has only the
begin and end ids; repeated rows are encoded alike; columns named like an
output are replaced; any other column is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.llm.arrow import ChunkTable, gather, slices, texts, with_columns
from lathe.llm.common import session, table

MARK = "▁"
#: Distinct marked words that a worker remembers.
CHUNKS = 200_000
CHUNK = re.compile(r" +[^ \n]*|\n[^ \n]*")


class _Model:
    """A SentencePiece model with its chunk table and its pieces' surfaces, one per worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        crossing = [x for i, x in enumerate(pieces) if MARK in x.lstrip(MARK) and not self.sp.is_control(i)]
        kept = self.sp.encode("  a  b\n c ", out_type=str)
        #: Whether marked words can be segmented apart: no piece crosses a marker or a line end, white space is kept.
        self.apart = not crossing and not any("\n" in x for x in pieces) and "".join(kept).replace("<0x0A>", "\n") == MARK * 3 + f"a{MARK * 2}b\n{MARK}c{MARK}"
        self.space = self.sp.piece_to_id(MARK)
        surface = [bytes([int(x[3:5], 16)]) if self.sp.is_byte(i) else b"" if self.sp.is_control(i) else (" ⁇ " if self.sp.is_unknown(i) else x.replace(MARK, " ")).encode() for i, x in enumerate(pieces)]
        self.size = np.fromiter(map(len, surface), np.int64, n)
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.table = ChunkTable(self.segment, CHUNKS)

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A chunk is a word after a marker, or a line end and what follows it (then the library's own marker goes)."""
        ids = self.sp.encode(chunks, num_threads=1)
        own = [x[1:] if c[:1] == "\n" else x if c else [self.space] for c, x in zip(chunks, ids)]
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter(chain.from_iterable(own), np.uint32, int(sizes.sum())), sizes

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(MARK, " ")
        plain = text.replace("\n", " \n")
        if "  " not in plain and plain[0] != " " and plain[-1] != " ":
            return plain.split(" ")
        return [x[1:] if x[0] == " " else x for x in CHUNK.findall(" " + text)]

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.apart:
            return self.table.ids([self.chunks(x) for x in batch])
        ids = self.sp.encode(batch, num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids; what the library would not read as whole UTF-8 is left to it."""
        length = self.size[flat]
        sums, ends = np.concatenate([[0], np.cumsum(length)]), np.cumsum(sizes)
        data = gather(self.bytes, self.at[flat], length).tobytes()
        out = []
        for a, b in zip(ends - sizes, ends):
            raw = data[sums[a] : sums[b]]
            try:
                # The first marker is the library's own.
                out.append((raw[1:] if raw[:1] == b" " else raw).decode())
            except UnicodeDecodeError:
                out.append(self.sp.decode(flat[a:b].tolist()))
        return out


@lru_cache(maxsize=2)
def _model(path: str) -> _Model:
    return _Model(path)


def encode(df: DataFrame, model_path: str, text: str = "text", ids: str = "ids", count: str = "n_tokens", begin: bool = True, end: bool = True, decoded: str | None = None) -> DataFrame:
    """Append `ids` (binary: little-endian unsigned 32-bit integers) and `count` (long) to every row.

    With `decoded` the text that the library's decode(ids) gives is appended too,
    by the same worker, so ids need not travel to another.
    """
    session(df)
    df = df.drop(ids, count, *([decoded] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model_path)
        head = np.array([m.sp.bos_id()] if begin else [], "<u4").tobytes()
        tail = np.array([m.sp.eos_id()] if end else [], "<u4").tobytes()
        for batch in slices(batches, text):
            flat, sizes = m.encode(texts(batch, text))
            data, ends = memoryview(flat.astype("<u4", copy=False)).cast("B"), np.cumsum(sizes) * 4
            packed = [b"".join((head, data[a:b], tail)) for a, b in zip(ends - sizes * 4, ends)]
            # The begin and end ids have no surface.
            again = {decoded: pa.array(m.decode(flat, sizes), pa.string())} if decoded else {}
            yield with_columns(batch, **{ids: pa.array(packed, pa.binary()), count: pa.array(sizes + begin + end, pa.int64())}, **again)

    more = [T.StructField(decoded, T.StringType())] if decoded else []
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(count, T.LongType()), *more])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Append the text that the library's decode(ids) gives for packed ids; null ids give the empty text."""
    session(df)
    df = df.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model_path)
        for batch in slices(batches, ids, 1 << 20):
            raw = [x or b"" for x in batch.column(ids).to_pylist()]
            flat = np.frombuffer(b"".join(raw), "<u4")
            yield with_columns(batch, **{text: pa.array(m.decode(flat, np.fromiter(map(len, raw), np.int64, len(raw)) // 4), pa.string())})

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(text, T.StringType())]))


def id_array(ids: str = "ids") -> Column:
    """Packed ids as an array of int, for users that want one."""
    hexed = F.hex(F.col(ids))
    n = F.length(hexed) / 8
    word = lambda i: F.concat(*(F.substring(hexed, i * 8 + k, F.lit(2)) for k in (7, 5, 3, 1)))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.conv(word(i), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of both. No SQL can express it: tested against the library."""
    path = model_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = encode(docs, path, decoded="decoded")
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
