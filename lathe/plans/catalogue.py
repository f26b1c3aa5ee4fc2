"""The catalogue of queries over the operators, with the DuckDB SQL that each is held against.

Queries read whole tables; a limit is there only where it is the operator
(first n documents, a row by position, the joined head of a corpus).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions import scaling
from lathe.functions import seq as S
from lathe.operators import arrow_nn as A
from lathe.operators import bpe
from lathe.operators import relational_nn as R
from lathe.operators import windows as W
from lathe.sources import corpus
from lathe.sources.staging import staged

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the encoding queries ("e ", "th", "the", "the "), and learning in the training queries.
RULES = ((101, 32, 256), (116, 104, 257), (257, 101, 258), (258, 32, 259))
LEARNED, LEAST, OFTEN = 4, 2, 10
FOLDED, FOLD_RULES, FOLD_LEAST = 6, 7, 90
DIM, HEADS, CONTEXT, WIDE = 64, 4, 16, 256


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.documents(spark, sf_dir).select("doc_id", S.to_ids(S.from_text(F.col("text"))).alias("ids"))


def _bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their ids packed, one byte for each."""
    return _spread(corpus.documents(spark, sf_dir)).select("doc_id", F.encode("text", "UTF-8").alias("ids"))


def _spread(df: DataFrame) -> DataFrame:
    """A single file is one task: deal its rows out over the cores. Tables of many files are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores)


def _hex(ids) -> F.Column:
    return F.array_join(F.transform(ids, lambda i: F.lpad(F.hex(i), 2, "0")), "")


def q01(spark, d):
    return corpus.documents(spark, d).select(F.round(F.avg(F.char_length("text")), 6).alias("mean_length"))


def q02(spark, d):
    return corpus.profile(corpus.documents(spark, d))


def q03(spark, d):
    return _ids(spark, d).select("doc_id", F.size("ids").cast("long").alias("n_ids"), _hex(F.col("ids")).alias("ids_hex"))


def q03_slices(spark, d):
    """The first ten ids of each item, the text of its first ten bytes, and its number of bytes."""
    items = corpus.documents(spark, d, "benchmark", "item_id").select("doc_id", F.encode("text", "UTF-8").alias("b"))
    head = F.substring("b", F.lit(1), F.lit(10))
    ids = F.transform(S.to_ids(F.decode(head, "ISO-8859-1")), lambda i: i.cast("string"))
    text = F.decode(F.when(F.try_validate_utf8(head.cast("string")).isNotNull(), head), "UTF-8")
    return items.select(F.col("doc_id").alias("item_id"), F.array_join(ids, " ").alias("first_ids"), text.alias("first_text"), F.octet_length("b").cast("long").alias("n_bytes"))


def q04(spark, d):
    return bpe.base_vocab(spark).select(F.col("token_id").cast("long").alias("token_id"), F.hex("bytes").alias("bytes_hex"))


def _long(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("long").alias(c) for c in df.columns))


def q05(spark, d):
    return _long(bpe.pair_counts(_spread(_ids(spark, d))))


def q06(spark, d):
    return _long(bpe.best_pair(_spread(_ids(spark, d)), LEAST))


def q07(spark, d):
    return corpus.documents(spark, d).select("doc_id", S.hexed(S.merge(S.from_text(F.col("text")), *RULES[0])).alias("seq_hex"))


def _learned(spark: SparkSession, tokenizer: bpe.Tokenizer, counts: list[int]) -> DataFrame:
    rows = [(k, *m, n) for k, (m, n) in enumerate(zip(tokenizer.merges, counts))]
    return spark.createDataFrame(rows, "rank long, l long, r long, new_id long, n long")


def q08(spark, d):
    return _learned(spark, *bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED, LEAST))


def q09(spark, d):
    tokenizer, _ = bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED, LEAST)
    return tokenizer.vocab_table(spark).select(F.col("token_id").cast("long").alias("token_id"), F.hex("bytes").alias("bytes_hex"))


def q10(spark, d):
    out = corpus.documents(spark, d).select("doc_id", S.encode(F.col("text"), RULES).alias("s"))
    return out.select("doc_id", S.hexed(F.col("s")).alias("seq_hex"), S.length(F.col("s")).alias("n_tokens"))


def q11(spark, d):
    out = corpus.documents(spark, d).select("doc_id", S.encode(F.col("text"), RULES).alias("s"))
    return out.select("doc_id", F.hex(F.encode(S.decode(F.col("s"), RULES), "UTF-8")).alias("text_hex"))


def q11_ids(spark, d):
    items = corpus.documents(spark, d, "benchmark", "item_id").select("doc_id", S.to_ids(S.encode(F.col("text"), RULES)).alias("ids"))
    return bpe.decode_ids(items, bpe.Tokenizer(RULES)).select(F.col("doc_id").alias("item_id"), "text")


def q12(spark, d):
    return corpus.with_split(corpus.documents(spark, d)).groupBy("split").agg(F.count("*").alias("n"))


def q13(spark, d):
    t = corpus.joined(corpus.first(corpus.documents(spark, d), 500))
    return t.select(F.char_length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("n_bytes"), F.left("text", F.lit(100)).alias("head"), F.right("text", F.lit(50)).alias("tail"))


def q14(spark, d):
    return _learned(spark, *bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED, LEAST, mode="joined"))


def q08_often(spark, d):
    return _learned(spark, *bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED, OFTEN))


def q15_few(spark, d):
    """The fold over the first documents: a later one goes on with the rules of those before."""
    few = corpus.first(corpus.documents(spark, d), FOLDED)
    return _learned(spark, *bpe.train(few, bpe.BASE + FOLD_RULES, FOLD_LEAST, mode="per_document_fold"))


def q15(spark, d):
    return _learned(spark, *bpe.train(corpus.documents(spark, d), 1000, LEAST, mode="per_document_fold"))


def q15_resume(spark, d):
    half, one = bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED // 2, LEAST)
    whole, two = bpe.train(corpus.documents(spark, d), bpe.BASE + LEARNED, LEAST, init=half)
    return _learned(spark, whole, one + two)


def q16_first(spark, d):
    return corpus.first(corpus.documents(spark, d), 500).select("doc_id", F.hex(F.encode("text", "UTF-8")).alias("text_hex"))


def q16_row(spark, d):
    return corpus.row_at(corpus.documents(spark, d), 100).select("doc_id", F.hex(F.encode("text", "UTF-8")).alias("text_hex"))


def q17(spark, d):
    """Batches carry their documents."""
    return corpus.batches(corpus.documents(spark, d), 1000).select("batch_id", "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _windows(context: int, stride: int) -> Query:
    def run(spark, d):
        w = W.windows(_bytes(spark, d), context, stride)
        return w.select("doc_id", F.col("start").cast("long").alias("start"), F.hex("input").alias("x_hex"), F.hex("target").alias("y_hex"))

    return run


def q18_count(spark, d):
    return corpus.documents(spark, d).select("doc_id", W.count_of(F.octet_length("text"), 512, 512).alias("n"))


def _carried(batches: DataFrame) -> DataFrame:
    digest = lambda c: F.md5(F.hex(c).cast("binary"))
    return batches.select("batch_id", "window_id", "doc_id", F.col("start").cast("long").alias("start"), digest("input").alias("x_md5"), digest("target").alias("y_md5"))


def q19(spark, d):
    """Batches carry their windows, inputs and targets."""
    return _carried(W.batches(W.numbered(_bytes(spark, d), 512, 512)))


def q19_shuffled(spark, d):
    return _carried(W.shuffled_batches(W.numbered(_bytes(spark, d), 512, 512), seed=7))


def q19_window(spark, d):
    """One window by its place."""
    return W.window_at(W.numbered(_bytes(spark, d), 512, 512), 500).select("window_id", "doc_id", F.col("start").cast("long").alias("start"), F.hex("input").alias("x_hex"), F.hex("target").alias("y_hex"))


def q20(spark, d):
    grid = scaling.devices(spark).crossJoin(spark.createDataFrame([(g, h, m) for g in (1, 8) for h in (1, 24) for m in (0.3, 0.4)], "gpus long, hours long, mfu double"))
    out = scaling.budget_report(grid.withColumn("tokens_per_param", F.lit(20.0)))
    return out.select("device", "gpus", "hours", "mfu", *(F.round(F.col(c) / 1e6, 3).alias(c) for c in ("c", "n", "d")), F.round("ratio", 6).alias("ratio"))


def q20_report(spark, d):
    """The default budget, one accelerator for an hour, as text."""
    return scaling.report(spark).select("device", F.round(F.col("check_6nd") / 1e9, 3).alias("check_6nd"), "report")


def _vectors(spark, d) -> DataFrame:
    v = _spread(corpus.table(spark, d, "embeddings"))
    b, t = F.floor(F.col("vec_id") / CONTEXT).cast("long"), (F.col("vec_id") % CONTEXT).cast("int")
    return v.select("vec_id", "label", b.alias("b"), t.alias("t"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))


def _values(df: DataFrame, x: str, name: str) -> DataFrame:
    """(vec_id, i, value): an array column exploded and rounded."""
    return df.select("vec_id", F.posexplode(x).alias("i", "__v")).select("vec_id", F.col("i").cast("long").alias("i"), F.round(F.col("__v"), 6).alias(name))


def _by_place(df: DataFrame) -> DataFrame:
    return df.withColumn("vec_id", F.col("b") * CONTEXT + F.col("t"))


def q21(spark, d):
    v = corpus.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    items = corpus.documents(spark, d, "benchmark", "item_id").select(F.col("doc_id").alias("b"), F.posexplode(S.to_ids(S.from_text(F.col("text")))).alias("t", "token_id"))
    closed = F.transform(F.sequence(F.lit(0), F.lit(DIM - 1)), lambda j: ((F.col("id") * 31 + j * 17) % 13 - 6) / F.lit(13.0))
    at = items.select(F.col("t").cast("long").alias("id")).distinct().select("id", closed.alias("x"))
    e = R.embed(items, v, at)
    weighted = R.total(F.transform("x", lambda y, j: y * (j + 1)))
    return e.select("b", F.col("t").cast("long").alias("t"), F.round(R.total(F.col("x")), 6).alias("s1"), F.round(weighted, 6).alias("s2"))


def q22(spark, d):
    return _values(_vectors(spark, d).withColumn("o", R.linear(F.col("x"), R.matrix(DIM, DIM))), "o", "v")


def _weights() -> dict:
    m = R.matrix
    return {"q": m(DIM, DIM, 0.3, 1), "k": m(DIM, DIM, 0.3, 2), "v": m(DIM, DIM, 0.3, 3), "o": m(DIM, DIM, 0.3, 4), "w1": m(WIDE, DIM, 0.3, 5), "w2": m(DIM, WIDE, 0.3, 6)}


def q23(spark, d):
    w = _weights()
    return _values(R.attention(_vectors(spark, d), w["q"], w["k"], w["v"], None, HEADS), "o", "o")


def q24(spark, d):
    return _values(_vectors(spark, d).withColumn("p", R.softmax(F.col("x"))), "p", "p")


def q25(spark, d):
    return _values(_vectors(spark, d).withColumn("o", R.layer_norm(F.col("x"))), "o", "o")


def q26(spark, d):
    w = _weights()
    hidden = _vectors(spark, d).withColumn("h", R.relu(R.linear(F.col("x"), w["w1"])))
    return _values(hidden.withColumn("o", R.linear(F.col("h"), w["w2"])), "o", "o")


def q27(spark, d):
    return _values(_by_place(R.block(_vectors(spark, d).select("b", "t", "x"), _weights(), HEADS)), "x", "o")


def q27_stack(spark, d):
    """Two blocks, one after the other."""
    once = R.block(_vectors(spark, d).select("b", "t", "x"), _weights(), HEADS)
    return _values(_by_place(R.block(once, _weights(), HEADS)), "x", "o")


def q28(spark, d):
    return _vectors(spark, d).select(F.round(F.avg(R.cross_entropy(F.col("x"), F.col("label"))), 6).alias("loss"))


def q29(spark, d):
    losses = _vectors(spark, d).select((F.col("vec_id") % 3).alias("epoch"), F.floor(F.col("vec_id") / 96).alias("batch_id"), R.cross_entropy(F.col("x"), F.col("label")).alias("loss"))
    return W.epoch_losses(losses).select("epoch", F.round("train_loss", 6).alias("train_loss"))


def q30(spark, d):
    return _vectors(spark, d).select("vec_id", R.argmax(F.col("x")).cast("long").alias("token_id"))


TOY = A.Config(vocab_size=bpe.BASE, context_size=32, embedding_dim=16, proj_dim=16, n_heads=2, n_layers=1)


def q31(spark, d):
    out = A.generate(A.init(TOY), TOY, list(b"Why "), 10)
    return spark.createDataFrame(list(enumerate(out)), "step long, token_id long")


def _toy_windows(spark, d, split: str) -> DataFrame:
    items = corpus.documents(spark, d, "benchmark", "item_id")
    ids = corpus.split(items, split).select("doc_id", S.to_ids(S.from_text(F.col("text"))).alias("ids"))
    return staged(W.batches(W.numbered(ids, TOY.context_size, TOY.context_size)).select("batch_id", "input", "target"))


def q32(spark, d):
    _, history, _ = A.train(_toy_windows(spark, d, "train"), _toy_windows(spark, d, "validation"), A.init(TOY), TOY, 2, A.AdamW(1e-2))
    return A.history_table(spark, history)


QUERIES: dict[str, Query] = {
    "q01_mean_length": q01, "q02_doc_lengths": q02, "q03_byte_ids": q03, "q03_byte_slices": q03_slices, "q04_base_vocab": q04, "q05_pair_freq": q05, "q06_best_pair": q06, "q07_apply_merge": q07,
    "q08_train_bounded": q08, "q08_train_least_10": q08_often, "q09_vocab": q09, "q10_encode": q10, "q11_decode": q11, "q11_decode_ids": q11_ids, "q12_splits": q12, "q13_joined_corpus": q13,
    "q14_train_joined": q14, "q15_train_fold": q15, "q15_train_fold_few": q15_few, "q15_train_resume": q15_resume, "q16_first_n": q16_first, "q16_row": q16_row, "q17_doc_batches": q17,
    "q18_windows_512_512": _windows(512, 512), "q18_windows_128_64": _windows(128, 64), "q18_windows_128_200": _windows(128, 200), "q18_window_counts": q18_count,
    "q19_batches": q19, "q19_shuffled": q19_shuffled, "q19_window_at": q19_window, "q20_budget_grid": q20, "q20_budget_report": q20_report, "q21_embed_lookup": q21, "q22_linear": q22, "q23_causal_attention": q23,
    "q24_softmax": q24, "q25_layernorm": q25, "q26_ffn": q26, "q27_block": q27, "q27_two_blocks": q27_stack, "q28_cross_entropy": q28, "q29_epoch_loss": q29, "q30_greedy_step": q30,
    "q31_generate": q31, "q32_train_history": q32,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# The SQL side, written independently of the operators: sequences as strings, layers as joins.

_HEX = "hex(encode(text))"
_SEQ = "(SELECT doc_id, array_to_string(list_transform(regexp_extract_all(h, '..'), lambda x: chr(('0x' || x)::INT)), '') AS s FROM (SELECT doc_id, hex(encode(text)) AS h FROM {source}))"
_DOCS = _SEQ.format(source="documents")


def _symbol(column: str) -> str:
    return f"unicode({column})"


def _pairs(source: str) -> str:
    return f"(SELECT doc_id, unnest(range(len(c) - 1)) AS pos, unnest(c[1:len(c) - 1]) AS a, unnest(c[2:len(c)]) AS b FROM (SELECT doc_id, string_split(s, '') AS c FROM {source} WHERE length(s) > 1))"


def _training(start: str, k: int, tail: str, least: int = LEAST) -> str:
    """k rounds of learning, each a pair of named subqueries; tail reads b0 .. b{k-1}."""
    parts = [f"s0 AS MATERIALIZED (SELECT * FROM {start})"]
    for i in range(k):
        parts.append(f"b{i} AS MATERIALIZED (SELECT a, b, count(*) AS n, min((doc_id, pos)) AS place FROM {_pairs(f's{i}')} GROUP BY a, b ORDER BY n DESC, place LIMIT 1)")
        parts.append(f"s{i + 1} AS MATERIALIZED (SELECT doc_id, CASE WHEN n >= {least} THEN replace(s, a || b, chr({256 + i})) ELSE s END AS s FROM s{i}, b{i})")
    return f"WITH {', '.join(parts)} {tail}"


def _fold_sql() -> str:
    """The fold over the first documents: at most FOLD_RULES steps for each, of which a step without a frequent pair learns nothing."""
    parts, steps = [], []
    for k in range(FOLDED):
        now = f"d{k}"
        parts.append(f"{now} AS MATERIALIZED (SELECT * FROM {_DOCS} ORDER BY doc_id LIMIT 1 OFFSET {k})")
        for t in list(steps):
            parts.append(f"{now}_{t} AS MATERIALIZED (SELECT doc_id, CASE WHEN new THEN replace(s, a || b, chr(id)) ELSE s END AS s FROM {now if t == steps[0] else f'{now}_{steps[steps.index(t) - 1]}'}, {t})")
        at = f"{now}_{steps[-1]}" if steps else now
        for j in range(FOLD_RULES):
            t, before = f"r{k}_{j}", f"(SELECT id + new::INT FROM {steps[-1]})" if steps else "256"
            best = f"SELECT a, b, count(*) AS n, min(pos) AS place FROM {_pairs(at)} GROUP BY a, b ORDER BY n DESC, place LIMIT 1"
            parts.append(f"{t} AS MATERIALIZED (SELECT coalesce(a, '') AS a, coalesce(b, '') AS b, coalesce(n, 0) AS n, {before}::INT AS id, coalesce(n, 0) >= {FOLD_LEAST} AND {before}::INT < {256 + FOLD_RULES} AS new FROM (SELECT 1) LEFT JOIN ({best}) ON true)")
            steps.append(t)
            parts.append(f"{now}_{t} AS MATERIALIZED (SELECT doc_id, CASE WHEN new THEN replace(s, a || b, chr(id)) ELSE s END AS s FROM {at}, {t})")
            at = f"{now}_{t}"
    rows = " UNION ALL ".join(f"SELECT (id - 256)::BIGINT AS rank, {_symbol('a')}::BIGINT AS l, {_symbol('b')}::BIGINT AS r, id::BIGINT AS new_id, n::BIGINT AS n FROM {t} WHERE new" for t in steps)
    return f"WITH {', '.join(parts)} {rows}"


_RANKS = " UNION ALL ".join(f"SELECT {i}::BIGINT AS rank, {_symbol('a')}::BIGINT AS l, {_symbol('b')}::BIGINT AS r, {256 + i}::BIGINT AS new_id, n::BIGINT AS n FROM b{i} WHERE n >= {LEAST}" for i in range(LEARNED))
_JOINED = f"(SELECT 0 AS doc_id, string_agg(s, chr(10) || chr(10) ORDER BY doc_id) AS s FROM {_DOCS})"
_BASE = "SELECT i::BIGINT AS token_id, lpad(hex(i), 2, '0') AS bytes_hex FROM range(256) t(i)"
_BYTES = "CASE WHEN {0} < 256 THEN lpad(hex({0}), 2, '0') ELSE (SELECT h FROM v{1} WHERE id = {0}) END"


def _vocab_sql() -> str:
    tail = ["SELECT * FROM (" + _BASE + ")"]
    parts = []
    for i in range(LEARNED):
        look = " UNION ALL ".join(["SELECT i AS id, lpad(hex(i), 2, '0') AS h FROM range(256) t(i)", *(f"SELECT {256 + j} AS id, h FROM v{j}" for j in range(i))])
        parts.append(f"v{i} AS (SELECT x.h || y.h AS h FROM b{i}, ({look}) x, ({look}) y WHERE n >= {LEAST} AND x.id = {_symbol('a')} AND y.id = {_symbol('b')})")
        tail.append(f"SELECT {256 + i}::BIGINT AS token_id, h AS bytes_hex FROM v{i}")
    return _training(_DOCS, LEARNED, "").rstrip() + ", " + ", ".join(parts) + " " + " UNION ALL ".join(tail)


def _encoded(source: str = _DOCS) -> str:
    s = "s"
    for a, b, n in RULES:
        s = f"replace({s}, chr({a}) || chr({b}), chr({n}))"
    return f"(SELECT doc_id, {s} AS s FROM {source})"


def _window_sql(c: int, s: int) -> str:
    return f"""SELECT doc_id, start::BIGINT AS start, substr(h, 2 * start + 1, {2 * c}) AS x_hex, substr(h, 2 * start + 3, {2 * c}) AS y_hex
FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - {c}, 0), {s})) AS start FROM (SELECT doc_id, {_HEX} AS h FROM documents))"""


_NUMBERED = f"(SELECT row_number() OVER (ORDER BY doc_id, start) - 1 AS window_id, * FROM ({_window_sql(512, 512)}))"
_BATCHES = "SELECT ({place} // 32)::BIGINT AS batch_id, window_id, doc_id, start, md5(x_hex) AS x_md5, md5(y_hex) AS y_md5 FROM {source}"
_SHUFFLED = f"(SELECT *, row_number() OVER (ORDER BY md5('7:0:' || window_id), window_id) - 1 AS place FROM {_NUMBERED})"

_X = "x AS (SELECT vec_id, label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)"


def _w(name: str, rows: int, columns: int, scale: float, shift: int) -> str:
    return f"{name} AS (SELECT o, i, ((o * 31 + i * 17 + {shift}) % 13 - 6) / 13.0::DOUBLE * {scale}::DOUBLE AS w FROM range({rows}) a(o), range({columns}) b(i))"


def _linear(name: str, source: str, weights: str) -> str:
    return f"{name} AS (SELECT vec_id, o AS i, sum(v * w) AS v FROM {source} JOIN {weights} USING (i) GROUP BY vec_id, o)"


def _norm(name: str, source: str) -> str:
    return f"{name} AS (SELECT vec_id, i, (v - avg(v) OVER p) / sqrt(var_pop(v) OVER p + 1e-5) AS v FROM {source} WINDOW p AS (PARTITION BY vec_id))"


_QKV = [_w("wq", DIM, DIM, 0.3, 1), _w("wk", DIM, DIM, 0.3, 2), _w("wv", DIM, DIM, 0.3, 3)]


def _attention(source: str, k: str = "") -> list[str]:
    """Attention over a source, without the output projection; k sets the names of several apart."""
    size = DIM // HEADS
    return [
        _linear(f"q{k}", source, "wq"), _linear(f"k{k}", source, "wk"), _linear(f"vv{k}", source, "wv"),
        f"scores{k} AS (SELECT q.vec_id AS a, k.vec_id AS b, q.i // {size} AS h, sum(q.v * k.v) / sqrt({size}) AS s FROM q{k} q JOIN k{k} k ON q.i = k.i AND q.vec_id // {CONTEXT} = k.vec_id // {CONTEXT} AND k.vec_id <= q.vec_id GROUP BY ALL)",
        f"probs{k} AS (SELECT a, b, h, e / sum(e) OVER (PARTITION BY a, h) AS p FROM (SELECT a, b, h, exp(s - max(s) OVER (PARTITION BY a, h)) AS e FROM scores{k}))",
        f"att{k} AS (SELECT a AS vec_id, i, sum(p * v) AS v FROM probs{k} JOIN vv{k} vv ON vv.vec_id = b AND i // {size} = h GROUP BY a, i)",
    ]


_FFN = [_w("w1", WIDE, DIM, 0.3, 5), _w("w2", DIM, WIDE, 0.3, 6)]


_BLOCK_WEIGHTS = ", ".join([*_QKV, _w("wo", DIM, DIM, 0.3, 4), *_FFN])


def _block(source: str, k: int) -> list[str]:
    """A pre-norm block over a source, as y{k}."""
    return [
        _norm(f"n{k}", source), *_attention(f"n{k}", str(k)), _linear(f"ao{k}", f"att{k}", "wo"),
        f"mid{k} AS (SELECT vec_id, i, x.v + a.v AS v FROM {source} x JOIN ao{k} a USING (vec_id, i))",
        _norm(f"m{k}", f"mid{k}"), _linear(f"h{k}", f"m{k}", "w1"), f"r{k} AS (SELECT vec_id, i, greatest(v, 0) AS v FROM h{k})", _linear(f"f{k}", f"r{k}", "w2"),
        f"y{k} AS (SELECT vec_id, i, a.v + b.v AS v FROM mid{k} a JOIN f{k} b USING (vec_id, i))",
    ]


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


_LOSS = _with(_X) + "SELECT {select} FROM (SELECT vec_id, ln(sum(exp(v))) - max(v) FILTER (i = label) AS loss FROM x GROUP BY vec_id)"

ORACLES: dict[str, str] = {
    "q01_mean_length": "SELECT round(avg(length(text)), 6) AS mean_length FROM documents",
    "q02_doc_lengths": "SELECT doc_id, length(text)::BIGINT AS n_chars, strlen(text)::BIGINT AS n_bytes FROM documents",
    "q03_byte_ids": f"SELECT doc_id, strlen(text)::BIGINT AS n_ids, {_HEX} AS ids_hex FROM documents",
    "q03_byte_slices": """SELECT item_id, array_to_string(list_transform(regexp_extract_all(left(h, 20), '..'), lambda x: ('0x' || x)::INT::VARCHAR), ' ') AS first_ids,
CASE WHEN len(left(h, 20)) = strlen(t) * 2 THEN t END AS first_text, (len(h) // 2)::BIGINT AS n_bytes
FROM (SELECT item_id, hex(encode(text)) AS h, (SELECT max(p) FROM (SELECT left(text, unnest(range(11))) AS p) WHERE strlen(p) <= 10) AS t FROM benchmark)""",
    "q04_base_vocab": _BASE,
    "q05_pair_freq": f"SELECT {_symbol('a')}::BIGINT AS l, {_symbol('b')}::BIGINT AS r, count(*) AS n FROM {_pairs(_DOCS)} GROUP BY a, b",
    "q06_best_pair": f"SELECT {_symbol('a')}::BIGINT AS l, {_symbol('b')}::BIGINT AS r, n FROM (SELECT a, b, count(*) AS n, min((doc_id, pos)) AS place FROM {_pairs(_DOCS)} GROUP BY a, b ORDER BY n DESC, place LIMIT 1) WHERE n >= {LEAST}",
    "q07_apply_merge": f"SELECT doc_id, hex(encode(replace(s, 'e ', chr(256)))) AS seq_hex FROM {_DOCS}",
    "q08_train_bounded": _training(_DOCS, LEARNED, _RANKS),
    "q08_train_least_10": _training(_DOCS, LEARNED, _RANKS.replace(f"n >= {LEAST}", f"n >= {OFTEN}"), OFTEN),
    "q09_vocab": _vocab_sql(),
    "q10_encode": f"SELECT doc_id, hex(encode(s)) AS seq_hex, length(s)::BIGINT AS n_tokens FROM {_encoded()}",
    "q11_decode": f"SELECT doc_id, {_HEX} AS text_hex FROM documents",
    "q11_decode_ids": "SELECT item_id, text FROM benchmark",
    "q12_splits": "SELECT CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split, count(*) AS n FROM documents GROUP BY 1",
    "q13_joined_corpus": "SELECT length(t)::BIGINT AS n_chars, strlen(t)::BIGINT AS n_bytes, left(t, 100) AS head, right(t, 50) AS tail FROM (SELECT string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS t FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 500))",
    "q14_train_joined": _training(_JOINED, LEARNED, _RANKS),
    "q15_train_fold_few": _fold_sql(),
    "q15_train_resume": _training(_DOCS, LEARNED, _RANKS),
    "q16_first_n": f"SELECT doc_id, {_HEX} AS text_hex FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 500)",
    "q16_row": f"SELECT doc_id, {_HEX} AS text_hex FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 1 OFFSET 100)",
    "q17_doc_batches": "SELECT ((row_number() OVER (ORDER BY doc_id) - 1) // 1000)::BIGINT AS batch_id, doc_id, md5(text) AS text_md5 FROM documents",
    "q18_windows_512_512": _window_sql(512, 512),
    "q18_windows_128_64": _window_sql(128, 64),
    "q18_windows_128_200": _window_sql(128, 200),
    "q18_window_counts": "SELECT doc_id, len(range(0, greatest(strlen(text) - 512, 0), 512))::BIGINT AS n FROM documents",
    "q19_batches": _BATCHES.format(place="window_id", source=_NUMBERED),
    "q19_shuffled": _BATCHES.format(place="place", source=_SHUFFLED),
    "q19_window_at": f"SELECT window_id, doc_id, start, x_hex, y_hex FROM {_NUMBERED} WHERE window_id = 500",
    "q20_budget_grid": """SELECT device, gpus, hours, mfu, round(c / 1e6, 3) AS c, round(n / 1e6, 3) AS n, round(20 * n / 1e6, 3) AS d, round(20 * n / n, 6) AS ratio FROM (SELECT *, sqrt(c / 120) AS n FROM
(SELECT device, gpus::BIGINT AS gpus, hours::BIGINT AS hours, mfu, gpus * (peak * mfu) * (hours * 3600) AS c FROM (VALUES ('h100', 989e12), ('a100', 312e12), ('l4', 121e12)) d(device, peak), (VALUES (1), (8)) g(gpus), (VALUES (1), (24)) h(hours), (VALUES (0.3::DOUBLE), (0.4::DOUBLE)) m(mfu)))""",
    "q20_budget_report": """SELECT 'l4' AS device, round(c / 1e9, 3) AS check_6nd, 'Budget: 1 GPU x 1 h @ 30% MFU' || e || 'Compute C: ' || format('{:.3e}', c) || ' FLOPs' || e || 'Optimal N: ' || format('{:.1f}', n / 1e6) || ' M params' || e
|| 'Optimal D: ' || format('{:.2f}', 20 * n / 1e9) || ' B tokens' || e || 'Sanity 6ND: ' || format('{:.3e}', 120 * n * n) || e || 'Ratio D/N: 20.0 tokens/param' AS report FROM (SELECT c, sqrt(c / 120) AS n, chr(10) AS e FROM (SELECT 121e12 * 0.3::DOUBLE * 3600 AS c))""",
    "q21_embed_lookup": _with(_X, "tok AS (SELECT b, unnest(range(len(h) // 2)) AS t, unnest(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::INT)) AS token FROM (SELECT item_id AS b, hex(encode(text)) AS h FROM benchmark))") + f"SELECT b, t::BIGINT AS t, round(sum(y), 6) AS s1, round(sum(y * (i + 1)), 6) AS s2 FROM (SELECT b, t, i, v + ((t * 31 + i * 17) % 13 - 6) / 13.0::DOUBLE AS y FROM tok JOIN x ON x.vec_id = token) GROUP BY b, t",
    "q22_linear": _with(_X, _w("w", DIM, DIM, 1.0, 0), _linear("o", "x", "w")) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS v FROM o",
    "q23_causal_attention": _with(_X, *_QKV, *_attention("x")) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS o FROM att",
    "q24_softmax": _with(_X) + "SELECT vec_id, i::BIGINT AS i, round(exp(v) / sum(exp(v)) OVER (PARTITION BY vec_id), 6) AS p FROM x",
    "q25_layernorm": _with(_X, _norm("n", "x")) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS o FROM n",
    "q26_ffn": _with(_X, *_FFN, _linear("h", "x", "w1"), "r AS (SELECT vec_id, i, greatest(v, 0) AS v FROM h)", _linear("o", "r", "w2")) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS o FROM o",
    "q27_block": _with(_X, _BLOCK_WEIGHTS, *_block("x", 1)) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS o FROM y1",
    "q27_two_blocks": _with(_X, _BLOCK_WEIGHTS, *_block("x", 1), *_block("y1", 2)) + "SELECT vec_id, i::BIGINT AS i, round(v, 6) AS o FROM y2",
    "q28_cross_entropy": _LOSS.format(select="round(avg(loss), 6) AS loss"),
    "q29_epoch_loss": _LOSS.format(select="vec_id % 3 AS epoch, vec_id // 96 AS batch, avg(loss) AS loss") + " GROUP BY 1, 2",
    "q30_greedy_step": _with(_X) + "SELECT vec_id, min(i)::BIGINT AS token_id FROM (SELECT vec_id, i, v, max(v) OVER (PARTITION BY vec_id) AS m FROM x) WHERE v = m GROUP BY vec_id",
}
ORACLES["q29_epoch_loss"] = f"SELECT epoch, round(avg(loss), 6) AS train_loss FROM ({ORACLES['q29_epoch_loss']}) GROUP BY 1"


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
