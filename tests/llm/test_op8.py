import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from lathe.llm import tokenbin as B

TEXTS = ["Hello  World's\n\nit's", "", None, "a\x1cb c d　e", "é ́x İ ΑΣ ΑΣ.", "<|endoftext|> x<|startoftext|>y", "\t\r\n", "repeat me " * 4000, "the of and " * 900, "x", "x"]


def test_query_like_the_library(spark, tmp_path):
    rows = [(7 * i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows[::-1], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(B.tokenizer_path())
    got = {r.doc_id: r for r in B.query(spark, str(tmp_path)).collect()}
    start = 0
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        r = got[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_ids_of_odd_texts_like_the_library():
    rng = random.Random(12)
    parts = ["BİLGİ", "İ", "ΑΣ", "É", "e\u0301", "H\u0331", "ﬁ", "ǰ", "J\u030c", "ª", "²", "3", "½", "\xa0", "\x85", "\x1c", "\t", "\n", " ", "  ", ".", ",", "..", ".,", "!", ")", "'S", "'ll", "\u2019", "…", "word", "Word", "ß", "Ǆ", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "日本", "K", "\U0001f600", "\u0307", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(6000)]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(6000)]
    tokens = B._tokens(B.tokenizer_path())
    assert tokens.apart
    flat, sizes = tokens.ids(texts)
    want = [x.ids for x in tokens.library.encode_batch(texts, add_special_tokens=False)]
    ends = np.cumsum(sizes)
    assert [flat[b - n : b].tolist() for b, n in zip(ends, sizes)] == want


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    tokens = B._Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert not tokens.apart
    texts = ["Hello  world. It's", "", "a b\nc", "é "]
    flat, sizes = tokens.ids(texts)
    assert flat.tolist() == [i for x in texts for i in tokens.library.encode(x, add_special_tokens=False).ids] and sizes[1] == 0


def _pairs_left(x):
    """How often the commonest pair, documents' last ids apart, still stands in a shard's symbols."""
    n = {}
    for a, b in zip(x.starts, x.starts[1:]):
        own = x.symbols[a : b - 1].tolist()
        for p in zip(own, own[1:]):
            n[p] = n.get(p, 0) + 1
    return max(n.values(), default=0)


def test_no_frequent_pair_is_left_and_symbols_may_outgrow_16_bits(monkeypatch):
    rng = np.random.default_rng(1)
    phrase = rng.integers(2, 40_000, 3000).astype(np.uint32)
    flat = np.concatenate([*[phrase] * 20, rng.integers(2, 40_000, 50_000).astype(np.uint32), [1]]).astype(np.uint32)
    x = B.Shard(B.compress(flat, [5], np.array([flat.size])))
    assert _pairs_left(x) < B.LEAST and x.document(0).tolist() == flat.tolist()
    assert x.expansion.max() >= 2000  # a passage that recurs is one symbol, or nearly
    monkeypatch.setattr(B, "LEAST", 2)
    many = np.concatenate([np.repeat(np.arange(2, 90_002, dtype=np.uint32), 1)] * 2 + [np.array([1], np.uint32)])
    x = B.Shard(B.compress(many, [5], np.array([many.size])))
    assert x.terminals.size + x.left.size > 1 << 16 and _pairs_left(x) < 2 and x.document(0).tolist() == many.tolist()


def test_grammar_round_trip_and_random_access():
    rng = random.Random(5)
    words = [[rng.randrange(40000) for _ in range(rng.randrange(1, 5))] for _ in range(60)]
    docs = [[i for _ in range(rng.choice([0, 1, 5, 700])) for i in rng.choice(words)] + [1] for _ in range(40)] + [[9] * 5001 + [1], [1]]
    flat, sizes = np.array([i for d in docs for i in d], np.uint32), np.array([len(d) for d in docs])
    data = B.compress(flat, [None, *range(1, len(docs))], sizes)
    x = B.Shard(data)
    assert x.first.size >= 3 and len(data) < flat.nbytes / 3
    assert x.doc_ids == [None, *range(1, len(docs))]
    assert [x.document(k).tolist() for k in range(len(docs))] == docs
    ids, counts = x.documents()
    assert ids.tolist() == flat.tolist() and counts.tolist() == sizes.tolist()


def test_nulls_repeats_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (3, None), (3, "b b"), (3, "b b")], "doc_id long, text string")
    B.write(df, f"{tmp_path}/a", B.tokenizer_path())
    assert sorted((r.doc_id is not None, r.start) for r in B.documents(spark, f"{tmp_path}/a").collect())[0] == (False, 0)
    assert sum(r.n_tokens for r in B.documents(spark, f"{tmp_path}/a").collect()) == 2 + 1 + 3 + 3
    B.write(df.limit(0), f"{tmp_path}/b", B.tokenizer_path())
    assert B.documents(spark, f"{tmp_path}/b").count() == 0
