import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import learn, merge
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lathe.functions import seq as S
from lathe.operators import bpe
from lathe.sources import corpus

# Sample strings, and the rules that are learned from the second.
X1 = "aaabbaababbaaabba"
X2 = "aaabbaababbaaabbaşşIIİİaaİAİAİA"
G2 = [(97, 97, 256), (196, 176, 257), (97, 98, 258), (258, 98, 259), (257, 65, 260), (256, 259, 261), (197, 159, 262), (260, 260, 263)]


def ids_of(spark, text, merges=()):
    df = corpus.literal(spark, text)
    return df.select(S.to_ids(S.encode(F.col("text"), merges)).alias("i")).first().i


def test_counts_and_one_merge_of_the_sample(spark):
    df = corpus.literal(spark, X1).select("doc_id", S.to_ids(S.from_text(F.col("text"))).alias("ids"))
    assert {(r.l, r.r): r.n for r in bpe.pair_counts(df).collect()} == {(97, 97): 5, (97, 98): 4, (98, 97): 4, (98, 98): 3}
    assert tuple(bpe.best_pair(df).first()) == (97, 97, 5)
    assert ids_of(spark, X1, [(97, 97, 256)]) == [256, 97, 98, 98, 256, 98, 97, 98, 98, 256, 97, 98, 98, 97]
    assert bpe.best_pair(df, 6).count() == 0 and bpe.best_pair(df.limit(0)).count() == 0


@pytest.mark.parametrize("mode", ["document_bounded", "joined", "per_document_fold"])
def test_learning_the_samples(spark, mode):
    t, counts = bpe.train(corpus.literal(spark, X1), 300, 2, mode)
    assert t.merges == ((97, 97, 256), (97, 98, 257), (257, 98, 258), (256, 258, 259)) and counts == [5, 3, 3, 2]
    assert ids_of(spark, X1, t.merges) == [259, 256, 98, 258, 259, 97]
    t, _ = bpe.train(corpus.literal(spark, X2), 300, 2, mode)
    assert list(t.merges) == G2 and t.vocab_size == 264
    assert ids_of(spark, X2, t.merges) == [261, 256, 98, 259, 261, 97, 262, 262, 73, 73, 257, 257, 256, 263, 260]


def test_modes_like_plain_on_random_corpora(spark, monkeypatch):
    rng = random.Random(1)
    for k, letters in enumerate(["ab", "aé\n "]):
        docs = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 7, 60]))) for _ in range(20)]
        df = corpus.literal(spark, *docs).repartition(3)
        t, counts = bpe.train(df, 266, 2)
        assert (list(t.merges), counts) == learn(docs, 266, 2)
        monkeypatch.setattr(bpe, "SEGMENT_IDS", 3 + 20 * k)  # many small segments: pairs cross them all the time
        monkeypatch.setattr(bpe, "REWRITE", 4)
        t, counts = bpe.train(df, 266, 2, "joined")
        assert (list(t.merges), counts) == learn(["\n\n".join(docs)], 266, 2)
        half, _ = bpe.train(df, 260, 2, "joined")
        assert bpe.train(df, 266, 2, "joined", half)[0] == t
        rules = []
        for d in docs:
            rules, _ = learn([d], 275, 2, rules)
        assert list(bpe.train(df, 275, 2, "per_document_fold")[0].merges) == rules


def test_resuming_and_edges(spark):
    df = corpus.literal(spark, X1, X2, "", "a")
    half, _ = bpe.train(df, 259)
    assert bpe.train(df, 264, init=half)[0] == bpe.train(df, 264)[0]
    assert bpe.train(df, 256)[0].merges == () and bpe.train(df, 10)[0].merges == ()
    for mode in ("document_bounded", "joined", "per_document_fold"):
        assert bpe.train(corpus.literal(spark, "aa"), 300, 2, mode)[0].merges == ()
        assert bpe.train(corpus.literal(spark, "aaa"), 300, 2, mode)[0].merges == ((97, 97, 256),)
        assert bpe.train(df.limit(0), 300, 2, mode)[0].merges == ()
    with pytest.raises(ValueError):
        bpe.train(df, 300, mode="other")


def test_encode_decode_round_trip(spark):
    t, _ = bpe.train(corpus.literal(spark, X2), 300)
    texts = ["", "a", X1, X2, "def hello_world(name): print('hello', name)", "😀 é́", "ü" * 500]
    df = corpus.literal(spark, *texts)
    rows = df.select("text", t.decode(t.encode(F.col("text"))).alias("back"), S.to_ids(t.encode(F.col("text"))).alias("ids")).collect()
    for r in rows:
        ids = list(r.text.encode())
        for m in t.merges:
            ids = merge(ids, *m)
        assert r.back == r.text and r.ids == ids
    ids = df.select("doc_id", S.to_ids(t.encode(F.col("text"))).alias("ids"))
    assert [r.text for r in bpe.decode_ids(ids, t).orderBy("doc_id").collect()] == texts
    assert t.vocab()[261] == b"aaabb" and t.vocab_table(spark).count() == 264


@pytest.mark.parametrize("ahead", [0, 1, 6])
def test_rules_guessed_ahead_change_nothing(spark, monkeypatch, ahead):
    monkeypatch.setattr(bpe, "AHEAD", ahead)
    rng = random.Random(ahead)
    words = ["".join(rng.choice("abcdeaab ") for _ in range(rng.randrange(2, 9))) for _ in range(40)]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(30)] + ["", "aaaaaaa", "abababab"]
    t, counts = bpe.train(corpus.literal(spark, *docs).repartition(3), 300, 3)
    rules, want = learn(docs, 300, 3)
    assert (list(t.merges), counts) == (rules, want) and len(rules) > 30
    again, more = bpe.train(corpus.literal(spark, *docs), 300, 3, init=bpe.Tokenizer(tuple(rules[:17])))
    assert list(again.merges) == rules and more == want[17:]


def test_strict_decoding(spark):
    for ids in ([300], [-1], [0xC4]):
        with pytest.raises(PySparkException):
            bpe.decode_ids(spark.createDataFrame([(0, ids)], "doc_id long, ids array<int>"), bpe.Tokenizer()).collect()
    with pytest.raises(PySparkException):
        spark.range(1).select(S.decode(F.lit(chr(300)), [])).collect()


def test_ids_past_the_surrogates(spark):
    s = "".join(S.symbol(i) for i in (0xD7FF, 0xD800, 0x20000))
    assert spark.createDataFrame([(s,)], "s string").select(S.to_ids(F.col("s")).alias("i")).first().i == [0xD7FF, 0xD800, 0x20000]


def test_saving(spark, tmp_path):
    t = bpe.Tokenizer(tuple(G2))
    t.save(spark, f"{tmp_path}/t")
    assert bpe.Tokenizer.load(spark, f"{tmp_path}/t") == t


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(0, 2), st.integers(0, 2))
def test_one_pass_of_a_rule(ids, a, b):
    assert bpe.apply_rule(np.array(ids, np.int32), a, b, 9).tolist() == merge(ids, a, b, 9)
