import os

import pytest
from pyspark.sql import functions as F

from lathe.operators import windows as W
from lathe.sources import corpus


def seqs(spark, *sizes):
    return spark.createDataFrame([(k, list(range(n))) for k, n in enumerate(sizes)], "doc_id long, ids array<int>")


@pytest.mark.parametrize("context, stride", [(4, 4), (4, 2), (4, 7), (1, 1)])
def test_windows_like_slices(spark, context, stride):
    sizes = [0, 1, 4, 5, 6, 9, 20]
    got = {(r.doc_id, r.start): (r.input, r.target) for r in W.windows(seqs(spark, *sizes), context, stride).collect()}
    want = {(k, i): (list(range(i, i + context)), list(range(i + 1, i + context + 1))) for k, n in enumerate(sizes) for i in range(0, n, stride) if i + context + 1 <= n}
    assert got == want
    counts = seqs(spark, *sizes).select("doc_id", W.count_of(F.size("ids"), context, stride).alias("n")).collect()
    assert all(r.n == sum(k == r.doc_id for k, _ in want) for r in counts)


def test_edges_of_the_fixture(spark):
    assert W.windows(seqs(spark, 512), 512, 512).count() == 0
    assert W.windows(seqs(spark, 513), 512, 512).count() == 1
    assert [r.start for r in W.windows(seqs(spark, 1025), 512, 512).orderBy("start").collect()] == [0, 512]
    with pytest.raises(ValueError):
        W.windows(seqs(spark, 5), 0, 1)


def test_batches(spark):
    w = W.windows(seqs(spark, *[67] * 1), 2, 2)
    assert w.count() == 33
    w = W.windows(seqs(spark, 5, 64), 2, 2)
    assert w.count() == 33
    assert sorted(r.n for r in W.batches(w).groupBy("batch_id").agg(F.count("*").alias("n")).collect()) == [1, 32]
    assert W.window_at(w, 2).first().start == 0
    one, two = (W.shuffled_batches(w, seed=1, epoch=e).select("window_id", "batch_id").collect() for e in (0, 1))
    assert sorted(r.window_id for r in one) == list(range(33)) and sorted(one) != sorted(two)


def test_numbered_windows_of_packed_ids_carry_their_data(spark):
    rows = [(7, b"abcdefgh"), (None, b"xyz"), (3, b""), (3, b"0123456"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, ids binary").repartition(4)
    got = {r.window_id: (r.doc_id, r.start, bytes(r.input), bytes(r.target)) for r in W.numbered(df, 3, 2).collect()}
    want = [(i, a, s[a : a + 3], s[a + 1 : a + 4]) for i, s in sorted(((i, s or b"") for i, s in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for a in range(0, len(s) - 3, 2)]
    assert got == dict(enumerate(want))


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")
def test_no_row_is_lost_with_wide_columns(spark):
    """Under adaptive execution, with text, with input and target: positions are 0 .. n - 1."""
    docs = corpus.documents(spark, SF)
    n = docs.count()
    whole = lambda df, c: df.agg(F.count("*"), F.min(c), F.max(c), F.countDistinct(c)).first()
    assert tuple(whole(corpus.positions(docs).filter("text is not null"), "position")) == (n, 0, n - 1, n)
    packed = docs.select("doc_id", F.encode("text", "UTF-8").alias("ids"))
    w = W.windows(packed, 512, 512)
    k = w.count()
    for df in (W.numbered(packed, 512, 512), W.batches(w), W.shuffled_batches(w, seed=3)):
        assert tuple(whole(df.filter("octet_length(input) = 512 and octet_length(target) = 512"), "window_id")) == (k, 0, k - 1, k)


def test_epoch_loss_weighs_batches_alike(spark):
    rows = [(0, b, float(b)) for b in [0] * 32 + [1]]
    assert W.epoch_losses(spark.createDataFrame(rows, "epoch int, batch_id int, loss double")).first().train_loss == 0.5


def test_sources(spark):
    df = spark.createDataFrame([(k * 3, f"t{k}") for k in range(50)], corpus.DOCUMENT).repartition(5)
    assert [r.position for r in corpus.positions(df).orderBy("doc_id").collect()] == list(range(50))
    assert corpus.row_at(df, 7).first().text == "t7"
    assert corpus.joined(corpus.first(df, 3)).first().text == "t0\n\nt1\n\nt2"
    assert sum(corpus.split(df, s).count() for s in corpus.SPLITS) == 50
    assert {r["count"] for r in corpus.batches(df, 20).groupBy("batch_id").count().collect()} == {20, 10}
    with pytest.raises(ValueError):
        corpus.split(df, "other")
