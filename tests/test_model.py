import numpy as np
import pytest
from pyspark.sql import functions as F

from lathe.functions import scaling
from lathe.operators import arrow_nn as A
from lathe.operators import relational_nn as R

C = A.Config(vocab_size=11, context_size=6, embedding_dim=8, proj_dim=4, n_heads=2, n_layers=2)


def test_budget_of_the_flagship_call(spark):
    row = spark.createDataFrame([(1, 1, 121e12, 0.30, 20.0)], "gpus long, hours long, peak_flops double, mfu double, tokens_per_param double")
    r = scaling.budget_report(row).withColumn("line", scaling.report_text()).first()
    assert r.c == pytest.approx(1.3068e17) and r.n == pytest.approx(3.3e7) and r.d == pytest.approx(6.6e8)
    assert r.check_6nd == pytest.approx(r.c) and r.ratio == pytest.approx(20) and "33.0 M params" in r.line


def test_parameters_of_the_reference_size():
    assert A.Config(vocab_size=300).parameters() == 2_167_040 + 256 * 300
    with pytest.raises(ValueError):
        A.Config(vocab_size=3, proj_dim=10, n_heads=3)


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(0)
    p = A.init(C)
    x, y = rng.integers(0, 11, (3, 5)), rng.integers(0, 11, (3, 5))
    loss, g = A.gradients(p, C, x, y)
    assert loss == pytest.approx(A.losses(A.forward(p, C, x), y).sum())
    for name, w in p.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in w.shape)
            ends = []
            for d in (1e-5, -1e-5):
                q = dict(p)
                q[name] = w.copy()
                q[name][at] += d
                ends.append(A.losses(A.forward(q, C, x), y).sum())
            assert g[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-4, abs=1e-6), name


def test_later_tokens_do_not_change_earlier_logits():
    p = A.init(C)
    a = A.forward(p, C, np.array([[1, 2, 3, 4]]))
    b = A.forward(p, C, np.array([[1, 2, 9, 9]]))
    assert np.allclose(a[:, :2], b[:, :2]) and not np.allclose(a[:, 2:], b[:, 2:])


def test_relational_block_like_numpy(spark):
    c = A.Config(vocab_size=11, context_size=6, embedding_dim=8, proj_dim=8, n_heads=2, n_layers=1)
    p = A.init(c, 3)
    ids = np.array([[1, 5, 2, 7], [3, 3, 0, 10]])
    table = lambda w: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(w)], "id long, x array<double>")
    tokens = spark.createDataFrame([(b, t, int(ids[b, t])) for b in range(2) for t in range(4)], "b long, t long, token_id long")
    x = R.embed(tokens, table(p["token"]), table(p["position"]))
    names = {"q": "q", "k": "k", "v": "v", "o": "o", "w1": "w1", "w2": "w2"}
    out = R.block(x, {k: p[f"0.{v}"].tolist() for k, v in names.items()}, 2)
    logits = out.withColumn("y", R.linear(R.layer_norm(F.col("x")), p["out"].tolist())).orderBy("b", "t")
    assert np.allclose(np.array([r.y for r in logits.collect()]).reshape(2, 4, 11), A.forward(p, c, ids))
    loss = logits.withColumn("target", (F.col("b") * 4 + F.col("t")).cast("int")).select(R.cross_entropy(F.col("y"), F.col("target")).alias("l"), R.argmax(F.col("y")).alias("a")).collect()
    want = A.forward(p, c, ids)
    assert np.allclose([r.l for r in loss], A.losses(want, np.arange(8).reshape(2, 4)).ravel())
    assert [r.a for r in loss] == want.argmax(-1).ravel().tolist()
    with pytest.raises(ValueError):
        R.attention(x, R.matrix(9, 8), R.matrix(9, 8), R.matrix(9, 8), None, 2)


def test_training_lowers_the_loss(spark):
    text = [i % 7 for i in range(60)]
    rows = [(k // 4, text[k : k + 6], text[k + 1 : k + 7]) for k in range(16)]
    w = spark.createDataFrame(rows, "batch_id long, input array<int>, target array<int>")
    p, history, log = A.train(w, w, A.init(C), C, 4, A.AdamW(3e-2), log_every=4)
    assert history[-1][2] < history[0][2] / 2 and [s for s, _ in log] == [4, 8, 12, 16]
    assert A.history_table(spark, history).count() == 4
    assert A.generate(p, C, [3], 4) == A.generate(p, C, [3], 4)
    with pytest.raises(ValueError):
        A.generate(p, C, [1], 9)
    assert len(A.generate(p, C, [1], 9, keep_last=True)) == 10
    with pytest.raises(ValueError):
        A.train(w.limit(0), w, p, C)
