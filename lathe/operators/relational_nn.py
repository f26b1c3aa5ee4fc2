"""The parts of a decoder-only transformer as column expressions.

A position is a row (b, t, x) with its activations packed in an array: a linear
layer is then a projection against a literal weight matrix, without join or
shuffle. Attention needs the earlier positions of its batch row: a sequence, whose
length is the model's context at most, is gathered into one row, and the slice up
to a position is the causal mask itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 1e-5


def matrix(rows: int, columns: int, scale: float = 1.0, shift: int = 0) -> list[list[float]]:
    """Deterministic weights, the same closed form as in the catalogue's SQL."""
    return [[((i * 31 + j * 17 + shift) % 13 - 6) / 13.0 * scale for j in range(columns)] for i in range(rows)]


def _literal(w: Sequence[Sequence[float]]) -> Column:
    """A matrix as one folded literal; it is part of the plan, so for layers of bounded size."""
    return F.from_json(F.lit(str([list(map(float, r)) for r in w])), "array<array<double>>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: what a lambda's variable holds is not evaluated anew for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def linear(x: Column, w: Sequence[Sequence[float]]) -> Column:
    """x times the transpose of w (rows of w are outputs), no bias."""
    return let(x, lambda v: F.transform(_literal(w), lambda row: dot(v, row)))


def relu(x: Column) -> Column:
    return F.transform(x, lambda v: F.greatest(v, F.lit(0.0)))


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def softmax(x: Column) -> Column:
    shifted = lambda v: let(F.array_max(v), lambda top: F.transform(v, lambda y: F.exp(y - top)))
    return let(let(x, shifted), lambda e: let(total(e), lambda s: F.transform(e, lambda y: y / s)))


def layer_norm(x: Column) -> Column:
    """Zero mean and unit (population) variance over the array, scale one, shift zero."""

    def scaled(c: Column) -> Column:
        return let(F.sqrt(dot(c, c) / F.size(c) + EPSILON), lambda d: F.transform(c, lambda y: y / d))

    centred = let(x, lambda v: let(total(v) / F.size(v), lambda m: F.transform(v, lambda y: y - m)))
    return let(centred, scaled)


def embed(tokens: DataFrame, weights: DataFrame, positions: DataFrame) -> DataFrame:
    """(b, t, x): token rows (b, t, token_id) joined with token and positional embeddings (id, x); the join picks broadcast by size."""
    at = positions.select(F.col("id").alias("t"), F.col("x").alias("p"))
    return tokens.join(weights.select(F.col("id").alias("token_id"), "x"), "token_id").join(at, "t").select("b", "t", add(F.col("x"), F.col("p")).alias("x"))


def attention(df: DataFrame, wq, wk, wv, wo, heads: int, x: str = "x", out: str = "o") -> DataFrame:
    """Causal multi-head attention over rows (b, t, x), appended as an array."""
    if len(wq) % heads:
        raise ValueError("the projection must be divisible by the number of heads")
    size = len(wq) // heads
    projected = F.struct("t", *(linear(F.col(x), w).alias(n) for n, w in (("q", wq), ("k", wk), ("v", wv))), F.struct(*df.columns).alias("row"))
    sequences = df.groupBy("b").agg(F.sort_array(F.collect_list(projected)).alias("__seq"))

    def head(h: int, q: Column, past: Column) -> Column:
        """Output of one head: softmax of the scaled scores over the past, times the past values."""
        part = lambda a: F.slice(a, h * size + 1, size)
        scores = let(part(q), lambda own: F.transform(past, lambda e: dot(own, part(e["k"])) / float(size) ** 0.5))
        zero = F.array(*[F.lit(0.0)] * size)
        pairs = let(softmax(scores), lambda p: F.zip_with(p, past, lambda y, e: F.struct(y.alias("p"), part(e["v"]).alias("v"))))
        return F.aggregate(pairs, zero, lambda acc, e: F.zip_with(acc, e["v"], lambda s, v: s + e["p"] * v))

    def position(e: Column, i: Column) -> Column:
        merged = let(F.slice("__seq", 1, i + 1), lambda past: F.concat(*(head(h, e["q"], past) for h in range(heads))))
        return F.struct(e["row"].alias("row"), (linear(merged, wo) if wo is not None else merged).alias("o"))

    rows = sequences.select(F.explode(F.transform("__seq", position)).alias("__e"))
    return rows.select("__e.row.*", F.col("__e.o").alias(out))


def feed_forward(x: Column, w1, w2) -> Column:
    return linear(relu(linear(x, w1)), w2)


def block(df: DataFrame, weights: dict, heads: int) -> DataFrame:
    """Pre-norm block over rows (b, t, x): x + attention(norm x), then + feed-forward(norm)."""
    normed = df.withColumn("__n", layer_norm(F.col("x")))
    attended = attention(normed, weights["q"], weights["k"], weights["v"], weights["o"], heads, "__n", "__a")
    mid = attended.select("b", "t", add(F.col("x"), F.col("__a")).alias("x"))
    inner = mid.withColumn("__n", layer_norm(F.col("x"))).withColumn("__h", relu(linear(F.col("__n"), weights["w1"])))
    return inner.select("b", "t", add(F.col("x"), linear(F.col("__h"), weights["w2"])).alias("x"))


def cross_entropy(logits: Column, target: Column) -> Column:
    """-log softmax(logits)[target] by log-sum-exp; targets count from 0."""
    spread = lambda v: let(F.array_max(v), lambda top: top + F.ln(total(F.transform(v, lambda y: F.exp(y - top)))))
    return let(logits, lambda v: spread(v) - F.element_at(v, target.cast("int") + 1))


def argmax(logits: Column) -> Column:
    """The index of the greatest logit, the lowest of several."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
